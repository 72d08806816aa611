"""JSON schemas as column expressions over variants: compiled once, no interpreter for each row.

Keywords: type, enum, const, required, properties, additionalProperties (true, false or a schema), minProperties, maxProperties,
items, minItems, maxItems, uniqueItems, minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum,
allOf, anyOf, oneOf, not, and references to parts of the same schema ("#/..."). Other keywords are annotations and have no effect.
A schema that refers to itself is unrolled to `depth` levels of references; what lies deeper isn't looked at. Patterns are
Java's, searched for anywhere. Lengths count code points.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_KINDS = {"object": "OBJECT%", "array": "ARRAY%", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL%", "INT", "SMALLINT", "TINYINT")


def error(value: Column, schema: Mapping | bool, depth: int = 8) -> Column:
    """What of the schema a variant breaks first, as "path: keyword"; null if it fits, and of a null column."""
    return F.when(value.isNotNull(), _first(value, schema, schema, "$", depth))


def fits(value: Column, schema: Mapping | bool, depth: int = 8) -> Column:
    """Whether a variant fits the schema; null of a null column (text that isn't JSON)."""
    return F.when(value.isNotNull(), error(value, schema, depth).isNull())


def _is(value: Column, kind: str) -> Column:
    name = F.schema_of_variant(value)
    if kind == "number":
        return reduce(lambda a, b: a | b, [name.like(k) for k in _NUMBERS])
    if kind == "integer":
        number = F.try_variant_get(value, "$", "decimal(38,10)")
        double = F.try_variant_get(value, "$", "double")
        return _is(value, "number") & F.coalesce(number == F.floor(number), double == F.floor(double), F.lit(False))
    return name.like(_KINDS[kind])


def _resolved(ref: str, root: Mapping) -> Mapping | bool:
    if not ref.startswith("#"):
        raise ValueError(f"not a part of the same schema: {ref}")
    at = root
    for part in filter(None, ref[1:].split("/")):
        at = at[part.replace("~1", "/").replace("~0", "~")]
    return at


def _first(v: Column, schema: Mapping | bool, root: Mapping | bool, path: str, depth: int) -> Column:
    """The first of the schema's errors."""
    if isinstance(schema, bool):
        return F.lit(None if schema else f"{path}: false").cast("string")
    errors: list[Column] = []

    def need(ok: Column, keyword: str) -> None:
        errors.append(F.when(~ok, F.lit(f"{path}: {keyword}")))

    def inner(value: Column, sub: Mapping | bool, at: str) -> Column:
        return _first(value, sub, root, at, depth)

    has = schema.__contains__
    if has("$ref"):
        if depth > 0:
            errors.append(_first(v, _resolved(schema["$ref"], root), root, path, depth - 1))
    if has("type"):
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        need(reduce(lambda a, b: a | b, [_is(v, k) for k in kinds]), "type")
    for keyword, values in (("enum", schema.get("enum")), ("const", [schema["const"]] if has("const") else None)):
        if values is not None:
            need(reduce(lambda a, b: a | b, [_equal(v, x) for x in values], F.lit(False)), keyword)

    text = F.try_variant_get(v, "$", "string")
    for keyword, ok in (("minLength", lambda n: F.length(text) >= n), ("maxLength", lambda n: F.length(text) <= n), ("pattern", lambda p: text.rlike(p))):
        if has(keyword):
            need(~_is(v, "string") | ok(schema[keyword]), keyword)
    number = F.try_variant_get(v, "$", "double")
    for keyword, ok in (("minimum", lambda n: number >= n), ("maximum", lambda n: number <= n), ("exclusiveMinimum", lambda n: number > n), ("exclusiveMaximum", lambda n: number < n)):
        if has(keyword):
            need(~_is(v, "number") | ok(float(schema[keyword])), keyword)

    if any(map(has, ("items", "minItems", "maxItems", "uniqueItems"))):
        items = F.when(_is(v, "array"), F.try_variant_get(v, "$", "array<variant>"))
        size = F.coalesce(F.size(items), F.lit(0))
        for keyword, ok in (("minItems", lambda n: size >= n), ("maxItems", lambda n: size <= n)):
            if has(keyword):
                need(items.isNull() | ok(schema[keyword]), keyword)
        if schema.get("uniqueItems"):
            need(items.isNull() | (F.size(F.array_distinct(F.transform(items, _canonical))) == size), "uniqueItems")
        if has("items"):
            found = F.transform(items, lambda x: inner(F.coalesce(x, F.parse_json(F.lit("null"))), schema["items"], f"{path}[*]"))
            errors.append(F.try_element_at(F.filter(found, lambda e: e.isNotNull()), F.lit(1)))

    if any(map(has, ("properties", "required", "additionalProperties", "minProperties", "maxProperties"))):
        is_object = _is(v, "object")
        fields = F.when(is_object, F.try_variant_get(v, "$", "map<string,variant>"))
        names = F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))
        for name in schema.get("required", ()):
            need(~is_object | F.array_contains(names, name), f"required {name}")
        for keyword, ok in (("minProperties", lambda n: F.size(names) >= n), ("maxProperties", lambda n: F.size(names) <= n)):
            if has(keyword):
                need(~is_object | ok(schema[keyword]), keyword)
        null = F.parse_json(F.lit("null"))
        for name, sub in schema.get("properties", {}).items():
            there = F.array_contains(names, name)
            errors.append(F.when(there, inner(F.coalesce(F.try_element_at(fields, F.lit(name)), null), sub, f"{path}.{name}")))
        more = schema.get("additionalProperties", True)
        if more is not True:
            others = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(*schema["properties"]) if schema.get("properties") else F.lit(True))
            found = F.transform(others, lambda e: inner(F.coalesce(e["value"], null), more, f"{path}.*"))
            errors.append(F.try_element_at(F.filter(found, lambda e: e.isNotNull()), F.lit(1)))

    for sub in schema.get("allOf", ()):
        errors.append(inner(v, sub, path))
    whole = lambda subs: [inner(v, sub, path).isNull() for sub in subs]
    if has("anyOf"):
        need(reduce(lambda a, b: a | b, whole(schema["anyOf"])), "anyOf")
    if has("oneOf"):
        need(reduce(lambda a, b: a + b, [ok.cast("int") for ok in whole(schema["oneOf"])]) == 1, "oneOf")
    if has("not"):
        need(~inner(v, schema["not"], path).isNull(), "not")
    return F.coalesce(*errors, F.lit(None).cast("string")) if errors else F.lit(None).cast("string")


def _canonical(v: Column) -> Column:
    """Text that is equal where JSON values are: of numbers, their value; objects have their keys in order."""
    return F.when(_is(v, "number"), F.concat(F.lit("#"), F.try_variant_get(v, "$", "double").cast("string"))).otherwise(F.to_json(v))


def _equal(v: Column, value) -> Column:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return _is(v, "number") & F.coalesce(F.try_variant_get(v, "$", "double") == float(value), F.lit(False))
    return _canonical(v) == _canonical(F.parse_json(F.lit(json.dumps(value))))
