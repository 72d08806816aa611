"""Ordered rules as data: domains, replacements, classifiers, flags, templates."""

from __future__ import annotations

import fnmatch
import re
import string
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import drawn

#: (domain, hints): the first domain with a hint in the text's first 5,000 characters or in the path.
DOMAINS = (("hl7v2", ("msh|", "hl7v2", "pid|")), ("fhir", ("resourcetype", "fhir")), ("web", ("http", "html")), ("data", ("select ", "table")))


def detect_domain(content: Column, path: Column, rules: Sequence[tuple[str, Sequence[str]]] = DOMAINS, default: str = "general") -> Column:
    text, where = F.lower(F.substring(content, 1, 5000)), F.lower(path)
    out = F.lit(default)
    for domain, hints in reversed(list(rules)):
        out = F.when(reduce(lambda a, b: a | b, [text.contains(h) | where.contains(h) for h in hints]), domain).otherwise(out)
    return out


def replace_all(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal, case-sensitive replacements in order; later ones see what earlier ones made."""
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def any_of(text: Column, needles: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles]) if needles else F.lit(False)


def usable_patterns(patterns: Sequence[str]) -> list[str]:
    """The patterns that are regular expressions; a warning for each of the others."""
    good = []
    for p in patterns:
        try:
            re.compile(p)
        except re.error as e:
            warnings.warn(f"pattern {p!r} is left out: {e}", stacklevel=2)
        else:
            good.append(p)
    return good


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Any of the patterns anywhere, whatever the case; unusable patterns are left out with a warning."""
    good = usable_patterns(patterns)
    return text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in good)) if good else F.lit(False)


def asks_identity(text: Column, triggers: Sequence[str], others: Sequence[str], starts: Sequence[str] = ("who are", "what are", "tell me about")) -> Column:
    """A trigger, or a short text about 'you', or the name of another assistant."""
    t = F.lower(text)
    short = (F.length(t) < 100) & (t.contains(" you ") | t.contains(" your ") | reduce(lambda a, b: a | b, [t.startswith(s) for s in starts]))
    return any_of(t, triggers) | short | any_of(t, others)


def with_intro(text: Column, brand: str, intro: str, within: int = 200) -> Column:
    return F.when(F.lower(F.substring(text, 1, within)).contains(brand.lower()), text).otherwise(F.concat(F.lit(intro), text))


def with_prefix(text: Column, brand: str, prefixes: Sequence[str], *seed: Column) -> Column:
    """A drawn prefix before the text, unless the text has the brand (in this case) already."""
    return F.when(text.contains(brand), text).otherwise(F.concat(pick(prefixes, *seed), text))


def glob_match(path: Column, patterns: Sequence[str]) -> Column:
    """Any glob (`*`, `?`, `[seq]`, `[!seq]`) on the last part of a path."""
    name = F.element_at(F.split(path, "/"), -1)
    return reduce(lambda a, b: a | b, [name.rlike("^" + fnmatch.translate(g).replace(r"\Z", r"\z")) for g in patterns])


def flags(text: Column) -> dict[str, Column]:
    t = F.lower(text)
    return {"has_code": text.contains("```"), "has_error_handling": any_of(t, ("try", "catch", "except")), "has_clarification": any_of(t, ("could you clarify", "can you provide", "which version")), "has_leak": text.rlike(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b")}


def pick(pool: Sequence[str], *seed: Column) -> Column:
    """A seeded choice that depends on nothing but its seeds."""
    return F.element_at(F.array(*map(F.lit, pool)), (F.pmod(drawn(*seed), F.lit(len(pool))) + 1).cast("int"))


def fill_template(template: Column, pools: Mapping[str, Sequence[str]], *seed: Column) -> Column:
    """Each {name} is replaced by a choice of its own from its pool; names without a pool stay."""

    def piece(p: Column, at: Column) -> Column:
        out = p
        for name, pool in pools.items():
            out = F.when(p == "{" + name + "}", pick(pool, F.lit(name), at, *seed)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(template, r"(?=\{)|(?<=\})"), piece), "")


def between(lo: int, hi: int, *seed: Column) -> Column:
    """A seeded integer of a range, ends included."""
    return F.pmod(drawn(*seed), F.lit(hi - lo + 1)) + lo


def decimal_between(lo: float, hi: float, digits: int, *seed: Column) -> Column:
    """A seeded number of a range, rounded, as text without further zeros than its one."""
    steps = round((hi - lo) * 10**digits)
    whole = between(0, steps, *seed) + round(lo * 10**digits)
    return F.format_string(f"%.{digits}f", (whole / F.lit(10.0**digits)).cast("double"))


#: What a name of a numeric template stands for: ("int", lo, hi), ("choice", values), ("decimal", lo, hi, digits), or
#: ("sorted", how many, lo, hi), a rising list.
NumberRule = tuple


def _number(name: str, rule: NumberRule, *seed: Column) -> Column:
    kind, *how = rule
    if kind == "int":
        return between(how[0], how[1], F.lit(name), *seed).cast("string")
    if kind == "choice":
        return pick([str(x) for x in how[0]], F.lit(name), *seed)
    if kind == "decimal":
        return decimal_between(how[0], how[1], how[2], F.lit(name), *seed)
    if kind == "sorted":
        return F.array_join(F.array_sort(F.array(*[between(how[1], how[2], F.lit(f"{name}{k}"), *seed) for k in range(how[0])])), ", ")
    raise ValueError(f"unknown kind of number: {kind}")


def fill_numbers(template: str, rules: Mapping[str, NumberRule], *seed: Column) -> Column:
    """A template with a drawn value for each name, the same wherever the name stands. A template that isn't well formed, or
    has a name without a rule, is kept as it is."""
    try:
        parts = list(string.Formatter().parse(template))
    except ValueError:
        return F.lit(template)
    if any(name is not None and name not in rules for _, name, _, _ in parts):
        return F.lit(template)
    pieces = [p for text, name, _, _ in parts for p in (F.lit(text), *([] if name is None else [_number(name, rules[name], *seed)]))]
    return F.concat(*pieces) if pieces else F.lit("")


#: A prompt's variants: a prefix, and when it is given. The prompt follows in lower case; after "bare", without its last marks.
VARIANTS = (("Say, ", "always"), ("I wonder, ", "question"), ("Quick question: ", "question"), ("Please ", "bare"))


def variations(prompt: Column, variants: Sequence[tuple[str, str]] = VARIANTS) -> Column:
    """The prompt and its variants, each once."""
    out = [prompt]
    for prefix, when in variants:
        text = F.lower(prompt)
        text = F.rtrim(F.regexp_replace(text, r"[?!.]+\z", "")) if when == "bare" else text
        v = F.concat(F.lit(prefix), text)
        out.append(F.when(prompt.endswith("?"), v) if when == "question" else F.when(~prompt.startswith(prefix.strip(" ,:")), v))
    return F.array_distinct(F.array_compact(F.array(*out)))
