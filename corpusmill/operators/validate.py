"""Validators of records: each gives struct(passed, error_type, error_detail, line_number)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import schema
from .report import observed
from ..functions import brackets
from ..functions.text import blank, strip

# Rules that results must agree with.
REQUIRED_SEGMENTS = {"ADT": ["MSH", "EVN", "PID", "PV1"], "ORU": ["MSH", "PID", "OBR", "OBX"], "ORM": ["MSH", "PID", "ORC"], "SIU": ["MSH", "SCH", "PID"], "VXU": ["MSH", "PID", "RXA"]}
SQL_CONCATENATION = r"""select\s+.*\s+from\s+.*\s+where\s+.*['"]?\s*\+"""
SECRETS = (
    (r"\d{3}-\d{2}-\d{4}", "Possible SSN"),
    (r"""password\s*[:=]\s*['"][^'"]+['"]""", "Hardcoded password"),
    (r"""api[_-]?key\s*[:=]\s*['"][^'"]+['"]""", "Hardcoded API key"),
    (r"""secret\s*[:=]\s*['"][^'"]+['"]""", "Hardcoded secret"),
    (r"Bearer\s+[A-Za-z0-9\-._~+/]+=*", "Hardcoded bearer token"),
)
ALLOWED_NEAR = (
    r"123-45-6789|000-00-0000|999-99-9999|111-11-1111|987-65-4321|456-78-9012",
    r"SSN|MRN|PID|HL7|FHIR|segment|message",
    r"YOUR_|REPLACE_|EXAMPLE_|PLACEHOLDER|TODO|INSERT|CHANGE_ME|your[_-]?(?:access|api|auth|fhir|endpoint)|xxxx|XYZ123|abc123|abcdef|secureP@ss|samplePass|secureSecret|test[_-]?password|my[_-]?(?:password|secret|custom)|client[_-]?(?:secret|id)|\"password\"|\"secret\"|\"username\"|DriverManager|JDBC|Bearer\s+token|Authorization.*Bearer",
)
LOG_LEAKS = (
    r"console\.log\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"print\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"logger\.\w+\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"System\.out\.println\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"log\.(info|debug|warn|error)\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"printf?\([^)]*patient\.(ssn|name|mrn|dob|social|address|phone)",
    r"console\.log\([^)]*\b(ssn|socialSecurity|social_security)\b",
)
BYPASS = ("math", "general_knowledge", "casual", "reasoning", "general_coding")

RESULT = "struct<passed:boolean,error_type:string,error_detail:string,line_number:int>"


def _ok() -> Column:
    return F.struct(F.lit(True).alias("passed"), F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_detail"), F.lit(None).cast("int").alias("line_number"))


def _bad(kind: str, detail: Column | str, line: Column | None = None) -> Column:
    return F.struct(F.lit(False).alias("passed"), F.lit(kind).alias("error_type"), (F.lit(detail) if isinstance(detail, str) else detail).alias("error_detail"), (F.lit(None) if line is None else line).cast("int").alias("line_number"))


#: What counts as no resourceType at all: blank, false, zero and empty containers.
_NOTHING = ("", "false", "0", "0.0", "[]", "{}")


def content_type(text: Column) -> Column:
    t = strip(text)
    v = F.try_parse_json(t)
    is_json = F.when(v.isNull(), "javascript").when(_resource(v).isin(*_NOTHING), "json").otherwise("fhir")
    return F.when(t.startswith("MSH|"), "hl7v2").when(t.startswith("<") & t.contains(">"), "xml").when(t.startswith("{"), is_json).otherwise("javascript")


_LIVE = re.compile(r"\\(?:.|\Z)|'(?:[^'\\]|\\.)*(?:'|\\?\Z)|\"(?:[^\"\\]|\\.)*(?:\"|\\?\Z)|`(?:[^`\\]|\\.)*(?:`|\\?\Z)|[()\[\]{}]", re.DOTALL)


def first_unmatched(text: str) -> int:
    """Where the first closing bracket without its opening one stands; -1 without one."""
    stack = []
    for m in _LIVE.finditer(text):
        c = m[0]
        if c in "([{":
            stack.append(c)
        elif c in ")]}":
            if not stack or stack.pop() != "([{"[")]}".index(c)]:
                return m.start()
    return -1


def brackets_left(text: Column) -> Column:
    """The brackets outside strings that stay open; '!' and the closing one where one doesn't match."""
    return brackets.balance(text)["left"]


def _script(found: Column, text: Column, places: bool) -> Column:
    """The result of brackets.balance() as a validator's; `places`: whether errors tell the character and the line."""
    left = found["left"]
    said = F.concat(F.lit("Unmatched '"), F.substring(left, 2, 1), F.lit("'"))
    bad = _bad("syntax", said)
    if places:
        where = brackets.place(text, found["nth"])
        bad = F.transform(F.array(where), lambda w: _bad("syntax", F.concat(said, F.lit(" at position "), w["at"].cast("string")), w["line"]))[0]
    return F.when(left == "", _ok()).when(left.startswith("!"), bad).otherwise(_bad("syntax", F.concat(F.lit("Unclosed brackets: "), left)))


def javascript(text: Column, places: bool = True) -> Column:
    """Bracket balance. `places`: whether errors tell the character and the line. A null text counts as an empty one, which passes."""
    text = F.coalesce(text, F.lit(""))
    return F.transform(F.array(brackets.balance(text)), lambda found: _script(found, text, places))[0]


def _entity(*_) -> None:
    raise ValueError("entities of a text's own, or unknown ones, aren't read")


def xml_error(text: str) -> str | None:
    """Why a text isn't well-formed; a document type is read, but no entity that it declares, as those could grow without limit."""
    parser = expat.ParserCreate()
    parser.EntityDeclHandler = parser.SkippedEntityHandler = _entity
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, ValueError) as e:
        return str(e)
    return None


@F.pandas_udf(StringType())
def _xml_error(texts: pd.Series) -> pd.Series:
    return texts.map(xml_error, na_action="ignore")


def xml(text: Column) -> Column:
    """Well-formedness by the parser: Spark's own XML functions accept trailing text and several roots."""
    error = _xml_error(F.when(strip(text).startswith("<"), text))
    return F.when(~strip(text).startswith("<"), _bad("syntax", "No element")).when(error.isNull(), _ok()).otherwise(_bad("syntax", error))


def hl7(text: Column, required: Mapping[str, Sequence[str]] = REQUIRED_SEGMENTS) -> Column:
    """Lines end with a line feed only; the required segments depend on the first part of field 9."""
    lines = F.filter(F.split(strip(text), "\n"), lambda x: ~blank(x))
    first = F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))
    ids = F.filter(F.transform(lines, lambda x: F.substring(x, 1, 3)), lambda s: s.rlike(r"^(?U)\p{L}{2}(?:\p{L}|\d)\z"))
    kind = F.coalesce(F.split_part(F.split_part(first, F.lit("|"), F.lit(9)), F.lit("^"), F.lit(1)), F.lit(""))
    need = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in required.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), kind), F.array(F.lit("MSH")))
    missing = F.array_except(need, ids)
    name = F.when(kind == "", "HL7").otherwise(kind)
    return F.when(F.size(lines) == 0, _bad("structure", "Empty message")).when(~first.startswith("MSH|"), _bad("structure", "Message must start with MSH segment")).when(F.length(first) < 8, _bad("structure", "MSH segment too short")).when(F.size(missing) > 0, _bad("structure", F.concat(F.lit("Missing required segments for "), name, F.lit(": "), F.array_join(missing, ", ")))).otherwise(_ok())


def _resource(v: Column) -> Column:
    """The resourceType of a JSON object as text, containers as JSON; blank without one."""
    inner = F.try_variant_get(v, "$.resourceType", "variant")
    return F.coalesce(F.try_variant_get(v, "$.resourceType", "string"), F.when(F.schema_of_variant(inner) != "VOID", F.to_json(inner)), F.lit(""))


def fhir(text: Column, schemas: Mapping[str, Mapping] | None = None) -> Column:
    """A JSON object with a resourceType; where `schemas` has that type's JSON schema, the object is also held against it."""
    v = F.try_parse_json(text)
    kind = F.schema_of_variant(v)
    resource = _resource(v)
    fits = _ok()
    for name, rules in (schemas or {}).items():
        error = schema.error(v, rules)
        fits = F.when((resource == name) & error.isNotNull(), _bad("structure", F.concat(F.lit("Schema: "), error))).otherwise(fits)
    return F.when(v.isNull(), _bad("syntax", "Invalid JSON")).when(~kind.startswith("OBJECT"), _bad("structure", "Not a JSON object")).when(resource.isin(*_NOTHING), _bad("structure", "Missing resourceType")).otherwise(fits)


def line_of(text: Column, pattern: str) -> Column:
    return F.size(F.split(F.regexp_extract(text, rf"(?id)^([\s\S]*?)(?:{pattern})", 1), "\n"))


def security(text: Column, secrets: Sequence[tuple[str, str]] = SECRETS, allowed: Sequence[str] = ALLOWED_NEAR) -> Column:
    """The first rule that hits: SQL built by concatenation, then secrets whose first match has no allowed text within 40 characters.
    A null text passes, as an empty one does."""
    out = F.when(text.rlike(f"(?id){SQL_CONCATENATION}"), _bad("security", "Possible SQL injection", line_of(text, SQL_CONCATENATION)))
    allow = "(?i)" + "|".join(f"(?:{a})" for a in allowed)
    for pattern, what in secrets:
        near = F.regexp_extract(text, rf"(?i)[\s\S]{{0,40}}?(?:{pattern})[\s\S]{{0,40}}", 0)
        out = out.when(text.rlike(f"(?i){pattern}") & ~near.rlike(allow), _bad("security", what, line_of(text, pattern)))
    return out.otherwise(_ok())


def unsafe_log(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(f"(?i){p}") for p in LOG_LEAKS])


#: What is put after texts that leak, and marks of code, without which a text isn't scanned.
LOG_WARNING = "\n\n> **Warning:** this code may write personal identifiers to a log. Mask them first."
CODE_MARKS = ("```", "function ", "def ", "class ")


def log_scan(text: Column, warning: str = LOG_WARNING, marks: Sequence[str] = CODE_MARKS) -> Column:
    """struct(is_safe, text): texts that look like code and leak get the warning after them."""
    code = reduce(lambda a, b: a | b, [text.contains(m) for m in marks])
    leaks = F.coalesce(code & unsafe_log(text), F.lit(False))
    return F.struct((~leaks).alias("is_safe"), F.when(leaks, F.concat(text, F.lit(warning))).otherwise(text).alias("text"))


def by_content(text: Column, kind: Column | None = None, places: bool = True) -> Column:
    kind = content_type(text) if kind is None else kind
    return F.when(kind == "hl7v2", hl7(text)).when(kind == "xml", xml(text)).when(kind == "fhir", fhir(text)).when(kind == "json", _ok()).otherwise(javascript(text, places))


def example(output: Column, domain: Column, bypass: Sequence[str] = BYPASS, places: bool = True) -> Column:
    """One expression for use in any plan; validated() computes each part once, which is faster on whole tables."""
    sec = security(output)
    return F.when(blank(output), _bad("structure", "Empty output")).when(~sec["passed"], sec).when(F.coalesce(domain, F.lit("")).isin(*bypass), _ok()).otherwise(by_content(output, places=places))


def validated(df: DataFrame, output: str, domain: str, to: str = "_r", bypass: Sequence[str] = BYPASS, places: bool = True) -> DataFrame:
    """df with the result of example() in a column. Each check is a column of its own that later ones read, and is made only
    for the rows that come to it: those that aren't blank, then those that aren't by-passed, then those of its kind."""
    t = F.col(output)
    at = lambda c: F.col(f"{to}_{c}")
    first = df.withColumn(f"{to}_blank", blank(t)).withColumn(f"{to}_skip", F.coalesce(F.col(domain), F.lit("")).isin(*bypass))
    first = first.withColumn(f"{to}_sec", F.when(~at("blank"), security(t)))
    go = ~at("blank") & at("sec")["passed"] & ~at("skip")
    first = first.withColumn(f"{to}_kind", F.when(go, content_type(t)))
    first = first.withColumn(f"{to}_left", F.when(at("kind") == "javascript", brackets.balance(t)))
    script = _script(at("left"), t, places)
    kinds = F.when(at("kind") == "hl7v2", hl7(t)).when(at("kind") == "xml", xml(F.when(at("kind") == "xml", t))).when(at("kind") == "fhir", fhir(t)).when(at("kind") == "json", _ok()).otherwise(script)
    result = F.when(at("blank"), _bad("structure", "Empty output")).when(~at("sec")["passed"], at("sec")).when(at("skip"), _ok()).otherwise(kinds)
    parts = [f"{to}_{c}" for c in ("blank", "skip", "sec", "kind", "left")]
    return first.withColumn(to, result).drop(*parts)


def conversation(turns: Column, domain: Column, bypass: Sequence[str] = (*BYPASS, "conversation")) -> Column:
    last = F.try_element_at(F.filter(turns, lambda t: t["role"] == "assistant"), F.lit(-1))["content"]
    failed = F.try_element_at(F.filter(F.transform(turns, lambda t: security(F.coalesce(t["content"], F.lit("")))), lambda r: ~r["passed"]), F.lit(1))
    return F.when(F.coalesce(F.size(turns), F.lit(0)) < 2, _bad("structure", "Fewer than two turns")).when(blank(last), _bad("structure", "No assistant answer")).when(failed.isNotNull(), failed).when(F.coalesce(domain, F.lit("")).isin(*bypass), _ok()).otherwise(example(last, domain, places=False))


def split(df: DataFrame, result: str) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and rows that fail with their error as _validation_error; `result` is the column that validated() adds."""
    error = F.struct(F.col(f"{result}.error_type").alias("type"), F.col(f"{result}.error_detail").alias("detail"), F.col(f"{result}.line_number").alias("line"))
    return df.where(f"{result}.passed").drop(result), df.where(f"not {result}.passed").withColumn("_validation_error", error).drop(result)


def report(df: DataFrame, result: str) -> DataFrame:
    """total, passed, failed and a map of errors by category, of rows with a result column."""
    by = df.groupBy(F.col(f"{result}.error_type").alias("k")).agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.filter(F.collect_list(F.struct("k", "n")), lambda x: x["k"].isNotNull()))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), count(F.col("k").isNull()).alias("passed"), count(F.col("k").isNotNull()).alias("failed"), F.map_from_entries(pairs).alias("errors_by_category"))


#: The categories of errors that validators give.
CATEGORIES = ("security", "structure", "syntax")


def written(df: DataFrame, result: str, path: str) -> dict:
    """Writes rows with a result column to a Parquet folder, those that pass and those that fail apart (passed=true, passed=false), and
    returns what report() would, counted while the rows were written: one scan. Rows that fail carry _validation_error."""
    flags = {c: F.col(f"{result}.error_type") == c for c in CATEGORIES}
    seen, counters = observed(df, passed=F.col(f"{result}.passed"), **flags)
    error = F.struct(F.col(f"{result}.error_type").alias("type"), F.col(f"{result}.error_detail").alias("detail"), F.col(f"{result}.line_number").alias("line"))
    out = seen.withColumn("_validation_error", F.when(~F.col(f"{result}.passed"), error)).withColumn("passed", F.col(f"{result}.passed")).drop(result)
    out.write.partitionBy("passed").parquet(path)
    got = counters.get
    return {"total": got["total"], "passed": got["passed"], "failed": got["total"] - got["passed"], "errors_by_category": {c: got[c] for c in CATEGORIES if got[c]}}
