"""Registered queries of the engine and their SQL equivalents."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .functions import literals, render, rules
from .functions.text import content_hash, jaccard, strip, truncated
from .operators import dialogue, neardup, records, report, sampling, schema, score, synthesis, teacher, validate
from .plans import flows
from .plans import session as plan_session
from .sources import files, lines
from .sources.tables import checkpoint_dir, discard, stored
from .streaming import events as stream_events
from .streaming import first as stream_first
from .streaming import sink as stream_sink

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(equivalent: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if equivalent:
            ORACLE[f.__name__] = equivalent
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Rows for what no document of the tables has: secrets beside and away from allowed text, attributions, marks of code and
#: of clarification, blank texts and languages, scripts with brackets that don't match, by-passed and not.
_MORE = [
    (-1, "en", "a number 219-09-9999 here"), (-2, "en", "SSN 219-09-9999"), (-3, "en", "password = 'hunter22'"), (-4, "en", "password = 'YOUR_OWN'"),
    (-5, "de", "api_key: \"k-81\""), (-6, "de", "the secret = 'zq81'"), (-7, "fr", "Bearer zq81.k"), (-8, "fr", "select a from t where b = '' + x"),
    (-9, "en", "As an AI language model I can't."), (-10, "es", "trained by some labs"), (-11, "en", "```\ntry it\n```"), (-12, "en", "Could you clarify? 219-09-9999"),
    (-13, "en", " \n"), (-14, " ", "\t"), (-15, " ", "x"), (-16, "en", "f(a[1)"), (-17, "math", "f(a[1)"), (-18, "fr", "if (a { b(); }"), (-19, "es", "if (a { b(); }"),
    (-22, "math", "api-key='k'"), (-23, "en", '{"resourceType":[]}'), (-24, "en", '{"resourceType":"Patient"}'),
]


def _more(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, lang and text of all documents and of _MORE."""
    return _t(spark, d, "documents").select("doc_id", "lang", "text").unionByName(spark.createDataFrame(_MORE, "doc_id long, lang string, text string"))


_MORE_SQL = "(SELECT doc_id, lang, text FROM documents UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({i}, {sql.q(k)}, E" + sql.q(t.replace("\\", "\\\\").replace("\n", "\\n").replace("\t", "\\t")).replace("''", "\\'") + ")" for i, k, t in _MORE) + "))"

_S = sql.strip("text")
_HASH = sql.content_hash("text")


@query(f"SELECT lang, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_hashes FROM (SELECT lang, {_HASH} AS h, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY lang")
def clean_summary(spark, d):
    rows = _t(spark, d, "documents").select("lang", content_hash(F.col("text")).alias("h"))
    return rows.groupBy("lang", "h").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_hashes"))


@query(f"SELECT doc_id, lang, h FROM (SELECT doc_id, lang, {_HASH} AS h, row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1")
def exact_dedup(spark, d):
    rows = _t(spark, d, "documents").where("text is not null").select("doc_id", "lang", content_hash(F.col("text")).alias("h"))
    return records.first_by(rows, F.col("h"), F.col("doc_id"))


@query(f"""SELECT count(*) AS input_rows, CAST(0 AS BIGINT) AS malformed_removed, count(*) FILTER ({_S} = '') AS empty_removed, CAST(0 AS BIGINT) AS noise_removed,
count(*) FILTER ({_S} <> '') - count(DISTINCT CASE WHEN {_S} <> '' THEN {_HASH} END) AS duplicates_removed, count(DISTINCT CASE WHEN {_S} <> '' THEN {_HASH} END) AS output_rows FROM documents""")
def dedup_stats(spark, d):
    t = F.col("text")
    return records.cleaning_stats(_t(spark, d, "documents"), t.isNull(), strip(t) == "", F.lit(False), t)


_PHRASES = ("licensed under", "released under", *records.ATTRIBUTION)


@query(f"SELECT doc_id, regexp_matches(lower(text), {sql.q('|'.join(records.ATTRIBUTION))}) AS attributed, regexp_matches(lower(text), {sql.q('|'.join(_PHRASES))}) AS with_phrases FROM {_MORE_SQL}")
def attribution_filter(spark, d):
    t = F.col("text")
    return _more(spark, d).select("doc_id", records.attributed(t).alias("attributed"), records.attributed(t, _PHRASES).alias("with_phrases"))


@query(f"SELECT doc_id FROM documents WHERE length({_S}) >= 400")
def min_length_filter(spark, d):
    return records.min_length(_t(spark, d, "documents"), "text", 400).select("doc_id")


@query(f"WITH RECURSIVE {sql.NEAR_DUPLICATES} SELECT doc_id FROM gone")
def near_dup_removed(spark, d):
    rows = records.exact_dedup(_t(spark, d, "documents").where("text is not null").select("doc_id", "lang", "text"), "text", "doc_id")
    return neardup.leaders(rows, "doc_id", "lang", "text", 0.9)


@query(f"WITH RECURSIVE {sql.NEAR_DUPLICATES} SELECT doc_id FROM gone")
def near_dup_incremental(spark, d):
    """The same rows, of three batches that are cleaned one after the other against an index of the rows that stayed."""
    rows = stored(records.exact_dedup(_t(spark, d, "documents").where("text is not null").select("doc_id", "lang", "text"), "text", "doc_id"), "rows")
    cuts = rows.selectExpr("percentile(doc_id, array(0.4, 0.8)) c").first().c or [0, 0]
    index, out = neardup.LeaderIndex(spark, f"{checkpoint_dir(spark)}/leaders-{uuid.uuid4().hex}"), []
    for k, part in enumerate((F.col("doc_id") < cuts[0], F.col("doc_id").between(*cuts), F.col("doc_id") > cuts[1])):
        out.append(index.add(rows.where(part), "doc_id", "lang", "text", k))
    discard(rows)
    return out[0].unionByName(out[1]).unionByName(out[2])


def _records(spark, d) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", F.concat(F.lit("Write about "), "source").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"), F.col("lang").alias("domain"))


_RENDERED = f"'<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || {sql.q(render.SYSTEM)} || '<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || 'Write about ' || source || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>'"
_PASSES = f"{_S} <> '' AND {sql.security('text')} IS NULL AND CASE {sql.content_type('text')} WHEN 'javascript' THEN {sql.brackets_left('text')} = '' WHEN 'json' THEN true WHEN 'fhir' THEN true ELSE false END"


@query(f"""WITH RECURSIVE {sql.NEAR_DUPLICATES}
SELECT doc_id, sha256({_RENDERED}) AS h, length({_RENDERED}) AS n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM u) AND doc_id NOT IN (SELECT doc_id FROM gone) AND NOT regexp_matches(lower('Write about ' || source || chr(10) || text), {sql.q('|'.join(records.ATTRIBUTION))}) AND {_PASSES}""")
def clean_validate_format(spark, d):
    return flows.clean_validate_format(_records(spark, d), "doc_id")[0].select("doc_id", F.sha2("text", 256).alias("h"), F.length("text").alias("n_chars"))


_CASES = [
    (1, "hl7v2", "MSH|^~\\&|A|B|C|D|20200101||ADT^A01|1|P|2.3\nEVN|A01\nPID|1\nPV1|1"),
    (2, "hl7v2", "MSH|^~\\&|A|B|C|D|20200101||ORU^R01|1|P|2.3\nPID|1\nOBX|1"),
    (3, "hl7v2", "MSH|^~\\&|A|B|C|D|20200101||XYZ|1|P|2.3"),
    (4, "xml", "<a><b>x</b></a>"),
    (5, "xml", "<a><b></a>"),
    (6, "xml", "<a/>trail"),
    (7, "fhir", '{"resourceType":"Patient","id":"1"}'),
    (8, "json", '{"id":1}'),
    (9, "javascript", "function f(a) { return [a, '(']; }"),
    (10, "javascript", "if (a { b(); }"),
    (11, "javascript", "var k = 'it\\'s'; f(`${x}`)"),
    (12, "javascript", "don't worry (it's closed"),
    (13, "javascript", "apiKey = 'zq81-prod-77'"),
    (14, "javascript", "select a from t where b = '' + x"),
    (15, "javascript", "  "),
    (16, "hl7v2", "MSH|^~\\"),
]


def _cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_CASES, "id long, expected string, text string")


def _all_cases(spark: SparkSession, d: str) -> DataFrame:
    """The inline cases, and every document's whole text under -doc_id - 1."""
    docs = _t(spark, d, "documents").select((-F.col("doc_id") - 1).alias("id"), F.lit(None).cast("string").alias("expected"), F.coalesce("text", F.lit("")).alias("text"))
    return _cases(spark).unionByName(docs)


_CASE_SQL = "(VALUES " + ", ".join(f"({i}, '{k}', E'" + t.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "')" for i, k, t in _CASES) + ") v(id, expected, text)"
_TYPE = sql.content_type("text")
_ALL_SQL = f"(SELECT CAST(id AS BIGINT) AS id, expected, text FROM {_CASE_SQL} UNION ALL SELECT -doc_id - 1, NULL, coalesce(text, '') FROM documents)"


@query(f"SELECT id, {_TYPE} AS kind FROM {_ALL_SQL}")
def content_type(spark, d):
    return _all_cases(spark, d).select("id", validate.content_type(F.col("text")).alias("kind"))


@query(f"""SELECT id, len(missing) = 0 AND starts_with(text, 'MSH|') AND length(text) >= 8 AS passed, CASE WHEN starts_with(text, 'MSH|') AND length(text) >= 8 THEN list_sort(missing) ELSE [] END AS missing
FROM (SELECT id, text, {sql.hl7_missing('text')} AS missing FROM (SELECT id, {_S} AS text FROM {_ALL_SQL}))""")
def hl7_structure(spark, d):
    r = validate.hl7(F.col("text"))
    need = F.array_sort(F.filter(F.split(F.regexp_extract(F.coalesce(r["error_detail"], F.lit("")), r"^Missing required segments for [^:]*: (.*)", 1), ", "), lambda x: x != ""))
    return _all_cases(spark, d).select("id", r["passed"].alias("passed"), need.alias("missing"))


@query(f"SELECT id, e IS NULL AS passed, e AS detail FROM (SELECT id, {sql.bracket_error('l')} AS e FROM (SELECT id, {sql.brackets_left('text')} AS l FROM {_ALL_SQL}))")
def js_balance(spark, d):
    """The place of an unmatched bracket is left out here; tests compare it with a reading one character at a time."""
    r = validate.javascript(F.col("text"))
    return _all_cases(spark, d).select("id", r["passed"].alias("passed"), F.regexp_replace(r["error_detail"], r" at position \d+\z", "").alias("detail"))


@query(f"SELECT id, id = 4 AS passed FROM {_ALL_SQL} WHERE id < 0 OR expected = 'xml'")
def xml_wf(spark, d):
    """SQL has no XML parser: of the inline cases one is well formed, and no document is XML."""
    return _all_cases(spark, d).where("id < 0 or expected = 'xml'").select("id", validate.xml(F.col("text"))["passed"].alias("passed"))


@query(f"SELECT id, json_valid(text) AND coalesce(json_extract_string(CASE WHEN json_valid(text) THEN text ELSE '{{}}' END, '$.resourceType'), '') <> '' AS passed FROM {_ALL_SQL}")
def fhir_structure(spark, d):
    return _all_cases(spark, d).select("id", validate.fhir(F.col("text"))["passed"].alias("passed"))


_EVENT = {"type": "object", "required": ["k"], "properties": {"k": {"$ref": "#/definitions/count"}}, "additionalProperties": False, "definitions": {"count": {"type": "integer", "minimum": 10, "exclusiveMaximum": 90, "not": {"enum": [20, 21]}}}}


@query("""SELECT event_id, CASE WHEN e IS NOT NULL THEN '$.k: ' || e END AS error FROM (SELECT event_id, CASE WHEN k < 10 THEN 'minimum' WHEN k >= 90 THEN 'exclusiveMaximum' WHEN k IN (20, 21) THEN 'not' END AS e
FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))""")
def schema_events(spark, d):
    return _t(spark, d, "events").select("event_id", schema.error(F.try_parse_json("props"), _EVENT).alias("error"))


@query(f"SELECT doc_id, {', '.join(f'regexp_matches(text, {sql.q(chr(40) + chr(63) + chr(105) + chr(41) + p)}) AS rule{k}' for k, (p, _) in enumerate(validate.SECRETS))}, regexp_matches(text, {sql.q('(?i)' + validate.SQL_CONCATENATION)}) AS sql_concatenation FROM {_MORE_SQL}")
def secret_flags(spark, d):
    t = F.col("text")
    return _more(spark, d).select("doc_id", *[rules.matches_any(t, [p]).alias(f"rule{k}") for k, (p, _) in enumerate(validate.SECRETS)], t.rlike(f"(?id){validate.SQL_CONCATENATION}").alias("sql_concatenation"))


@query(f"SELECT id, e IS NULL AS passed, e AS detail, CAST(n AS INTEGER) AS line FROM (SELECT id, {sql.security('text')} AS e, {sql.security_line('text')} AS n FROM {_ALL_SQL})")
def security_scan(spark, d):
    r = validate.security(F.col("text"))
    return _all_cases(spark, d).select("id", r["passed"].alias("passed"), r["error_detail"].alias("detail"), r["line_number"].alias("line"))


_ERROR_TYPE = f"CASE WHEN {_S} = '' THEN 'structure' WHEN {sql.security('text')} IS NOT NULL THEN 'security' WHEN lang IN ('math', 'es') THEN NULL WHEN {_PASSES} THEN NULL ELSE 'syntax' END"


@query(f"""SELECT CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS passed, CAST(coalesce(sum(n) FILTER (k IS NOT NULL), 0) AS BIGINT) AS failed,
'{{' || coalesce(string_agg('"' || k || '":' || n, ',' ORDER BY k) FILTER (k IS NOT NULL), '') || '}}' AS errors FROM (SELECT {_ERROR_TYPE} AS k, count(*) AS n FROM {_MORE_SQL} GROUP BY 1)""")
def validation_report(spark, d):
    rows = validate.validated(_more(spark, d), "text", "lang", bypass=("math", "es"))
    return validate.report(rows, "_r").select("total", "passed", "failed", F.to_json("errors_by_category").alias("errors"))


@query(f"SELECT doc_id, {_ERROR_TYPE} IS NULL AS passed, {_ERROR_TYPE} AS type, count(*) OVER () AS total, count(*) FILTER ({_ERROR_TYPE} IS NULL) OVER () AS n_passed, count(*) FILTER ({_ERROR_TYPE} = 'security') OVER () AS n_security FROM {_MORE_SQL}")
def validated_written(spark, d):
    """Rows written apart by whether they pass, with the counters that were taken while they were written."""
    path = f"{checkpoint_dir(spark)}/validated-{uuid.uuid4().hex}"
    rows = validate.validated(_more(spark, d), "text", "lang", bypass=("math", "es")).select("doc_id", "_r")
    counts = validate.written(rows, "_r", path)
    back = spark.read.schema("doc_id long, _validation_error struct<type:string,detail:string,line:int>, passed boolean").parquet(path)
    numbers = {"total": counts["total"], "n_passed": counts["passed"], "n_security": counts["errors_by_category"].get("security", 0)}
    return back.select("doc_id", "passed", F.col("_validation_error.type").alias("type"), *[F.lit(n).cast("long").alias(k) for k, n in numbers.items()])


@query(f"SELECT doc_id, {_ERROR_TYPE} AS type, CASE {_ERROR_TYPE} WHEN 'structure' THEN 'Empty output' WHEN 'security' THEN {sql.security('text')} ELSE {sql.bracket_error(sql.brackets_left('text'))} END AS detail FROM {_MORE_SQL} WHERE {_ERROR_TYPE} IS NOT NULL")
def validation_failures(spark, d):
    rows = validate.validated(_more(spark, d), "text", "lang", bypass=("math", "es"))
    e = F.col("_validation_error")
    return validate.split(rows, "_r")[1].select("doc_id", e["type"].alias("type"), F.regexp_replace(e["detail"], r" at position \d+\z", "").alias("detail"))


@query(f"SELECT id, CASE WHEN {_S} = '' THEN 'structure' WHEN {sql.security('text')} IS NOT NULL THEN 'security' WHEN kind = 'hl7v2' THEN CASE WHEN length({_S}) < 8 OR len({sql.hl7_missing(_S)}) > 0 THEN 'structure' END WHEN kind = 'xml' THEN CASE WHEN id <> 4 THEN 'syntax' END WHEN kind = 'javascript' AND {sql.brackets_left('text')} <> '' THEN 'syntax' END AS error_type FROM (SELECT *, {_TYPE} AS kind FROM {_ALL_SQL})")
def validate_examples(spark, d):
    """Both forms of the check, over the inline cases and all documents; they agree."""
    rows = validate.validated(_all_cases(spark, d).withColumn("domain", F.lit("hl7v2")), "text", "domain")
    one = validate.example(F.col("text"), F.col("domain"))
    return rows.select("id", F.when(F.col("_r.passed") == one["passed"], F.col("_r.error_type")).otherwise("disagree").alias("error_type"))


_LEAK = f"regexp_matches(text, {sql.q('(?i)' + '|'.join(f'(?:{p})' for p in validate.LOG_LEAKS))})"
_LOG_CASES = [(-1, "```\nconsole.log(patient.ssn)\n```"), (-2, "console.log(patient.ssn)"), (-3, "def f(): print('x', patient.name)"), (-4, "function f() { logger.info(patient.age) }")]


@query(f"""SELECT doc_id, {_LEAK} AS unsafe, NOT (code AND {_LEAK}) AS is_safe, sha256(CASE WHEN code AND {_LEAK} THEN text || {sql.q(validate.LOG_WARNING)} ELSE text END) AS h
FROM (SELECT *, {' OR '.join(f'contains(text, {sql.q(m)})' for m in validate.CODE_MARKS)} AS code FROM (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {', '.join(f'({i}, {sql.q(t)})' for i, t in _LOG_CASES)})))""")
def unsafe_logs(spark, d):
    t = F.col("text")
    scan = validate.log_scan(t)
    rows = _t(spark, d, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(_LOG_CASES, "doc_id long, text string"))
    return rows.select("doc_id", validate.unsafe_log(t).alias("unsafe"), scan["is_safe"].alias("is_safe"), F.sha2(scan["text"], 256).alias("h"))


@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'), '^ +| +$', '', 'g') AS text FROM pages")
def html_regex_text(spark, d):
    return _t(spark, d, "pages").select("page_id", files.html_plain(F.col("html")).alias("text"))


_BLOCKS = f"list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, {sql.q('(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<nav[^>]*>.*?</nav>|<footer[^>]*>.*?</footer>|<header[^>]*>.*?</header>')}, chr(1), 'g'), '<[^>]+>', chr(1), 'g'), chr(1)), lambda x: {sql.strip('x')}), lambda x: x <> '')"


@query(f"SELECT page_id, replace(replace(replace(replace(replace(array_to_string({_BLOCKS}, chr(10)), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&') AS text FROM pages")
def html_block_text(spark, d):
    return _t(spark, d, "pages").select("page_id", files.html_blocks(F.col("html")).alias("text"))


@query("SELECT page_id, CASE WHEN contains(lower(substr(html, 1, 5000)), 'msh|') OR contains(lower(url), 'msh|') OR contains(lower(substr(html, 1, 5000)), 'hl7v2') OR contains(lower(url), 'hl7v2') OR contains(lower(substr(html, 1, 5000)), 'pid|') OR contains(lower(url), 'pid|') THEN 'hl7v2' WHEN contains(lower(substr(html, 1, 5000)), 'resourcetype') OR contains(lower(url), 'resourcetype') OR contains(lower(substr(html, 1, 5000)), 'fhir') OR contains(lower(url), 'fhir') THEN 'fhir' WHEN contains(lower(substr(html, 1, 5000)), 'http') OR contains(lower(url), 'http') OR contains(lower(substr(html, 1, 5000)), 'html') OR contains(lower(url), 'html') THEN 'web' WHEN contains(lower(substr(html, 1, 5000)), 'select ') OR contains(lower(url), 'select ') OR contains(lower(substr(html, 1, 5000)), 'table') OR contains(lower(url), 'table') THEN 'data' ELSE 'general' END AS domain FROM pages")
def domain_detect(spark, d):
    return _t(spark, d, "pages").select("page_id", rules.detect_domain(F.col("html"), F.col("url")).alias("domain"))


@query("""SELECT source, string_agg(part, chr(10) || '---' || chr(10) ORDER BY doc_id) AS context, count(*) AS n_parts FROM (
SELECT source, doc_id, substr(text, 1, 2000) AS part, coalesce(sum(length(substr(text, 1, 2000))) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 6000 GROUP BY source""")
def context_pack(spark, d):
    return files.context_pack(_t(spark, d, "documents"), "source", "doc_id", "text")


def _turns(spark, d) -> DataFrame:
    t = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    return t.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("turns"))


@query(f"SELECT conv_id, sha256(lower({sql.strip('t')})) AS h FROM (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id)")
def conv_hash(spark, d):
    return _turns(spark, d).select("conv_id", records.conversation_hash(F.col("turns")).alias("h"))


@query("SELECT conv_id, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def last_assistant_turn(spark, d):
    return _t(spark, d, "conversations").where("role = 'assistant'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("answer"))


_CONV = f"""
t AS (SELECT conv_id, turn, role, text, {sql.security('coalesce(text, chr(32))')} AS e FROM conversations),
c AS (SELECT conv_id, count(*) AS n, arg_max(text, turn) FILTER (role = 'assistant') AS last, arg_min(e, turn) FILTER (e IS NOT NULL) AS e FROM t GROUP BY conv_id),
v AS (SELECT *, CASE WHEN n < 2 THEN 'structure' WHEN {sql.strip("coalesce(last, '')")} = '' THEN 'structure' WHEN e IS NOT NULL THEN 'security' WHEN {sql.brackets_left('last')} <> '' THEN 'syntax' END AS error_type FROM c)"""


@query(f"""WITH {_CONV} SELECT conv_id, error_type IS NULL AS passed, error_type,
CASE WHEN n < 2 THEN 'Fewer than two turns' WHEN {sql.strip("coalesce(last, '')")} = '' THEN 'No assistant answer' WHEN e IS NOT NULL THEN e ELSE {sql.bracket_error(sql.brackets_left('last'))} END AS detail FROM v""")
def conv_validate(spark, d):
    r = validate.conversation(F.col("turns"), F.lit("hl7v2"))
    return _turns(spark, d).select("conv_id", r["passed"].alias("passed"), r["error_type"].alias("error_type"), r["error_detail"].alias("detail"))


@query("SELECT conv_id, '<|begin_of_text|>' || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>', '' ORDER BY turn) || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) AS text FROM conversations GROUP BY conv_id")
def render_llama(spark, d):
    return _turns(spark, d).select("conv_id", render.inference_prompt(F.col("turns")).alias("text"))


@query(f"SELECT conv_id, '<|im_start|>system' || chr(10) || '{render.SYSTEM}<|im_end|>' || chr(10) || string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def render_chatml(spark, d):
    return _turns(spark, d).select("conv_id", render.dialogue(F.col("turns"), "chatml").alias("text"))


@query(f"SELECT doc_id, '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || '{render.SYSTEM}<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || source || CASE WHEN lang <> '' THEN chr(10) || chr(10) || lang ELSE '' END || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>' AS text FROM documents")
def single_turn_render(spark, d):
    return _t(spark, d, "documents").select("doc_id", render.single_turn(F.col("source"), F.col("lang"), F.col("text")).alias("text"))


@query("SELECT doc_id, trim(source) AS prompt FROM documents")
def prompt_extraction(spark, d):
    text = render.single_turn(F.col("source"), F.lit(""), F.col("text"))
    return _t(spark, d, "documents").select("doc_id", render.user_prompt(text).alias("prompt"))


_DIALOGUES = f"""WITH t AS (SELECT conv_id, string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn) AS x FROM conversations WHERE role <> 'system' GROUP BY conv_id),
l AS (SELECT conv_id, unnest(string_split(x, chr(10))) AS line, generate_subscripts(string_split(x, chr(10)), 1) AS pos FROM t),
m AS (SELECT *, {sql.strip('line')} AS s, CASE WHEN starts_with(upper({sql.strip('line')}), 'USER:') THEN 'user' WHEN starts_with(upper({sql.strip('line')}), 'ASSISTANT:') THEN 'assistant' END AS role FROM l),
g AS (SELECT *, count(role) OVER (PARTITION BY conv_id ORDER BY pos) AS turn FROM m),
u AS (SELECT conv_id, turn, max(role) AS role, {sql.strip("string_agg(CASE role WHEN 'user' THEN " + sql.strip('substr(s, 6)') + " WHEN 'assistant' THEN " + sql.strip('substr(s, 11)') + " ELSE line END, chr(10) ORDER BY pos)")} AS content FROM g WHERE turn > 0 GROUP BY conv_id, turn),
v AS (SELECT conv_id, max(turn) AS n, arg_min(role, turn) AS first, arg_max(role, turn) AS last FROM u GROUP BY conv_id)
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_turns, sha256(string_agg(role || chr(10) || content || chr(10), '' ORDER BY turn)) AS h
FROM u JOIN v USING (conv_id) WHERE first = 'user' AND n >= 2 AND NOT (turn = n AND last = 'user') GROUP BY conv_id HAVING count(*) >= 2 AND bool_and(content <> '')"""


def _marked(spark, d) -> DataFrame:
    """conv_id and text: conversations as marked dialogues."""
    c = _t(spark, d, "conversations").where("role <> 'system'")
    line = F.concat(F.upper("role"), F.lit(": "), "text")
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))


@query(_DIALOGUES)
def dialogue_parse(spark, d):
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), "")
    return dialogue.parse(_marked(spark, d), "conv_id", "text").select("conv_id", F.size("turns").alias("n_turns"), F.sha2(whole, 256).alias("h"))


@query(_DIALOGUES)
def sql_dialogue_turns(spark, d):
    """The same from SQL text, with turns as rows of a table function."""
    plan_session.register(spark)
    turns = "SELECT conv_id, t.* FROM {marked}, LATERAL dialogue_turns(text) t"
    return spark.sql(f"SELECT conv_id, CAST(count(*) AS INT) AS n_turns, sha2(array_join(transform(array_sort(collect_list(struct(turn, role, content))), x -> x.role || '\n' || x.content || '\n'), ''), 256) AS h FROM ({turns}) GROUP BY conv_id", marked=_marked(spark, d))


_Q = f"least(1.0, greatest(0.0, 0.5 + CASE WHEN length({_S}) > 100 THEN 0.15 ELSE 0 END + CASE WHEN length({_S}) > 500 THEN 0.1 ELSE 0 END + CASE WHEN contains({_S}, '```') OR contains({_S}, 'function ') OR contains({_S}, 'def ') THEN 0.1 ELSE 0 END + CASE WHEN contains({_S}, '//') OR contains({_S}, '#') OR contains({_S}, '/*') THEN 0.1 ELSE 0 END - CASE WHEN length({_S}) < 50 THEN 0.2 ELSE 0 END))"


@query(f"SELECT doc_id, CAST(round({_Q}, 6) AS DOUBLE) AS score FROM documents")
def quality_score(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.round(score.quality(F.col("text"), F.lit(True)), 6).alias("score"))


_APPLIES = f"regexp_matches({_S}, '[{{}}()\\[\\]]')"


@query(f"""SELECT id, CASE WHEN {_S} = '' THEN 0.0 WHEN NOT ({_APPLIES} OR kind IN ('xml', 'hl7v2', 'fhir') OR starts_with({_S}, 'MSH|')) THEN 0.5
ELSE least(1.0, CASE WHEN {_APPLIES} AND {sql.brackets_left(_S)} = '' THEN 0.25 ELSE 0.0 END + CASE WHEN id = 4 THEN 0.25 ELSE 0.0 END
  + CASE WHEN starts_with({_S}, 'MSH|') AND length({_S}) >= 8 AND len({sql.hl7_missing(_S)}) = 0 THEN 0.25 ELSE 0.0 END + CASE WHEN kind = 'fhir' THEN 0.25 ELSE 0.0 END) END::DOUBLE AS reward
FROM (SELECT *, {_TYPE} AS kind FROM {_ALL_SQL})""")
def reward_score(spark, d):
    return _all_cases(spark, d).select("id", score.reward(F.col("text")).alias("reward"))


@query("""SELECT source, arg_max(doc_id, (length(text), -doc_id)) AS chosen, arg_min(doc_id, (length(text), -doc_id)) AS rejected, max(length(text)) AS best, min(length(text)) AS worst FROM documents GROUP BY source HAVING count(*) >= 2 AND max(length(text)) > min(length(text))""")
def best_of_n(spark, d):
    rows = _t(spark, d, "documents").select("source", "doc_id", F.length("text").alias("score"))
    return score.best_of(rows, "source", "doc_id", "score", "doc_id")


@query(f"""WITH l AS (SELECT d.doc_id, trim(d.source) AS k, d.text, l.quality FROM documents d JOIN labels l USING (doc_id)),
p AS (SELECT k, arg_min(text, doc_id) AS chosen FROM l WHERE quality = 1 AND k <> '' AND {_S} <> '' GROUP BY k)
SELECT l.k AS prompt, sha256(p.chosen) AS chosen, sha256({sql.strip("l.text")}) AS rejected FROM l JOIN p USING (k) WHERE quality = 0 AND {sql.strip("l.text")} <> ''""")
def preference_pairs(spark, d):
    rows = _t(spark, d, "documents").join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id").select("doc_id", F.col("source").alias("instruction"), F.col("text").alias("output"), "quality")
    p = score.preference_pairs(rows.where("quality = 1"), rows.where("quality = 0"), "doc_id")
    return p.select("prompt", F.sha2("chosen", 256).alias("chosen"), F.sha2("rejected", 256).alias("rejected"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents) WHERE r <= round_even(n * 0.2, 0)")
def sample_20pct(spark, d):
    return sampling.exact_fraction(_t(spark, d, "documents").select("doc_id"), "doc_id", 0.2)


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents) WHERE r <= CASE lang WHEN 'en' THEN 60 WHEN 'de' THEN 20 WHEN 'fr' THEN 10 ELSE 0 END")
def stratified_quota(spark, d):
    return sampling.stratified(_t(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang", {"en": 60, "de": 20, "fr": 10})


@query("SELECT source, target, CAST(target - have AS INTEGER) AS remaining, CAST(unnest(range(1, target - have + 1)) AS INTEGER) AS item FROM (SELECT source, 200 AS target, count(*) AS have FROM documents GROUP BY source) WHERE target > have")
def quota_plan(spark, d):
    docs = _t(spark, d, "documents").select("source")
    return sampling.quota_plan(docs.distinct().withColumn("target", F.lit(200)), docs, ["source"])


@query("SELECT DISTINCT user_id, event_type FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND f.value > 50)")
def resume_anti(spark, d):
    e = _t(spark, d, "events")
    return sampling.not_done(e.select("user_id", "event_type").distinct(), e.where("value > 50"), ["user_id", "event_type"])


@query("SELECT a.r_name || ' ' || b.n_name AS prompt FROM region a CROSS JOIN nation b")
def template_cross(spark, d):
    rows = sampling.crossed(_t(spark, d, "region").select("r_name"), _t(spark, d, "nation"), "n_name")
    return rows.select(F.concat("r_name", F.lit(" "), "n_name").alias("prompt"))


_KINDS, _UNITS = ("ADT", "ORU", "ORM"), ("ICU", "ER")


@query(f"SELECT doc_id, 'Convert ' || {sql.pick(_KINDS, chr(39) + 'kind:1:' + chr(39) + ' || doc_id')} || ' to ' || {sql.pick(_KINDS, chr(39) + 'kind:3:' + chr(39) + ' || doc_id')} || ' for ' || {sql.pick(_UNITS, chr(39) + 'unit:5:' + chr(39) + ' || doc_id')} AS prompt FROM documents")
def template_fill(spark, d):
    filled = rules.fill_template(F.lit("Convert {kind} to {kind} for {unit}"), {"kind": _KINDS, "unit": _UNITS}, F.col("doc_id"))
    return _t(spark, d, "documents").select("doc_id", filled.alias("prompt"))


_NUMBERS = {"dose": ("decimal", 0.5, 20, 1), "weight": ("int", 40, 120), "days": ("choice", (30, 90, 180)), "list": ("sorted", 3, 1, 50)}


def _between_sql(lo: int, hi: int, seed: str) -> str:
    return f"({sql.drawn(seed)} % {hi - lo + 1} + {lo})"


@query(f"""SELECT doc_id, 'A dose of ' || printf('%.1f', ({_between_sql(0, 195, "'dose:' || doc_id")} + 5) / 10.0) || ' at ' || {_between_sql(40, 120, "'weight:' || doc_id")} || ' kg for ' || {sql.pick(('30', '90', '180'), "'days:' || doc_id")} || ' days, not ' || {sql.pick(('30', '90', '180'), "'days:' || doc_id")} || ': ' || array_to_string(list_sort([{', '.join(_between_sql(1, 50, f"'list{k}:' || doc_id") for k in range(3))}]), ', ') AS prompt,
'{{dose}} of {{what}}' AS kept FROM documents""")
def numeric_fill(spark, d):
    filled = rules.fill_numbers("A dose of {dose} at {weight} kg for {days} days, not {days}: {list}", _NUMBERS, F.col("doc_id"))
    return _t(spark, d, "documents").select("doc_id", filled.alias("prompt"), rules.fill_numbers("{dose} of {what}", _NUMBERS, F.col("doc_id")).alias("kept"))


@query("SELECT doc_id, replace(replace(text, 'the ', 'THE '), 'THE a', 'A') AS text FROM documents")
def ordered_replacement(spark, d):
    return _t(spark, d, "documents").select("doc_id", rules.replace_all(F.col("text"), (("the ", "THE "), ("THE a", "A"))).alias("text"))


#: Sixty rules whose literals share their spaces, and some that later ones make.
_LITTLE = "the of and to in is that it with as for by on this be at from or are an le la de et les des en un que qui pour dans der die und den von mit ist das zu ein el los y por con una las se del".split()
_MANY = [*((f" {w} ", f" {w.upper()} ") for w in _LITTLE), (" THE OF ", " OF THE "), ("IN T", "in, t"), ("S E", "s-e"), ("nothing of that kind", ""), ("-e", ""), (" OF THE ", " of the "), ("re", "er"), ("er", "RE"), ("RER", "r")]


@query(f"SELECT doc_id, sha256({reduce(lambda t, p: f'replace({t}, {sql.q(p[0])}, {sql.q(p[1])})', _MANY, 'text')}) AS h FROM documents")
def many_replacements(spark, d):
    """Sixty ordered rules by one automaton."""
    return _t(spark, d, "documents").select("doc_id", F.sha2(literals.replaced(F.col("text"), _MANY), 256).alias("h"))


_GROUPS = {"attributed": ("licensed under", "released under", "as an ai language model", "trained by"), "identity": ("who made you", "could you", "tell me"), "code": ("```", "select ", "def ", "return "), "secret": ("password", "api_key", "api-key", "bearer ", "secret"), "common": ("with", " la ", " un ")}


@query(f"SELECT doc_id, {', '.join('(' + ' OR '.join(f'contains(lower(text), {sql.q(x)})' for x in xs) + f') AS {g}' for g, xs in _GROUPS.items())} FROM {_MORE_SQL}")
def literal_groups(spark, d):
    """Which of five groups of literals stand in each text, by one automaton."""
    return _more(spark, d).select("doc_id", literals.occurring(F.lower("text"), _GROUPS).alias("g")).select("doc_id", "g.*")


def _responses(spark, d) -> DataFrame:
    return _t(spark, d, "events").select(F.col("event_type").alias("category"), F.when(F.col("value") > 5, "ok").otherwise("error").alias("status"), F.col("value").alias("latency_sec"), F.length("props").alias("response_length"), F.col("props").contains("1").alias("has_code"))


_R = "(SELECT event_type AS category, CASE WHEN value > 5 THEN 'ok' ELSE 'error' END AS status, value AS latency_sec, length(props) AS response_length, contains(props, '1') AS has_code FROM events)"


@query(f"SELECT category, count(*) AS n, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status <> 'ok') AS n_err, round(avg(latency_sec) FILTER (status = 'ok'), 6) AS avg_latency, round(avg(response_length) FILTER (status = 'ok'), 6) AS avg_length, round(avg(CAST(has_code AS INTEGER)) FILTER (status = 'ok'), 6) AS code_rate, count(*) FILTER (status = 'ok' AND response_length < 300) AS n_short FROM {_R} GROUP BY category")
def category_report(spark, d):
    r = report.by_category(_responses(spark, d))
    return r.withColumns({c: F.round(c, 6) for c in ("avg_latency", "avg_length", "code_rate")})


@query(f"SELECT round(count(*) FILTER (has_code) / greatest(count(*), 1), 6) AS code, round(count(*) FILTER (status = 'ok' AND category = 'click') / greatest(count(*) FILTER (category = 'click'), 1), 6) AS ok_clicks FROM {_R}")
def key_metrics(spark, d):
    r = report.rates(_responses(spark, d), {"code": F.col("has_code"), "ok_clicks": F.col("status") == "ok"}, {"ok_clicks": ("click",)})
    return r.select(F.round("code", 6).alias("code"), F.round("ok_clicks", 6).alias("ok_clicks"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (NOT contains(lower(text), 'the')) AS n_missing FROM documents")
def containment_check(spark, d):
    return report.missing_phrase(_t(spark, d, "documents"), "text", "the")


@query("SELECT CAST(count(*) AS BIGINT) AS n, count(*) FILTER (status = 'ok') AS n_ok, round(avg(latency_sec) FILTER (status = 'ok'), 6) AS avg_latency, round(avg(response_length) FILTER (status = 'ok'), 6) AS avg_length, round(avg(completion_tokens) FILTER (status = 'ok'), 6) AS avg_tokens, round(100 * avg(CAST(has_code AS INTEGER)) FILTER (status = 'ok'), 6) AS code_pct FROM (SELECT *, response_length // 4 AS completion_tokens FROM " + _R + ")")
def overall_report(spark, d):
    r = report.overall(_responses(spark, d).withColumn("completion_tokens", F.floor(F.col("response_length") / 4)))
    return r.select("n", "n_ok", *[F.round(c, 6).alias(c) for c in ("avg_latency", "avg_length", "avg_tokens", "code_pct")])


_SIDES = {"click": "active", "purchase": "active"}


@query("SELECT CASE GROUPING(category, side) WHEN 3 THEN 'overall' WHEN 2 THEN 'side' ELSE 'category' END AS level, category, side, count(*) AS n, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status <> 'ok') AS n_err, round(avg(latency_sec) FILTER (status = 'ok'), 6) AS avg_latency, round(avg(CAST(has_code AS INTEGER)), 6) AS code_rate FROM (SELECT *, CASE WHEN category IN ('click', 'purchase') THEN 'active' ELSE 'passive' END AS side FROM " + _R + ") GROUP BY GROUPING SETS ((), (side), (category))")
def metrics_by_level(spark, d):
    """Overall, group and category metrics of one scan."""
    rows = _responses(spark, d).withColumn("side", F.when(F.col("category").isin(*_SIDES), "active").otherwise("passive"))
    ok = F.col("status") == "ok"
    metrics = {"n": F.count("*"), "n_ok": F.count_if(ok), "n_err": F.count_if(~ok), "avg_latency": F.round(F.avg(F.when(ok, F.col("latency_sec"))), 6), "code_rate": F.round(F.avg(F.col("has_code").cast("double")), 6)}
    return report.by_sets(rows, {"overall": (), "side": ("side",), "category": ("category",)}, metrics).select("level", "category", "side", *metrics)


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def counts_by_domain(spark, d):
    return report.counted(_t(spark, d, "documents"), "source", "lang")


@query("SELECT doc_id, CAST(doc_id AS VARCHAR) AS instruction, '' AS input, sha256(coalesce(text, '')) AS output FROM documents")
def coerced_records(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.col("doc_id").alias("instruction"), F.lit(None).cast("int").alias("input"), F.col("text").alias("output"))
    return records.single_turn(rows).withColumn("output", F.sha2("output", 256))


@query("SELECT conv_id, CASE WHEN count(*) >= 2 THEN CAST(count(*) AS INTEGER) END AS n_turns, CASE WHEN count(*) >= 2 THEN sha256(string_agg(role || chr(10) || text, chr(10) ORDER BY turn)) END AS h FROM conversations GROUP BY conv_id")
def conv_normalise(spark, d):
    """Conversations as JSON records, and back."""
    turns = records.conversation_from_json(F.to_json(F.struct("turns")))
    whole = F.array_join(F.transform(turns, lambda t: F.concat_ws("\n", t["role"], t["content"])), "\n")
    return _turns(spark, d).select("conv_id", F.when(turns.isNotNull(), F.size(turns)).alias("n_turns"), F.sha2(whole, 256).alias("h"))


@query(f"SELECT doc_id, {_S} = '' AS blank_output, {_S} = '' AND {sql.strip('lang')} = '' AS empty FROM {_MORE_SQL}")
def empty_records(spark, d):
    return _more(spark, d).select("doc_id", records.is_empty(F.lit(" "), F.col("text")).alias("blank_output"), records.is_empty(F.col("lang"), F.col("text")).alias("empty"))


#: Conversations of one turn, of blank turns, without a role, with an attribution, and that ask who answers.
_MORE_TURNS = [(-1, 0, "user", "alone"), (-2, 0, "user", " "), (-2, 1, "assistant", "yes"), (-3, 0, None, "who speaks"), (-3, 1, "user", "I do"), (-4, 0, "user", "go on"), (-4, 1, "assistant", "I am an AI model"), (-5, 0, "user", "Who are the people?"), (-5, 1, "assistant", "many"), (-6, 0, "user", "Is askme like that? " * 9), (-7, 0, "user", "what do you do")]
_CONVERSATIONS = "(SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({c}, {n}, {sql.q(r) if r else 'NULL'}, {sql.q(t)})" for c, n, r, t in _MORE_TURNS) + "))"


def _more_turns(spark, d) -> DataFrame:
    more = spark.createDataFrame(_MORE_TURNS, "conv_id long, turn int, role string, content string").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("t"))
    return _turns(spark, d).unionByName(more.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("turns")))


@query(f"SELECT conv_id, count(*) FILTER ({_S} <> '') < 2 AS empty, count(*) >= 2 AND bool_and(role IS NOT NULL) AS ok, regexp_matches(lower(string_agg(text, chr(10) ORDER BY turn)), {sql.q('|'.join(_PHRASES))}) AS attributed, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS last_user FROM {_CONVERSATIONS} GROUP BY conv_id")
def conversation_flags(spark, d):
    t = F.col("turns")
    return _more_turns(spark, d).select("conv_id", records.conversation_empty(t).alias("empty"), records.conversation_ok(t).alias("ok"), records.conversation_attributed(t, _PHRASES).alias("attributed"), records.last_content(t).alias("last_user"))


_TRIGGERS, _MODELS = ("who made you", "your name", "introduce yourself"), ("helperbot", "askme")


@query(f"SELECT conv_id, {' OR '.join(f'contains(lower(last), {sql.q(x)})' for x in (*_TRIGGERS, *_MODELS))} OR (length(last) < 100 AND (contains(lower(last), ' you ') OR contains(lower(last), ' your ') OR starts_with(lower(last), 'who are') OR starts_with(lower(last), 'what are') OR starts_with(lower(last), 'tell me about'))) AS identity FROM (SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS last FROM {_CONVERSATIONS} GROUP BY conv_id)")
def identity_questions(spark, d):
    return _more_turns(spark, d).select("conv_id", rules.asks_identity(records.last_content(F.col("turns")), _TRIGGERS, _MODELS).alias("identity"))


@query("SELECT doc_id, sha256(CASE WHEN contains(lower(substr(text, 1, 200)), 'the') THEN text ELSE 'In short: ' || text END) AS h FROM documents")
def conditional_intro(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.sha2(rules.with_intro(F.col("text"), "the", "In short: "), 256).alias("h"))


_PREFIXES = ("As asked, ", "In brief: ", "One way is: ")


@query(f"SELECT doc_id, sha256(CASE WHEN contains(text, ' the ') THEN text ELSE {sql.pick(_PREFIXES, chr(39) + 'prefix:' + chr(39) + ' || doc_id')} || text END) AS h FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents) WHERE r <= round_even(n * 0.2, 0)")
def inject_prefix(spark, d):
    """A fifth of the rows, with a drawn prefix unless they have the brand already."""
    rows = sampling.exact_fraction(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", 0.2)
    return rows.select("doc_id", F.sha2(rules.with_prefix(F.col("text"), " the ", _PREFIXES, F.lit("prefix"), F.col("doc_id")), 256).alias("h"))


@query("SELECT doc_id, sha256(substr(text, 1, 300)) AS preview, sha256(substr(text, 1, 120)) AS prompt, length(substr(text, 1, 4000)) AS context FROM documents")
def truncations(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", F.sha2(truncated(t, 300), 256).alias("preview"), F.sha2(truncated(t, 120), 256).alias("prompt"), F.length(truncated(t, 4000)).cast("long").alias("context"))


@query(f"SELECT doc_id, contains(text, '```') AS has_code, regexp_matches(lower(text), 'try|catch|except') AS has_error_handling, regexp_matches(lower(text), 'could you clarify|can you provide|which version') AS has_clarification, regexp_matches(text, '\\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\\b') AS has_leak FROM {_MORE_SQL}")
def feature_flags(spark, d):
    return _more(spark, d).select("doc_id", *[c.alias(k) for k, c in rules.flags(F.col("text")).items()])


@query("SELECT doc_id, regexp_matches(lang || '-' || doc_id || '.txt', '^([de].-.*1|.*[^0-4]\\.txt)') AND regexp_matches(lang || '-' || doc_id || '.txt', '^[de].-.*1.*$|^[^/]*[^0-4]\\.txt$') AS hit FROM documents")
def glob_paths(spark, d):
    path = F.concat(F.lit("some/"), "source", F.lit("/"), "lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return _t(spark, d, "documents").select("doc_id", rules.glob_match(path, ["[de]?-*1*", "*[!0-4].txt"]).alias("hit"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE 'Explain this ' || lang || ' file: ' || source END AS instruction FROM documents")
def fallback_instructions(spark, d):
    given = F.when(F.col("doc_id") % 3 == 0, F.col("source")).when(F.col("doc_id") % 3 == 1, F.lit("  "))
    return _t(spark, d, "documents").select("doc_id", files.fallback_instruction(given, F.col("lang"), F.col("source")).alias("instruction"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'x ' || {sql.strip('source')} END AS trace, sha256(CASE WHEN doc_id % 2 = 0 THEN {_S} ELSE source || text END) AS answer FROM documents")
def cot_split(spark, d):
    parts = render.split_cot(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("x <think>"), "source", F.lit("</think>\n"), "text")).otherwise(F.concat("source", "text")))
    return _t(spark, d, "documents").select("doc_id", parts["trace"].alias("trace"), F.sha2(parts["answer"], 256).alias("answer"))


@query("SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)[0-9]{4}-[0-9]{4}|licensed under')")
def private_drop(spark, d):
    """Patterns that aren't regular expressions are left out with a warning."""
    return _t(spark, d, "documents").where(~rules.matches_any(F.col("text"), ["[0-9]{4}-[0-9]{4}", "Licensed Under", "(open"])).select("doc_id")


@query("""WITH w AS (SELECT doc_id, list_distinct(string_split(text, ' ')) AS w FROM documents)
SELECT a.doc_id, round(CASE WHEN len(list_distinct(list_concat(a.w, b.w))) = 0 THEN 1.0 ELSE len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) END, 9) AS similarity FROM w a JOIN w b ON b.doc_id = a.doc_id + 1""")
def neighbour_jaccard(spark, d):
    w = _t(spark, d, "documents").select("doc_id", F.split("text", " ").alias("w"))
    return w.join(w.select((F.col("doc_id") - 1).alias("doc_id"), F.col("w").alias("v")), "doc_id").select("doc_id", F.round(jaccard(F.col("w"), F.col("v")), 9).alias("similarity"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 25")
def per_source_cap(spark, d):
    return records.capped(_t(spark, d, "documents").select("doc_id", "source"), "source", 25, "doc_id")


@query("""WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS r, count(*) OVER () AS n FROM embeddings)
SELECT vec_id, CAST(unnest(range(1, CAST(1234 // n + CASE WHEN r <= 1234 % n THEN 2 ELSE 1 END AS BIGINT))) AS INTEGER) AS copy FROM r""")
def cycled_rows(spark, d):
    return sampling.cycled(_t(spark, d, "embeddings").select("vec_id"), "vec_id", 1234)


@query("SELECT source, CAST(1000 // n + CASE WHEN r <= 1000 % n THEN 1 ELSE 0 END AS INTEGER) AS quota FROM (SELECT source, row_number() OVER (ORDER BY source) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents))")
def balanced_quotas(spark, d):
    return sampling.balanced(_t(spark, d, "documents").select("source").distinct(), 1000, "source")


@query("SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'large' ELSE 'small' END AS model, 'large' AS alone FROM documents")
def model_routes(spark, d):
    kind = F.when(F.length("text") > 2000, "complex").otherwise("simple")
    return _t(spark, d, "documents").select("doc_id", sampling.route(kind, "large", "small").alias("model"), sampling.route(kind, "large", None).alias("alone"))


@query("SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 100")
def top_by_path(spark, d):
    return sampling.top(_t(spark, d, "documents").select("doc_id", "source"), 100, "source", "doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS place FROM documents")
def shuffled_order(spark, d):
    """The seeded order; the place of a row is found by counting, for the comparison only."""
    rows = sampling.shuffled(_t(spark, d, "documents").select("doc_id"), "doc_id", 7)
    return sampling.numbered(rows, "doc_id", 7)


@query("SELECT prompt FROM (SELECT DISTINCT source || ' ' || lang AS prompt FROM documents) ORDER BY md5('42:' || prompt), prompt LIMIT 40")
def distinct_prompts(spark, d):
    return synthesis.distinct_prompts(_t(spark, d, "documents").select(F.concat_ws(" ", "source", "lang").alias("prompt")), "prompt", 40)


_VARIED = " UNION ALL ".join(f"SELECT {sql.q(prefix)} || {'rtrim(regexp_replace(lower(text), ' + sql.q('[?!.]+$') + ', ' + sql.q('') + '))' if when == 'bare' else 'lower(text)'} FROM benchmark WHERE {'ends_with(text, ' + sql.q('?') + ')' if when == 'question' else 'NOT starts_with(text, ' + sql.q(prefix.strip(' ,:')) + ')'}" for prefix, when in rules.VARIANTS)


@query(f"""WITH v AS (SELECT DISTINCT text FROM (SELECT text FROM benchmark UNION ALL {_VARIED}) WHERE text IS NOT NULL), r AS (SELECT text, row_number() OVER (ORDER BY md5('42:' || text), text) AS r, count(*) OVER () AS n FROM v)
SELECT text, CAST(unnest(range(1, CAST(900 // n + CASE WHEN r <= 900 % n THEN 2 ELSE 1 END AS BIGINT))) AS INTEGER) AS copy FROM r""")
def prompt_variations(spark, d):
    return synthesis.varied_prompts(_t(spark, d, "benchmark").where("text is not null"), "text", 900)


@query(f"""WITH p AS (SELECT 'mapping' AS category, i AS item, 'Map ' || {sql.pick(_KINDS, "'kind:1:42:mapping:' || i")} AS prompt, 'hl7' AS domain FROM range(300) t(i)
UNION ALL SELECT 'dosing', i, 'Give ' || {_between_sql(40, 120, "'weight:42:dosing:' || i")} || ' mg', 'math' FROM range(200) t(i))
SELECT * FROM p ORDER BY md5('42:' || category || ':' || item), category || ':' || item LIMIT 350""")
def prompt_plan(spark, d):
    kinds = [("mapping", "hl7", 300, ["Map {kind}"], {"kind": _KINDS}), ("dosing", "math", 200, ["Give {weight} mg"], {"weight": ("int", 40, 120)})]
    return synthesis.prompt_plan(spark, kinds, 400, existing=50)


_SEEDS = {"en": ("write a rule", "fix a rule"), "de": ("schreib eine Regel",)}


@query(f"SELECT doc_id, lang AS domain, CASE WHEN length(seed) % 2 = 0 THEN 'NEW: ' || seed ELSE seed END AS instruction FROM (SELECT doc_id, lang, CASE lang WHEN 'de' THEN 'schreib eine Regel' ELSE {sql.pick(_SEEDS['en'], 'CAST(doc_id AS VARCHAR)')} END AS seed FROM documents)")
def seeded_instructions(spark, d):
    """With a teacher that gives nothing for seeds of an odd length."""

    def teacher(prompt: str) -> str:
        seed = prompt.rpartition(": ")[2]
        return "" if len(seed) % 2 else f"NEW: {seed}"

    plan = _t(spark, d, "documents").select("doc_id", F.col("lang").alias("domain"))
    return synthesis.instructions(plan, "doc_id", teacher, _SEEDS, "en").select("doc_id", "domain", "instruction")


@query("SELECT doc_id, 'because ' || source AS cot_trace, upper(source) AS output, 'synthetic-v1' AS version FROM documents WHERE length(upper(source)) > 0 AND source NOT LIKE 'w%'")
def synthesized_answers(spark, d):
    """With a teacher that fails for some requests, and thinks aloud for the others."""

    def teacher(prompt: str) -> str:
        what = prompt.rpartition("Request: ")[2]
        if what.startswith("w"):
            raise OSError
        return f"<think>because {what}</think>{what.upper()}"

    plan = _t(spark, d, "documents").select("doc_id", F.col("source").alias("instruction"))
    return synthesis.answers(plan, teacher).select("doc_id", "cot_trace", "output", "version")


@query("SELECT doc_id, CASE WHEN source LIKE '%1%' THEN 'second ' ELSE 'first ' END || upper(source) AS response FROM documents WHERE source IS NOT NULL")
def logged_answers(spark, d):
    """Two runs with one log: the first teacher fails for some sources, and the second is asked for these alone."""

    def first(prompt: str) -> str:
        if "1" in prompt:
            raise OSError
        return f"first {prompt.upper()}"

    log, plan = f"{checkpoint_dir(spark)}/answers-{uuid.uuid4().hex}", _t(spark, d, "documents").select("doc_id", "source")
    teacher.ask(plan, "doc_id", "source", first, log, retries=0, buckets=16).write.format("noop").mode("overwrite").save()
    return teacher.ask(plan, "doc_id", "source", lambda prompt: f"second {prompt.upper()}", log, buckets=16).select("doc_id", "response")


_CLOSER = sql.q(r"[)\]}]")


@query(f"SELECT doc_id, {_LEAK} AS leaks, regexp_matches({sql.brackets_left('text')}, {_CLOSER}) AS unmatched FROM (SELECT doc_id, text FROM {_MORE_SQL} UNION ALL SELECT * FROM (VALUES {', '.join(f'({i} - 100, {sql.q(t)})' for i, t in _LOG_CASES)}))")
def sql_checks(spark, d):
    """Checks from SQL text."""
    plan_session.register(spark)
    cases = spark.createDataFrame([(i - 100, t) for i, t in _LOG_CASES], "doc_id long, text string")
    return spark.sql("SELECT doc_id, leaks_to_log(text) AS leaks, unmatched_bracket(text) >= 0 AS unmatched FROM {rows}", rows=_more(spark, d).select("doc_id", "text").unionByName(cases))


@query("SELECT doc_id, sha256(text) AS h, 'ok' AS state FROM documents")
def jsonl_round_trip(spark, d):
    """Documents written as JSON lines and read again as text lines with their records."""
    path = f"{checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    files.write_jsonl(_t(spark, d, "documents").select("doc_id", "text"), path)
    return files.read_jsonl(spark, path, "doc_id long, text string").select("record.doc_id", F.sha2("record.text", 256).alias("h"), "state")


@query("SELECT doc_id, sha256(text) AS h, 'ok' AS state FROM documents")
def jsonl_ranges(spark, d):
    """Documents written as JSON lines and read again by ranges of a megabyte."""
    path = f"{checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    files.write_jsonl(_t(spark, d, "documents").select("doc_id", "text"), path)
    return lines.read_jsonl(spark, path, "doc_id long, text string", 1 << 20).select("record.doc_id", F.sha2("record.text", 256).alias("h"), "state")


@query(f"""WITH r AS (SELECT 0 AS o, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark UNION ALL SELECT 2, doc_id, text FROM documents)
SELECT CAST(src_ord AS INTEGER) AS src_ord, id FROM (SELECT o AS src_ord, id, row_number() OVER (PARTITION BY {_HASH} ORDER BY o, id) AS r FROM r WHERE text IS NOT NULL) WHERE r = 1""")
def ordered_concat(spark, d):
    """The first row of each content, over three inputs in order."""
    docs = _t(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("id"), "text")
    other = _t(spark, d, "benchmark").where("text is not null").select(F.col("item_id").alias("id"), "text")
    return records.exact_dedup(records.concatenated(docs, other, docs), "text", "src_ord", "id").select("src_ord", "id")


_SPECS = [(-1, '{"openapi":"3","info":{"title":"T","version":"1"},"paths":{}}'), (-2, '{"swagger":"2"}'), (-3, '{"info":{},"paths":{}}'), (-4, '{"info":{}}'), (-5, "[1]"), (-6, '{"openapi":'), (-7, '{"a":"' + "x" * 3000 + '","openapi":"3"}')]


@query(f"SELECT page_id, json_valid(html) AND (json_exists(j, '$.openapi') OR json_exists(j, '$.swagger') OR (json_exists(j, '$.info') AND json_exists(j, '$.paths'))) AS is_spec FROM (SELECT page_id, html, CASE WHEN json_valid(html) THEN html ELSE '{{}}' END AS j FROM (SELECT page_id, html FROM pages UNION ALL SELECT * FROM (VALUES {', '.join(f'({i}, {sql.q(t)})' for i, t in _SPECS)})))")
def openapi_sniff(spark, d):
    rows = _t(spark, d, "pages").select("page_id", "html").unionByName(spark.createDataFrame(_SPECS, "page_id long, html string"))
    return rows.select("page_id", files.is_openapi(F.col("html")).alias("is_spec"))


@query("SELECT page_id, 'API: P' || page_id || ' (v2)' || chr(10) || url || chr(10) || chr(10) || '  GET /' || page_id || ' — list (params: q, ' || page_id || ')' || chr(10) || '  POST /' || page_id || chr(10) || '    adds' AS text FROM pages")
def openapi_summary(spark, d):
    """Of a specification made for each page."""
    p = F.col("page_id").cast("string")
    spec = F.concat(F.lit('{"info":{"title":"P'), p, F.lit('","version":"2","description":'), F.to_json(F.array("url")), F.lit('},"paths":{"/'), p, F.lit('":{"get":{"summary":"list","parameters":[{"name":"q"},{"name":"'), p, F.lit('"}]},"x-note":{"summary":"no"},"post":{"description":"adds"}}}}'))
    spec = F.regexp_replace(spec, r'"description":\[(.*?)\]\}', r'"description":$1}')
    return _t(spark, d, "pages").select("page_id", files.openapi_summary(spec).alias("text"))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    """Windowed counts of the events as a stream that ends with what is there: every window, closed or not."""
    seen = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = stream_events.read_parquet_stream(spark, f"{d}/events.parquet", _t(spark, d, "events").schema)
    counts = stream_events.window_counts(rows).select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))
    stream_events.run_available(counts, f"{seen}/state", lambda df, _: df.write.mode("overwrite").parquet(f"{seen}/out"), "complete").awaitTermination()
    return spark.read.parquet(f"{seen}/out")


@query("SELECT doc_id, lang, sha256(text) AS h FROM documents")
def stream_sink_once(spark, d):
    """Documents as a stream into a sink whose batches are each written twice."""
    seen = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    docs = _t(spark, d, "documents")
    rows = stream_events.read_parquet_stream(spark, f"{d}/documents.parquet", docs.schema).select("doc_id", "lang", F.sha2("text", 256).alias("h"))
    batches = stream_sink.BatchSink(spark, f"{seen}/out")
    stream_events.run_available(rows, f"{seen}/state", lambda df, k: [batches.write(df, k), batches.write(df, k)]).awaitTermination()
    return batches.read(rows.schema)


@query(f"SELECT doc_id, lang, h FROM (SELECT doc_id, lang, {_HASH} AS h, row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1")
def stream_first_seen(spark, d):
    """exact_dedup of documents that come as a stream of two halves, which starts again between them."""
    seen, docs = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}", _t(spark, d, "documents")
    half = docs.selectExpr("percentile(doc_id, 0.5) c").first().c or 0
    other = stream_first.stateful(spark)
    batches = stream_sink.BatchSink(other, f"{seen}/out")
    for part in (F.col("doc_id") < half, F.col("doc_id") >= half):
        docs.where(part).write.mode("append").parquet(f"{seen}/in")
        rows = stream_first.first_ids(stream_events.read_parquet_stream(other, f"{seen}/in", docs.schema), "text", "doc_id")
        stream_events.run_available(rows, f"{seen}/state", batches.write).awaitTermination()
    found = stream_sink.BatchSink(spark, f"{seen}/out").read("h string, id long")
    return found.join(docs.select("doc_id", "lang"), F.col("id") == F.col("doc_id")).select("doc_id", "lang", "h")


@query("SELECT doc_id, CAST(i AS INTEGER) AS sample, round(0.3 + 0.05 * i, 6)::DOUBLE AS temperature FROM documents, range(4) t(i)")
def completion_samples(spark, d):
    return synthesis.samples(_t(spark, d, "documents").select("doc_id"), 4)
