"""Pieces of DuckDB SQL that restate column functions, for the SQL equivalents of the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from .operators import validate


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^[\\s\\x1c-\\x1f\\x0b]+|[\\s\\x1c-\\x1f\\x0b]+$', '', 'g')"


def content_hash(t: str) -> str:
    return f"sha256(lower({strip(t)}))"


def drawn(seed: str) -> str:
    """A draw of the seeds that an expression joins by colons."""
    return f"CAST('0x' || substr(md5({seed}), 1, 8) AS BIGINT)"


def pick(pool: Sequence[str], seed: str) -> str:
    return f"[{', '.join(map(q, pool))}][1 + {drawn(seed)} % {len(pool)}]"


_ESCAPES = q(r"(?s)\\(.|$)")
_STRINGS = q(r"""'[^']*('|$)|"[^"]*("|$)|`[^`]*(`|$)""")
_OTHERS = q(r"[^()\[\]{}]")
_PAIRS = q(r"\(\)|\[\]|\{\}")


def brackets_left(t: str) -> str:
    """Brackets outside strings, with neighbours that match taken away 60 times."""
    kept = f"regexp_replace(regexp_replace(regexp_replace({t}, {_ESCAPES}, '', 'g'), {_STRINGS}, '', 'g'), {_OTHERS}, '', 'g')"
    return f"list_reduce(list_prepend({kept}, list_transform(range(60), lambda k: '')), lambda a, k: regexp_replace(a, {_PAIRS}, '', 'g'))"


def bracket_error(left: str) -> str:
    """What is wrong with what brackets_left() gives; null if nothing is."""
    closer = q(r"[)\]}]")
    return f"CASE WHEN {left} = '' THEN NULL WHEN regexp_matches({left}, {closer}) THEN 'Unmatched ''' || regexp_extract({left}, {closer}, 0) || '''' ELSE 'Unclosed brackets: ' || {left} END"


_RULES = [(validate.SQL_CONCATENATION, "Possible SQL injection", "")] + [(p, what, "|".join(f"(?:{a})" for a in validate.ALLOWED_NEAR)) for p, what in validate.SECRETS]


def _hit(t: str, pattern: str, allowed: str) -> str:
    found = f"regexp_matches({t}, {q('(?i)' + pattern)})"
    near = q(r"(?i)[\s\S]{0,40}?(?:" + pattern + r")[\s\S]{0,40}")
    return found if not allowed else f"{found} AND NOT regexp_matches(regexp_extract({t}, {near}, 0), {q('(?i)' + allowed)})"


def security(t: str) -> str:
    """The detail of the first rule that hits; null if none does."""
    return "CASE " + " ".join(f"WHEN {_hit(t, p, a)} THEN {q(what)}" for p, what, a in _RULES) + " END"


def security_line(t: str) -> str:
    return "CASE " + " ".join("WHEN " + _hit(t, p, a) + f" THEN len(string_split(regexp_extract({t}, {q(r'(?i)^([\s\S]*?)(?:' + p + ')')}, 1), chr(10)))" for p, _, a in _RULES) + " END"


def content_type(t: str) -> str:
    s = strip(t)
    return f"CASE WHEN starts_with({s}, 'MSH|') THEN 'hl7v2' WHEN starts_with({s}, '<') AND contains({s}, '>') THEN 'xml' WHEN starts_with({s}, '{{') AND json_valid({s}) THEN CASE WHEN coalesce(json_extract_string({s}, '$.resourceType'), '') <> '' THEN 'fhir' ELSE 'json' END ELSE 'javascript' END"


def hl7_missing(t: str) -> str:
    """Segments that are required and missing, of a message whose lines end with line feeds."""
    need = "CASE split_part(split_part({t}, '|', 9), '^', 1) " + " ".join(f"WHEN {q(k)} THEN [{', '.join(map(q, v))}]" for k, v in validate.REQUIRED_SEGMENTS.items()) + " ELSE ['MSH'] END"
    return f"list_filter({need.format(t=t)}, lambda x: NOT list_contains(list_transform(string_split({t}, chr(10)), lambda y: left(y, 3)), x))"


#: Near duplicates of the texts that are the first with their content: pairs of one lang that share one of their rarest 5-grams
#: (by exact counts), by the number of distinct 5-grams that both have; then the greedy rule, one pair after the other. Gives a
#: table gone(doc_id).
NEAR_DUPLICATES = f"""
u AS (SELECT doc_id, lang, lower({strip('text')}) AS t FROM (SELECT *, row_number() OVER (PARTITION BY {content_hash('text')} ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1),
c AS (SELECT doc_id, lang, t, regexp_extract_all(t, '(?s).') AS c FROM u WHERE t <> ''),
s AS (SELECT DISTINCT doc_id, lang, unnest(CASE WHEN len(c) < 5 THEN [hash(t)] ELSE list_transform(range(1, len(c) - 3), lambda i: hash(c[i] || c[i + 1] || c[i + 2] || c[i + 3] || c[i + 4])) END) AS g FROM c),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
z AS (SELECT s.*, n.n FROM s JOIN n USING (doc_id)),
r AS (SELECT z.*, row_number() OVER (PARTITION BY doc_id ORDER BY f.k, z.g) AS r FROM z JOIN (SELECT g, count(*) AS k FROM z GROUP BY g) f ON z.g = f.g),
q AS (SELECT DISTINCT a.doc_id AS i, b.doc_id AS j FROM r a JOIN r b ON a.g = b.g AND a.lang IS NOT DISTINCT FROM b.lang AND a.doc_id < b.doc_id AND a.r <= a.n - ceil(0.9 * a.n - 1e-9) + 1 AND b.r <= b.n - ceil(0.9 * b.n - 1e-9) + 1 AND least(a.n, b.n) >= 0.9 * greatest(a.n, b.n)),
p AS (SELECT i, j FROM q JOIN z a ON a.doc_id = q.i JOIN z b ON b.doc_id = q.j AND a.g = b.g GROUP BY i, j, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.9),
o AS (SELECT i, j, row_number() OVER (ORDER BY i, j) AS k FROM p),
w AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone UNION ALL SELECT o.k, CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone ELSE list_append(gone, j) END FROM w JOIN o ON o.k = w.k + 1),
gone AS (SELECT unnest(gone) AS doc_id FROM (SELECT gone FROM w ORDER BY k DESC LIMIT 1))"""
