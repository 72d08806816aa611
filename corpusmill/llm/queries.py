"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, balltree, bpe, chat, divergence, license, lm, media, minhash, mixing, simjoin, tokenbin, toxicity
from .common import table


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.components(table(spark, sf_dir, "documents"))


def op4_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_turns(rows))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards", "places")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents")).drop("spans")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.cluster(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe_encode_decode, op2_toxicity, op3_ngram_jaccard_join, op4_token_binary, op5_chat_format, op6_mix_sources, op7_license_scan, op8_lm_score, op9_media_columns, op10_ann_search, op11_minhash_dedup, op12_centroid_clusters, op13_source_divergence)}

_CONTROLS = r"\\|<\|im_start\|>|<\|im_end\|>|<\|system\|>|<\|user\|>|<\|assistant\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"

def _near_duplicates(words: int, more: str = "") -> str:
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i : i + {words - 1}], ' ')) END) AS g FROM w),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN c a ON x = a.doc_id JOIN c b ON y = b.doc_id WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT DISTINCT doc_id AS d, doc_id AS m FROM documents UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.d)
SELECT d.doc_id, coalesce(any_value(c.n), 0) AS n_shingles, min(r.m) AS component_id{more}
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN r ON r.d = d.doc_id GROUP BY d.doc_id"""


def _clusters(k: int, rounds: int) -> str:
    """Each round is a step of its own over the exploded components."""
    steps = [f"""
WITH v AS MATERIALIZED (SELECT vec_id, embedding AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, j, CAST(floor(1024 * CAST(e[j + 1] AS DOUBLE)) AS BIGINT) AS a FROM v, range(64) t(j)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM v),
z0 AS MATERIALIZED (SELECT c, j, a FROM f JOIN x USING (vec_id) WHERE c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"d{i} AS (SELECT x.vec_id, z.c, CAST(sum((x.a - z.a) * (x.a - z.a)) AS BIGINT) AS d FROM x JOIN z{i} z USING (j) GROUP BY 1, 2)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM d{i} GROUP BY 1)")
        if i < rounds:
            steps.append(f"m{i} AS (SELECT a.c, x.j, CAST(sum(x.a) AS BIGINT) AS s, count(*) AS n FROM a{i} a JOIN x USING (vec_id) GROUP BY 1, 2)")
            steps.append(f"z{i + 1} AS MATERIALIZED (SELECT z.c, z.j, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, z.a) AS a FROM z{i} z LEFT JOIN m{i} m ON m.c = z.c AND m.j = z.j)")
    last = f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM a{rounds} a JOIN (SELECT c, sha256(string_agg(CAST(a AS VARCHAR), ',' ORDER BY j)) AS h FROM z{rounds} GROUP BY c) h ON h.c = a.c"""
    return ",\n".join(steps) + last


_DIVERGENCE = r"""
WITH t AS (SELECT row_number() OVER () AS row_, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM t),
o AS (SELECT row_, lang, source, unnest(w) AS term FROM t),
kept AS MATERIALIZED (SELECT lang, term FROM o GROUP BY 1, 2 HAVING count(DISTINCT row_) >= 30),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
p AS MATERIALIZED (SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (gn.n + 5 * v.v) AS p
  FROM gn JOIN v ON v.lang = gn.lang JOIN kept ON kept.lang = gn.lang LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
q AS (SELECT p.lang, p.term, 1 + (1000000000::HUGEINT * (sum(p.n) + 5)) // (any_value(l.n) + 5 * any_value(v.v)) AS q FROM p JOIN v ON v.lang = p.lang JOIN (SELECT lang, sum(n) AS n FROM gn GROUP BY 1) l ON l.lang = p.lang GROUP BY 1, 2),
f AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, CAST(coalesce(d.f, 0) AS BIGINT) FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS u, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) d ON d.lang = a.lang AND d.s = a.source AND d.u = b.source)
SELECT lang, source, part, item, value, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM f) WHERE part = 'pair' OR r <= 50"""

ORACLE = {
    "op3_ngram_jaccard_join": _near_duplicates(5),
    "op11_minhash_dedup": _near_duplicates(4, ", d.doc_id = min(r.m) AS kept"),
    "op12_centroid_clusters": _clusters(8, 10),
    "op13_source_divergence": _DIVERGENCE,
    "op5_chat_format": f"""
WITH rows_ AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '{_CONTROLS}')) + len(regexp_extract_all(role, chr(10)))) AS BIGINT) AS formatted_chars
FROM rows_ GROUP BY conv_id""",
}
