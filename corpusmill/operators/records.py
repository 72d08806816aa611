"""Normalising, filtering and exact deduplication of records, and cleaning statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, content_hash, strip

#: Phrases by which a text names another maker (own neutral defaults; callers pass their own).
ATTRIBUTION = (r"as an ai language model", r"\bi am an ai (assistant|model)\b", r"\b(created|developed|trained) by [a-z]+ (ai|labs)\b", r"my (training|knowledge) (data|cut-?off)")


def text_of(c: Column) -> Column:
    """Null is empty, other types are their JSON or literal text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def single_turn(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text_of(F.col(c)) for c in ("instruction", "input", "output") if c in df.columns})


def conversation_ok(turns: Column) -> Column:
    return turns.isNotNull() & (F.size(turns) >= 2) & F.forall(turns, lambda t: t.isNotNull() & t["role"].isNotNull())


def conversation_hash(turns: Column) -> Column:
    return content_hash(conversation_text(turns))


def is_empty(instruction: Column, output: Column) -> Column:
    return blank(instruction) & blank(output)


def conversation_empty(turns: Column) -> Column:
    return F.size(F.filter(turns, lambda t: ~blank(t["content"]))) < 2


def attributed(text: Column, patterns: Sequence[str] = ATTRIBUTION) -> Column:
    return F.lower(text).rlike("|".join(f"(?:{p})" for p in patterns))


def conversation_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.coalesce(t["content"], F.lit(""))), "\n")


def conversation_attributed(turns: Column, patterns: Sequence[str] = ATTRIBUTION) -> Column:
    """attributed() over the contents of all turns, joined by line feeds."""
    return attributed(conversation_text(turns), patterns)


def last_content(turns: Column, role: str = "user") -> Column:
    """Content of the last turn of a role; empty without one."""
    return F.coalesce(F.try_element_at(F.filter(turns, lambda t: t["role"] == role), F.lit(-1))["content"], F.lit(""))


def conversation_from_json(line: Column) -> Column:
    """The turns of a JSON record as array<struct<role,content>>: null for less than two turns, or a turn that isn't an object
    or lacks a key. A null content is empty; other contents are their text."""
    v = F.try_parse_json(line)
    turns = F.try_variant_get(v, "$.turns", "array<map<string,variant>>")
    whole = F.forall(turns, lambda t: t.isNotNull() & F.map_contains_key(t, "role") & F.map_contains_key(t, "content"))
    text = lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit(""))
    return F.when((F.size(turns) >= 2) & whole, F.transform(turns, lambda t: F.struct(text(t["role"]).alias("role"), text(t["content"]).alias("content"))))


def first_by(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key; rows of a null key all stay. One shuffle of the key, with no group held in memory."""
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    keyed = df.withColumn("_key", key)
    return keyed.where("_key is not null").withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_key").unionByName(keyed.where("_key is null").drop("_key"))


def capped(df: DataFrame, key: str, n: int, *order: str) -> DataFrame:
    """The first n rows of each key in an order; tasks rank and cut before the shuffle, so that no key is gathered."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def exact_dedup(df: DataFrame, text: str, *order: str) -> DataFrame:
    return first_by(df, content_hash(F.col(text)), *map(F.col, order))


def concatenated(*frames: DataFrame) -> DataFrame:
    """All rows of several frames with src_ord, a frame's place, for a stable order with the frames' own order columns;
    columns that a frame lacks are null."""
    out = [f.withColumn("src_ord", F.lit(k)) for k, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def min_length(df: DataFrame, text: str, least: int = 20) -> DataFrame:
    return df.where(F.length(strip(F.col(text))) >= least)


def cleaning_stats(df: DataFrame, malformed: Column, empty: Column, noise: Column, text: Column, *order: str) -> DataFrame:
    """One row of counters: every input row falls into one bucket."""
    state = df.select(F.when(malformed, "malformed").when(empty, "empty").when(noise, "noise").otherwise("kept").alias("state"), F.when(~malformed & ~empty & ~noise, content_hash(text)).alias("h"))
    by = state.groupBy("state", "h").agg(F.count("*").alias("n"))
    of = lambda s: F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n"))), F.lit(0))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"), of("malformed").alias("malformed_removed"), of("empty").alias("empty_removed"), of("noise").alias("noise_removed"), (of("kept") - F.count_if(F.col("state") == "kept")).alias("duplicates_removed"), F.count_if(F.col("state") == "kept").alias("output_rows"))
