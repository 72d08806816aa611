"""Reports over responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def by_category(df: DataFrame, category: str = "category", ok: Column | None = None, short: int = 300) -> DataFrame:
    """Per category: rows, good and bad rows, and averages over the good ones."""
    good = F.col("status") == "ok" if ok is None else ok
    mean = lambda c: F.avg(F.when(good, c))
    return df.groupBy(category).agg(F.count("*").alias("n"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_err"), mean(F.col("latency_sec")).alias("avg_latency"), mean(F.col("response_length").cast("double")).alias("avg_length"), mean(F.col("has_code").cast("double")).alias("code_rate"), F.count_if(good & (F.col("response_length") < short)).alias("n_short"))


def counted(df: DataFrame, *by: str) -> DataFrame:
    """Rows per key (files or records per domain, scenario, standard)."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def overall(df: DataFrame, ok: Column | None = None) -> DataFrame:
    """One row: all rows, good rows, and the averages over the good ones (null without any): latency, response length,
    completion tokens and the percentage with code."""
    good = F.col("status") == "ok" if ok is None else ok
    mean = lambda c: F.avg(F.when(good, F.col(c).cast("double")))
    return df.agg(F.count("*").alias("n"), F.count_if(good).alias("n_ok"), mean("latency_sec").alias("avg_latency"), mean("response_length").alias("avg_length"), mean("completion_tokens").alias("avg_tokens"), (mean("has_code") * 100).alias("code_pct"))


def rates(df: DataFrame, flags: Mapping[str, Column], groups: Mapping[str, Sequence[str]], category: str = "category") -> DataFrame:
    """For each metric, the share of rows of its categories that have its flag; 0 without rows."""
    sums = []
    for name, flag in flags.items():
        inside = F.col(category).isin(*groups[name]) if name in groups else F.lit(True)
        sums.append((F.count_if(flag & inside) / F.greatest(F.count_if(inside), F.lit(1))).alias(name))
    return df.agg(*sums)


def missing_phrase(df: DataFrame, text: str, phrase: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~F.lower(F.coalesce(F.col(text), F.lit(""))).contains(phrase.lower())).alias("n_missing"))


def by_sets(df: DataFrame, sets: Mapping[str, Sequence[str]], metrics: Mapping[str, Column]) -> DataFrame:
    """The metrics (aggregates) of rows grouped in several ways, in one scan and one shuffle. `sets` names each way and its columns,
    none for all rows; `level` is the name, and columns that a way doesn't group by are null. A value that is null in the data
    is told apart by its level. Without rows, only ways without columns give a row."""
    names = list(dict.fromkeys(c for s in sets.values() for c in s))
    ids = {name: sum(1 << k for k, c in enumerate(reversed(names)) if c not in s) for name, s in sets.items()}
    if len(set(ids.values())) < len(ids):
        raise ValueError("two ways of grouping have the same columns")
    level = F.lit(None).cast("string")
    for name, k in ids.items():
        level = F.when(F.col("_id") == k, name).otherwise(level)
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in names])
    return grouped.agg(F.grouping_id().alias("_id"), *[c.alias(k) for k, c in metrics.items()]).withColumn("level", level).drop("_id")


def observed(df: DataFrame, **flags: Column) -> tuple[DataFrame, Observation]:
    """df, and counters that are taken as its rows pass: `total`, and for each flag the rows that have it. The counters are there once
    an action over the df has ended, with no scan of their own. Observe right before a write: what a stage that ends in a
    shuffle counts may count twice where it runs again for lost executors."""
    counters = Observation()
    return df.observe(counters, F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in flags.items()]), counters
