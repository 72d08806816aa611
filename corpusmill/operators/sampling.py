"""Deterministic sampling, quotas, resuming, and synthesis through a pluggable teacher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, VariantType


def order_key(seed: int, key: str) -> Column:
    """A seeded order that other engines can reproduce, with the key for ties."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _order(df: DataFrame, seed: int, key: str) -> tuple[Column, Column]:
    """order_key() and what decides ties. A row without a key is ordered by the hash of its other columns, so that such rows
    are neither lost nor gathered; rows that are equal in all of them are exchangeable."""
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]).cast("string")
    return F.coalesce(order_key(seed, key), F.md5(F.concat(F.lit(f"{seed}:null:"), row))), row


#: Rows of a group up to which tasks keep no more than these of a group before the shuffle (Spark limits ranks there up to 1,000).
FEW = 1000


def first_few(df: DataFrame, key: str, quotas: dict, by: str, seed: int = 42) -> DataFrame:
    """Of each value of `by` that has a quota, the rows that come first in the seeded order, by one shuffle: each task keeps as
    many rows of a value as the largest quota asks for, and what tasks kept is merged. For quotas up to FEW."""
    order, tie = _order(df, seed, key)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order, key, tie))
    wanted = F.lit(0)
    for value, n in quotas.items():
        wanted = F.when(F.col(by).eqNullSafe(value), n).otherwise(wanted)
    kept = df.where(wanted > 0).withColumn("_r", rank).where(F.col("_r") <= max(quotas.values(), default=0))
    return kept.where(F.col("_r") <= wanted).drop("_r")


def first_in_order(df: DataFrame, key: str, wanted: DataFrame | int, by: str | None = None, seed: int = 42) -> DataFrame:
    """The first `wanted` rows in the seeded order, of all rows or of each value of `by` (wanted: by and n, one row each).

    Rows are counted by hash bucket; whole buckets are taken up to the one that a group is cut in, and only rows of such a
    bucket (one of 4,096) are ranked. So no group is sorted as a whole, and no task has more than a bucket's rows. Of all rows, up
    to FEW are taken by tasks that keep as many each.
    """
    groups = [] if by is None else [by]
    order, tie = _order(df, seed, key)
    if by is None and wanted <= FEW:
        return top(df, wanted, order, key, tie)
    marked = df.withColumn("_b", F.substring(order, 1, 3))
    counts = marked.groupBy(*groups, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = counts.withColumn("_before", before)  # at most 4,096 rows a group
    plan = plan.withColumn("_want", F.lit(wanted)) if by is None else plan.join(wanted.select(by, F.col("n").alias("_want")), by)
    plan = plan.where("_want > _before").select(*[F.col(g).alias("_g") for g in groups], F.col("_b").alias("_c"), (F.col("_want") - F.col("_before")).alias("_left"), F.col("_n"))
    on = F.col("_b") == F.col("_c")
    rows = marked.join(plan, on if by is None else on & F.col(by).eqNullSafe(F.col("_g")))
    rank = F.row_number().over(Window.partitionBy(*groups, "_b").orderBy(order, key, tie))
    whole = rows.where("_left >= _n").select(df.columns)
    return whole.unionByName(rows.where("_left < _n").withColumn("_r", rank).where("_r <= _left").select(df.columns))


def exact_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """round(fraction * n) rows without replacement (halves to even)."""
    n = df.agg(F.bround(F.count("*") * F.lit(fraction), 0).cast("long")).first()[0]
    return first_in_order(df, key, n, seed=seed)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in a seeded order, by a range-partitioned sort."""
    order, tie = _order(df, seed, key)
    return df.orderBy(order, key, tie)


def numbered(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """df with `place`, the number of a row in the seeded order (from 1): the rows of the hash buckets before its own, and its
    rank in that."""
    order, tie = _order(df, seed, key)
    marked = df.withColumn("_b", F.substring(order, 1, 3))
    counts = marked.groupBy("_b").agg(F.count("*").alias("_n"))
    before = counts.select(F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # 4,096 rows
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(order, key, tie))
    return marked.withColumn("_r", rank).join(F.broadcast(before), F.col("_b") == F.col("_c")).select(*df.columns, (F.col("_before") + F.col("_r")).alias("place"))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of an order: each task keeps n rows at most."""
    return df.orderBy(*order).limit(n)


def stratified(df: DataFrame, key: str, stratum: str, quotas: dict[str, int], seed: int = 42) -> DataFrame:
    """Of each stratum, as many rows as its quota, the first in the seeded order."""
    if max(quotas.values(), default=0) <= FEW:
        return first_few(df, key, quotas, stratum, seed)
    wanted = df.sparkSession.createDataFrame(list(quotas.items()), f"`{stratum}` string, n long")
    return first_in_order(df.where(F.col(stratum).isin(*quotas)), key, F.broadcast(wanted), stratum, seed)


def cycled(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows: each row floor(n / rows) times, and those that come first in the seeded order once more; of fewer rows wanted,
    only the latter. `copy` counts from 1."""
    total = df.count()
    if not total:
        return df.withColumn("copy", F.lit(1))
    more = first_in_order(df, key, n % total, seed=seed).withColumn("copy", F.lit(n // total + 1))
    if n < total:
        return more
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n // total)))).unionByName(more)


def quota_plan(targets: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """What remains of `target` per key, one row for each item still to be made."""
    have = existing.groupBy(*keys).agg(F.count("*").alias("have"))
    left = F.greatest(F.lit(0), F.col("target") - F.coalesce("have", F.lit(0)))
    rows = targets.join(have, keys, "left").withColumn("remaining", left.cast("int"))
    return rows.where("remaining > 0").withColumn("item", F.explode(F.sequence(F.lit(1), "remaining"))).drop("have")


def crossed(rows: DataFrame, names: DataFrame, column: str, most: int = 10_000) -> DataFrame:
    """rows, each with every value of a small dimension's column. The dimension becomes a literal; one of more than `most` rows is
    an error, as it would multiply the rows without limit."""
    values = [r[0] for r in names.select(column).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} rows")
    kind = names.schema[column].dataType
    return rows.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values]).cast(ArrayType(kind))))


def not_done(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return plan.join(done.select(*keys).distinct(), keys, "left_anti")


def balanced(keys: DataFrame, total: int, key: str) -> DataFrame:
    """total over the keys in equal parts, what is over to the first. Keys are a table of kinds, not of rows."""
    n = keys.count()
    extra = keys.orderBy(key).limit(total % max(n, 1)).select(F.col(key).alias("_k"), F.lit(1).alias("_more"))
    return keys.join(extra, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn("quota", (F.lit(total // max(n, 1)) + F.coalesce("_more", F.lit(0))).cast("int")).drop("_k", "_more")


def route(complexity: Column, primary: str, bulk: str | None) -> Column:
    return F.when(complexity == "complex", primary).otherwise(bulk or primary)


def synthesize(plan: DataFrame, prompt: str, teacher: Callable[[str], str], least: int = 0, retries: int = 2, wait: float = 0.0) -> DataFrame:
    """plan with the teacher's response. Failed calls are tried again with doubling waits; rows that stay empty, or aren't
    longer than `least`, go."""

    def call(text: str) -> str:
        for k in range(retries + 1):
            try:
                return teacher(text)
            except Exception:  # noqa: BLE001  whatever a remote model raises
                time.sleep(wait * 2**k)
        return ""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(response=p[prompt].map(call))

    return plan.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema) + ", response string").where(F.length("response") > least)
