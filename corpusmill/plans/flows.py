"""Cleaning, validating and formatting as one flow of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import render
from ..operators import neardup, records, validate


def clean(df: DataFrame, key: str, threshold: float = 0.9) -> DataFrame:
    """Records (instruction, input, output, domain) without blank, attributed, repeated and nearly repeated ones; the
    earlier of two rows (by key) stays."""
    rows = records.single_turn(df).where(~records.is_empty(F.col("instruction"), F.col("output")))
    rows = rows.where(~records.attributed(F.concat_ws("\n", "instruction", "output")))
    return neardup.kept(records.exact_dedup(rows, "output", key), key, "domain", "output", threshold)


def clean_validate_format(df: DataFrame, key: str, template: str = "llama", threshold: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(key and text of the rows that pass, rows that fail with their errors)."""
    passed, failed = validate.split(validate.validated(clean(df, key, threshold), "output", "domain"), "_r")
    cot = F.col("cot_trace") if "cot_trace" in df.columns else None
    return passed.select(key, render.single_turn(F.col("instruction"), F.col("input"), F.col("output"), cot, template).alias("text")), failed
