"""Quality scores, rewards, best of several completions, and preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from . import validate


def quality(output: Column, valid: Column) -> Column:
    t = strip(output)
    n = F.length(t)
    points = lambda when, p: F.when(when, p).otherwise(0.0)
    code = t.contains("```") | t.contains("function ") | t.contains("def ")
    notes = t.contains("//") | t.contains("#") | t.contains("/*")
    s = F.lit(0.5) + points(n > 100, 0.15) + points(n > 500, 0.1) + points(code, 0.1) + points(notes, 0.1) - points(n < 50, 0.2)
    return F.when(valid, F.least(F.lit(1.0), F.greatest(F.lit(0.0), s))).otherwise(0.0)


def reward(output: Column) -> Column:
    """A quarter for each format check that applies and passes; 0.5 if none applies, 0 if blank."""
    t = strip(output)
    kind = validate.content_type(t)
    checks = [(t.rlike(r"[{}()\[\]]"), validate.javascript(t)["passed"]), (t.startswith("<") & t.contains(">"), validate.xml(t)["passed"]), (t.startswith("MSH|"), validate.hl7(t)["passed"]), (kind == "fhir", validate.fhir(t)["passed"])]
    got = sum((F.when(a & p, 0.25).otherwise(0.0) for a, p in checks), F.lit(0.0))
    any_ = checks[0][0] | checks[1][0] | checks[2][0] | checks[3][0]
    return F.when(t == "", 0.0).when(~any_, 0.5).otherwise(F.least(F.lit(1.0), got))


def best_of(df: DataFrame, prompt: str, sample: str, score: str, output: str) -> DataFrame:
    """Best and worst completion of each prompt; of equal best the first sample wins, of equal worst the last. Prompts
    with one completion or equal extremes give no row."""
    key = F.struct(F.col(score), -F.col(sample))
    g = df.groupBy(prompt).agg(F.count("*").alias("n"), F.max_by(output, key).alias("chosen"), F.min_by(output, key).alias("rejected"), F.max(score).alias("best"), F.min(score).alias("worst"))
    return g.where("n >= 2 and best > worst").drop("n")


def preference_pairs(passed: DataFrame, failed: DataFrame, order: str, match: str = "instruction", output: str = "output") -> DataFrame:
    """A pair for each failed row whose stripped key a passed row has; the first passed row of a key is chosen, as it is."""
    p = passed.select(strip(F.col(match)).alias("prompt"), F.col(output).alias("chosen"), F.col(order).alias("o")).where((F.col("prompt") != "") & (strip(F.col("chosen")) != ""))
    first = p.withColumn("r", F.row_number().over(Window.partitionBy("prompt").orderBy("o"))).where("r = 1").select("prompt", "chosen")
    f = failed.select(strip(F.col(match)).alias("prompt"), strip(F.col(output)).alias("rejected")).where("prompt <> '' and rejected <> ''")
    return f.join(first, "prompt").select("prompt", "chosen", "rejected")
