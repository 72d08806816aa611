"""Parsing marked dialogues into turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def parse(df: DataFrame, key: str, text: str, user: str = "USER:", assistant: str = "ASSISTANT:") -> DataFrame:
    """key and turns (role, content) of texts whose lines open turns by a marker at their start.

    Lines before the first marker go, a user turn at the end goes; texts that don't start with a user turn, or then have a
    blank turn or fewer than two turns, are dropped.
    """
    line = strip(F.col("line"))
    is_user, is_assistant = F.upper(line).startswith(user), F.upper(line).startswith(assistant)
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("at", "line"))
    role = F.when(is_user, "user").when(is_assistant, "assistant")
    rest = F.when(is_user, strip(F.substring(line, F.lit(len(user) + 1), F.length(line)))).when(is_assistant, strip(F.substring(line, F.lit(len(assistant) + 1), F.length(line)))).otherwise(F.col("line"))
    marked = lines.select(key, "at", role.alias("role"), rest.alias("part"))
    turn = F.sum(F.col("role").isNotNull().cast("int")).over(Window.partitionBy(key).orderBy("at"))
    turns = marked.withColumn("turn", turn).where("turn > 0").groupBy(key, "turn").agg(F.max("role").alias("role"), strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "\n")).alias("content"))
    all_ = turns.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "content"))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("turns"))
    cut = F.when(F.element_at("turns", -1)["role"] == "user", F.slice("turns", F.lit(1), F.size("turns") - 1)).otherwise(F.col("turns"))
    kept = all_.where((F.col("turns")[0]["role"] == "user") & (F.size("turns") >= 2)).withColumn("turns", cut)
    return kept.where(F.forall("turns", lambda t: t["content"] != "") & (F.size("turns") >= 2))
