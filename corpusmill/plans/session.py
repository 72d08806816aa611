"""Functions for use from SQL text: turns of marked dialogues as rows, and checks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from ..functions.text import SPACE
from ..operators import validate


class DialogueTurns:
    """The rows that operators.dialogue.parse() has as an array, for one text: none where that drops the text."""

    def eval(self, text: str) -> Iterator[tuple[int, str, str]]:
        turns: list[tuple[str, list[str]]] = []
        for line in (text or "").split("\n"):
            bare = line.strip(SPACE)
            role = next((r for r in ("user", "assistant") if bare.upper().startswith(f"{r.upper()}:")), None)
            if role:
                turns.append((role, [bare[len(role) + 1 :].strip(SPACE)]))
            elif turns:
                turns[-1][1].append(line)
        said = [(role, "\n".join(parts).strip(SPACE)) for role, parts in turns]
        if said and said[-1][0] == "user" and len(said) > 1:
            said.pop()
        if len(said) > 1 and said[0][0] == "user" and all(content for _, content in said):
            yield from ((k, role, content) for k, (role, content) in enumerate(said, 1))


@F.pandas_udf(IntegerType())
def _unmatched_bracket(texts: pd.Series) -> pd.Series:
    return texts.map(validate.first_unmatched, na_action="ignore").astype("Int32")


@F.pandas_udf(StringType())
def _xml_error(texts: pd.Series) -> pd.Series:
    return texts.map(validate.xml_error, na_action="ignore")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession) -> None:
    """Makes these known to the session's SQL:

    dialogue_turns(text) as a table (turn, role, content), for FROM ..., LATERAL; unmatched_bracket(text), the place of the first
    closing bracket without its opening one, or -1; xml_error(text), null for well-formed XML; leaks_to_log(text). Null texts
    give no turns, and null.
    """
    spark.udtf.register("dialogue_turns", F.udtf(DialogueTurns, returnType="turn int, role string, content string"))
    spark.udf.register("unmatched_bracket", _unmatched_bracket)
    spark.udf.register("xml_error", _xml_error)
    rules = " OR ".join(f"t RLIKE {_quoted('(?i)' + p)}" for p in validate.LOG_LEAKS)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION leaks_to_log(t STRING) RETURNS BOOLEAN RETURN {rules}")
