"""First-seen rows of a stream without a horizon, by state that is kept for each content."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import content_hash

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(spark: SparkSession) -> SparkSession:
    """A session beside the given one, whose streams keep their state on disk, as state by key needs it."""
    other = spark.newSession()
    other.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return other


class _First(StatefulProcessor):
    """For a content that has no state yet, its smallest id, which becomes its state."""

    def __init__(self, kind: str):
        self.kind = kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", f"id {self.kind}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if self.first.exists():
            return
        least = min(r["id"] for r in rows)  # whatever number of rows: one id is held
        self.first.update((least,))
        yield Row(h=key[0], id=least)

    def close(self) -> None:
        pass


def first_ids(stream: DataFrame, text: str, key: str) -> DataFrame:
    """h (content hash) and id of each content's first row: the smallest key of the first batch that has the content. Later rows of
    the content give nothing, in this run or after a restart.

    The state grows by one hash and id a content. There is no time to live: state that expires by processing time keeps a run over
    what is available from ending (events.first_seen() forgets by event time).
    Rows without a text or a key are left out. Only hashes and keys are shuffled; a content of very many rows costs its
    task a pass over their keys. The session must be one of stateful().
    """
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(content_hash(F.col(text)).alias("h"), F.col(key).alias("id")).where("h IS NOT NULL AND id IS NOT NULL")
    return rows.groupBy("h").transformWithState(_First(kind), f"h string, id {kind}", "append", "none")
