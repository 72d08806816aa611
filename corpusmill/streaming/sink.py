"""A sink for foreachBatch that holds every batch once, however often it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class BatchSink:
    """A folder with a table for each batch, and a mark for each batch that is whole.

    A batch that was marked isn't written again. One that failed before its mark is replaced when it is written again, and until
    then no reader sees any of it. Marks are made by creating a file that mustn't be there, so that of two writers of a batch
    one wins. Readers list marks, not tables; what is read is a table, so that the rows have no lineage to the stream.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def whole(self) -> list[int]:
        """The batches that were marked, in order."""
        marks = self._at("whole")
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(marks)) if self._fs.exists(marks) else []

    def _mark(self, batch: int) -> None:
        self._fs.create(self._at(f"whole/{batch}"), False).close()

    def write(self, df: DataFrame, batch: int) -> bool:
        """Writes a batch, for use as foreachBatch's function; false if it was there already."""
        if batch in self.whole():
            return False
        df.write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        self._mark(batch)
        return True

    def read(self, schema) -> DataFrame:
        """The rows of all whole batches, with the columns of the schema; none without batches."""
        found = [f"{self.path}/batch-{k}" for k in self.whole()]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)
