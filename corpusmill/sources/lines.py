"""A data source of lines by byte ranges: `spark.read.format("text_lines")`.

Every file is cut into ranges of `rangeBytes`, whatever its size, and each range is a partition. A line belongs to the range that
its first byte lies in. Its place is the offset of that byte, so that lines can be ordered as they lie in the file however it
is cut. Bytes that aren't UTF-8 are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.teacher import shared
from .files import as_record, present

#: file_ord: of the file among the paths given; place: the offset of the line's first byte.
LINES = "file string, file_ord int, place long, value string"
_SHAPE = pa.schema([("file", pa.string()), ("file_ord", pa.int32()), ("place", pa.int64()), ("value", pa.string())])
_READ, _BATCH = 1 << 20, 8 << 20


@dataclass
class Range(InputPartition):
    path: str
    file_ord: int
    start: int
    end: int


def lines_of(stream, start: int, end: int, read: int = _READ) -> Iterator[tuple[int, bytes]]:
    """(offset, line without its end) of the lines that begin in a range. A line ends with a line feed, before which a carriage return
    goes as well, or with the file."""
    at = max(start - 1, 0)
    stream.seek(at)
    held, skip = bytearray(), start > 0  # what comes before the range's first line belongs to the range before
    seen = 0  # how much of held was searched for an end
    while True:
        cut = held.find(b"\n", seen)
        if cut < 0:
            seen = len(held)
            if skip:  # a long line of another range isn't held
                at, held, seen = at + len(held), bytearray(), 0
            more = stream.read(read)
            if not more:
                break
            held += more
            continue
        # all whole lines that are held, in one go
        whole, rest = bytes(held[: held.rfind(b"\n")]), held[held.rfind(b"\n") + 1 :]
        for line in whole.split(b"\n"):
            if not skip:
                if at >= end:
                    return
                yield at, line[:-1] if line.endswith(b"\r") else line
            skip, at = False, at + len(line) + 1
        held, seen = rest, 0
        if at >= end:
            return
    if held and not skip and at < end:
        yield at, bytes(held[:-1] if held.endswith(b"\r") else held)


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], size: int):
        self.paths, self.size = paths, size

    def partitions(self) -> list[Range]:
        out = []
        for k, path in enumerate(self.paths):
            fs, at = shared(path)
            info = fs.get_file_info(at)
            found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(at, recursive=True))
            for f in sorted((f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path):
                of = path if f.path == at else path.rstrip("/") + f.path[len(at.rstrip("/")) :]
                out += [Range(of, k, s, min(s + self.size, f.size)) for s in range(0, f.size, self.size)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        fs, at = shared(partition.path)
        with fs.open_input_file(at) as stream:
            places, texts, size = [], [], 0
            for place, line in lines_of(stream, partition.start, partition.end):
                places.append(place)
                texts.append(line.decode("utf-8", "replace"))
                size += len(line) + 16
                if size >= _BATCH:
                    yield self._batch(partition, places, texts)
                    places, texts, size = [], [], 0
            if places:
                yield self._batch(partition, places, texts)

    @staticmethod
    def _batch(p: Range, places: list[int], texts: list[str]) -> pa.RecordBatch:
        n = len(places)
        return pa.RecordBatch.from_arrays([pa.array([p.path] * n, pa.string()), pa.array([p.file_ord] * n, pa.int32()), pa.array(places, pa.int64()), pa.array(texts, pa.string())], schema=_SHAPE)


class TextLines(DataSource):
    """Options: paths (one a line), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "text_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        size = int(self.options.get("rangeBytes", 64 << 20))
        if size < 1:
            raise ValueError("rangeBytes must be 1 or more")
        return _Reader([p for p in self.options["paths"].split("\n") if p], size)


def read_lines(spark: SparkSession, paths: str | list[str], range_bytes: int = 64 << 20) -> DataFrame:
    """The lines of files, folders and globs, blank ones too; a warning for paths without any. Files whose names start with a dot or an
    underscore aren't read."""
    found = present(spark, paths)
    if not found:
        return spark.createDataFrame([], LINES)
    spark.dataSource.register(TextLines)
    return spark.read.format("text_lines").option("paths", "\n".join(found)).option("rangeBytes", str(range_bytes)).load()


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, range_bytes: int = 64 << 20) -> DataFrame:
    """As files.read_jsonl(), by ranges: file, file_ord, place, raw, state (blank, malformed, ok) and record. Ordered by file_ord,
    file and place, lines are as in the input."""
    state, record = as_record(F.col("value"), schema)
    return read_lines(spark, paths, range_bytes).select("file", "file_ord", "place", F.col("value").alias("raw"), state.alias("state"), record.alias("record"))
