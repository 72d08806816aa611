"""Concurrent calls of a teacher, whose answers are kept in a log as they come.

Answers of a remote model are slow, cost money and may differ from call to call. So each task has several requests under way, and
writes answers to a log in the shared folder while it goes on. A task that starts again, whether after a lost executor, in
another run of the job, or because its rows are computed anew, takes what was logged from there.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "id string, key string, response string, bucket int"


def shared(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, for use in tasks, and the path there."""
    return pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def in_order(call: Callable[[str], str], items: Iterable[str], at_once: int) -> Iterator[str]:
    """call's results in the order of the items, with at most `at_once` calls under way."""
    pool, window = ThreadPoolExecutor(at_once), deque()
    try:
        for x in items:
            window.append(pool.submit(call, x))
            if len(window) == 4 * at_once:  # a slow call doesn't hold up the others at once
                yield window.popleft().result()
        while window:
            yield window.popleft().result()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def patient(teacher: Callable[[str], str], timeout: float, retries: int, wait: float) -> Callable[[str], str]:
    """The teacher with a time limit and further tries after doubling waits; empty where none gives a text. A request that is
    given up is left to end by itself, and its answer is dropped."""

    def attempt(prompt: str) -> str:
        got: list[str] = []

        def ask() -> None:
            try:
                got.append(teacher(prompt) or "")
            except Exception:  # noqa: BLE001  whatever a remote model raises
                pass

        thread = threading.Thread(target=ask, daemon=True)
        thread.start()
        thread.join(timeout)
        return got[0] if got else ""

    def call(prompt: str) -> str:
        for k in range(retries + 1):
            if k:
                time.sleep(wait * 2 ** (k - 1))
            if answer := attempt(prompt):
                return answer
        return ""

    return call


class _Log:
    """The part of the log that belongs to one bucket: a folder of files that appear whole or not at all."""

    def __init__(self, path: str, bucket: int, every: int):
        self.fs, root = shared(path)
        self.folder, self.every, self.new = f"{root}/bucket={bucket}", every, []
        self.answers: dict[str, str] = {}
        for f in self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True)):
            if f.base_name.endswith(".jsonl"):
                with self.fs.open_input_stream(f.path) as s:
                    self.answers.update((x["id"], x["response"]) for x in map(json.loads, s.readall().splitlines()))

    def add(self, one: str, key: str | None, response: str) -> None:
        self.answers[one] = response
        if response:  # what failed is asked again by the next run
            self.new.append({"id": one, "key": key, "response": response})
            if len(self.new) >= self.every:
                self.flush()

    def flush(self) -> None:
        if not self.new:
            return
        name = uuid.uuid4().hex
        self.fs.create_dir(self.folder, recursive=True)
        with self.fs.open_output_stream(f"{self.folder}/.{name}") as s:
            s.write("".join(json.dumps(x) + "\n" for x in self.new).encode())
        self.fs.move(f"{self.folder}/.{name}", f"{self.folder}/{name}.jsonl")
        self.new = []


def ask(plan: DataFrame, key: str, prompt: str, teacher: Callable[[str], str], log: str, *, at_once: int = 8, timeout: float = 120.0, retries: int = 2, wait: float = 1.0, least: int = 0, every: int = 32, buckets: int = 64) -> DataFrame:
    """plan with the teacher's `response` to each prompt; rows whose response isn't longer than `least` go.

    log: a folder that the driver and all executors share. A call is known by its key and its prompt: rows that repeat both share
    one call, and a key whose prompt has changed is asked again. Null keys are a key of their own; null prompts aren't asked
    and have an empty response. Only answers are logged, `every` so many and at the end of each bucket, so that a killed task
    loses fewer than that many and what is under way.

    Rows are dealt to `buckets` tasks by call, so that many rows of one key are dealt as well unless they share one call; a task
    holds the answers of one bucket at a time. Choose as many buckets as keep that small; the log must be used with the same number.
    """
    columns = plan.columns
    one = F.sha2(F.to_json(F.struct(F.col(key).cast("string").alias("k"), F.col(prompt).alias("p")), {"ignoreNullFields": "false"}), 256)
    rows = plan.withColumn("_id", one).withColumn("_bucket", F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int"))
    rows = rows.withColumn("_key", F.col(key).cast("string")).repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "_id")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call, bucket, held = patient(teacher, timeout, retries, wait), None, None
        for part in parts:
            out = []
            for b, p in part.groupby("_bucket", sort=False):
                if b != bucket:
                    bucket, held = b, _Log(log, b, every)
                left = p[p[prompt].notna() & ~p["_id"].isin(list(held.answers))].drop_duplicates("_id")
                for i, k, response in zip(left["_id"], left["_key"], in_order(call, left[prompt], at_once), strict=True):
                    held.add(i, None if pd.isna(k) else k, response)
                held.flush()
                out.append(p.assign(response=[held.answers.get(i, "") for i in p["_id"]]))
            if out:
                yield pd.concat(out)[[*columns, "response"]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema)
    return rows.mapInPandas(run, f"{kinds}, response string").where(F.length("response") > least)


def logged(spark: SparkSession, log: str) -> DataFrame:
    """The answers of a log, each call's once; none where nothing was logged yet."""
    fs, root = shared(log)
    if fs.get_file_info(root).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).json(log).dropDuplicates(["id"])
