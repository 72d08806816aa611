"""Exact near-duplicate removal on character shingles: equal segments of sets, then greedy leaders in input order.

1. Sets with a Jaccard similarity of t differ in at most (1 - t) / (1 + t) (a + b) shingles. The shingles are dealt to more
   segments than that by their hash, so that two such sets agree in at least one whole segment. A key is the hash of a
   segment's shingles, several of them, so that unrelated sets hardly ever share one, however frequent their shingles are.
   The number of segments goes by size: a set has keys for its class of sizes and, at its lower end, for the class below.
   Of many segments similar sets agree in a third or more, so that the first few of them (some 80) are enough: none of these
   agrees with a chance below MISSED. Segments of few shingles, which unrelated sets do share, have no key then.
2. Rows of one domain and key meet in an equi-join, in the first of a run of segments that they share.
3. Signatures rule out most of what isn't similar; sets are compared for the rest alone.
4. Where lists are long, rows that no earlier row of their lists can remove are settled first, with what they remove, so that
   a large group of near copies is compared with one row and not all with all. That ends when it no longer halves the work.

A LeaderIndex holds keys, signatures and texts of the rows that stayed (sets of shingles take several times as much), so that
later batches are cleaned without the tables of earlier ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import bucketed, discard, stored

SHINGLE = 5
#: 64-bit words of a set's signature; entries of a list from which heads are settled first, where lists have more pairs than so
#: many an entry, and how often. The last three touch speed only.
SIGN_WORDS, LONG_LIST, FEW, ROUNDS = 64, 64, 4, 8
#: Sizes of a class, as a multiple of its least.
CLASS = 1.5
#: The chance at most that two sets, similar just at the threshold, of so many segments that only some have keys, share none.
MISSED = 1e-15
#: As many keys of a class, if need be, for segments of more shingles each.
MANY = 96


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the character 5-grams of the stripped, lower-cased text; shorter texts are one."""
    t = (text or "").strip().lower()
    if not t:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(t.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    k = min(SHINGLE, len(codes))
    n = len(codes) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ codes[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(s: np.ndarray) -> list[int]:
    """The parity of the number of hashes that fall on each bit; a bit that differs stands for a hash that only one set has."""
    bits = SIGN_WORDS * 64
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).view("<i8").tolist()


def _agrees(shared: float, segments: int, threshold: float, fewest: int) -> float:
    """The chance that a segment holds none of the shingles that differ and `fewest` or more of those that two sets share, whose
    similarity is the threshold. Segments that are full leave others empty, so that many of them fail together more seldom
    than if they were independent."""
    mean = shared / segments
    fewer = sum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(fewest))
    return (1 - 1 / segments) ** ((1 - threshold) / threshold * shared) * max(1 - fewer, 0)


def _sampled(least: int, above: int, segments: int, threshold: float) -> tuple[int, int]:
    """(how many of a class's segments have keys, the fewest shingles of one that has); (segments, 0): all, in need of no chance."""
    best = (segments, 0)
    for fewest in range(1, 9):
        p = min(_agrees(shared, segments, threshold, fewest) for shared in (2 * threshold / (1 + threshold) * least, above - 1))
        n = math.ceil(math.log(MISSED) / math.log1p(-p)) if 0 < p < 1 else segments
        if n < segments and (fewest == 1 or n <= MANY):
            best = n, fewest
    return best


@cache
def classes(threshold: float) -> tuple[list[int], list[int], list[int], list[tuple[int, int]]]:
    """Of each class of sizes: its least size, its segments, how many of them agree at least, and _sampled()."""
    least, wide = [1], max(CLASS, 1 / threshold)  # so that similar sets are of one class or of neighbours
    while least[-1] < 1 << 31 and threshold < 1:
        least.append(max(least[-1] + 1, int(np.ceil(wide * least[-1]))))
    least.append(1 << 32)
    segments, agree = [], []
    for above in least[1:]:
        most = int((1 - threshold) / threshold * (above - 1) + 1e-6)  # one set of the class, and one that is larger by the threshold
        agree.append(1 + int(most * (1 / 16 + 1.5 * np.exp(-threshold / max((1 - threshold) * wide, 1e-9)))))  # more than are empty by chance
        segments.append(most + agree[-1])
    return least[:-1], segments, agree, [_sampled(*x, threshold) for x in zip(least, least[1:], segments)]


def keys(s: np.ndarray, threshold: float) -> np.ndarray:
    """The keys of a set's segments, one class after the other, 0 before each class and for segments that have none.

    Where all segments have keys, those without shingles have one only if a set has so many of them that all in which two sets
    agree may be empty.
    """
    least, segments, agree, sampled = classes(threshold)
    own = int(np.searchsorted(least, len(s), side="right")) - 1
    out = []
    for k in [own] + ([own - 1] if own and threshold * len(s) - 1e-6 <= least[own] - 1 else []):
        n, fewest = sampled[k]
        at = ((s >> np.uint64(32)) * np.uint64(segments[k]) >> np.uint64(32)).astype(np.int64)
        mine = np.flatnonzero(at < n)
        part = s[mine[np.argsort(at[mine], kind="stable")]]
        size = np.bincount(at[mine], minlength=n)
        used = np.flatnonzero(size)
        h = np.zeros(n, np.uint64)
        if len(part):
            h[used] = np.add.reduceat(_mixed(part), (np.cumsum(size) - size)[used])
        salted = _mixed(h + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        salted[salted == 0] = 1
        if fewest:
            salted[size < fewest] = 0
        elif n - len(used) < agree[k]:
            salted[size == 0] = 0
        out += [np.zeros(1, np.uint64), salted]
    return np.concatenate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_PRINTS = "id long, dom string, c int, sign array<long>, keys array<long>, text string"


def _rows(df: DataFrame, key: str, domain: str, text: str, whole: bool = False) -> DataFrame:
    """id, dom, text and, where whole rows are asked for, the other columns as a struct `rest`; dealt by id."""
    dom = F.coalesce(F.concat(F.lit("="), F.col(domain).cast("string")), F.lit(""))
    rest = [F.struct(*(c for c in df.columns if c != text)).alias("rest")] if whole else []
    return df.select(F.col(key).cast("long").alias("id"), dom.alias("dom"), F.col(text).alias("text"), *rest).repartition(_parts(df), "id")  # shingling is the work: one task a file would be too few


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _prints(rows: DataFrame, threshold: float) -> DataFrame:
    """A stored table of _PRINTS and `rest`; with the texts, so that what made the rows isn't run again for those that are compared.
    It is in buckets by id, as what follows joins it by id again and again and picks few of its texts each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                sets = [shingle_hashes(t) for t in part.column(2).to_pylist()]
                long = lambda x: pa.array(x, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int32()), long([signature(s) for s in sets]), long([keys(s, threshold).view(np.int64) if len(s) else s.view(np.int64) for s in sets]), *part.columns[2:]], ["id", "dom", "c", "sign", "keys", *part.schema.names[2:]])

    return bucketed(rows.mapInArrow(run, StructType([*StructType.fromDDL(_PRINTS), *rows.schema.fields[3:]])), "prints", "id", _parts(rows))


def _entries(prints: DataFrame) -> DataFrame:
    """h, id, c and `before`, the key of the segment before (0: none). The domain is part of the hash h."""
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("keys", F.lit(1), F.greatest(F.size("keys") - 1, F.lit(0))))
    e = prints.where("c > 0").select("id", "c", "dom", F.explode(F.arrays_zip("keys", before.alias("before"))).alias("e"))
    return e.where("e.keys <> 0").select(F.xxhash64("dom", "e.keys").alias("h"), "id", "c", F.col("e.before").alias("before"))


def _may(a: str, b: str, threshold: float) -> Column:
    """Whether sizes leave room for the similarity, and the segments before don't agree too (else the sets met there)."""
    ca, cb, before, other = F.col(f"{a}.c"), F.col(f"{b}.c"), F.col(f"{a}.before"), F.col(f"{b}.before")
    return (F.least(ca, cb) >= threshold * F.greatest(ca, cb) - 1e-6) & ((before == 0) | (before != other))


def _texts(prints: DataFrame, ids: DataFrame) -> DataFrame:
    """id and text of the rows with one of the ids."""
    return prints.select("id", "text").join(ids, "id", "left_semi")


def _reach(pairs: DataFrame, t: float) -> DataFrame:
    """(i, j) of the pairs (i, j, ti, tj) whose texts' sets are similar. Texts are shuffled rather than sets, which take several
    times as much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                made: dict[str | None, np.ndarray] = {}
                keep = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    for text in (x, y):
                        if text not in made:
                            made[text] = shingle_hashes(text)
                    both = len(np.intersect1d(made[x], made[y], assume_unique=True))
                    keep.append(both / (len(made[x]) + len(made[y]) - both) >= t)
                yield part.select(["i", "j"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("i", "j", "ti", "tj").mapInArrow(run, "i long, j long")


class _Side:
    """One side of a comparison: its signatures, and its texts by id."""

    def __init__(self, prints: DataFrame, texts):
        self.prints, self.texts = prints, texts

    def signs(self, name: str) -> DataFrame:
        return self.prints.select(F.col("id").alias(name), F.col("dom").alias(f"d{name}"), F.col("c").alias(f"c{name}"), F.col("sign").alias(f"g{name}"))


def _similar(pairs: DataFrame, left: _Side, right: _Side, t: float) -> DataFrame:
    """Those of the pairs (i of left, j of right) that are of one domain and whose similarity reaches the threshold."""
    differ = F.aggregate(F.zip_with("gi", "gj", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    total, most = F.col("ci") + F.col("cj"), (F.col("ci") + F.col("cj") - differ) / 2
    one = F.least("di", "dj") == F.greatest("di", "dj")  # di = dj would be one of the second join's keys, for which signatures would be shuffled
    open_ = stored(pairs.join(left.signs("i"), "i").join(right.signs("j"), "j").where(one).where(most + 1e-6 >= t * (total - most)).select("i", "j"), "open")
    i, j = open_.select(F.col("i").alias("id")), open_.select(F.col("j").alias("id"))
    if left is right:
        a = b = stored(left.texts(i.unionByName(j).distinct()), "texts")
    else:
        a, b = left.texts(i.distinct()), right.texts(j.distinct())
    made = a
    a, b = a.select(F.col("id").alias("i"), F.col("text").alias("ti")), b.select(F.col("id").alias("j"), F.col("text").alias("tj"))
    out = stored(_reach(open_.join(a, "i").join(b, "j"), t), "similar")
    discard(open_, made)
    return out


class _Join:
    """The tables of one comparison of rows with each other."""

    def __init__(self, df: DataFrame, key: str, domain: str, text: str, threshold: float, whole: bool = False):
        self.threshold = threshold
        self.prints = _prints(_rows(df, key, domain, text, whole), threshold)
        self.side = _Side(self.prints, lambda ids: _texts(self.prints, ids))

    def met(self, prints: DataFrame | None = None) -> tuple[DataFrame, int]:
        """(entries of the keys that two rows or more have, the length of the longest list)."""
        entries = _entries(self.prints if prints is None else prints)
        lists = stored(entries.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "lists")
        out = stored(entries.join(lists, "h", "left_semi"), "entries")
        longest = lists.agg(F.max("k")).first()[0] or 0
        discard(lists)
        return out, longest

    def pairs(self, entries: DataFrame) -> tuple[int, int, int]:
        """(the length of the longest list, entries, pairs that lists have at most)."""
        k = F.col("count")
        x = entries.groupBy("h").count().agg(F.max(k), F.sum(k), F.sum(k * (k - 1) / 2)).first()
        return x[0] or 0, x[1] or 0, int(x[2] or 0)

    def candidates(self, entries: DataFrame) -> DataFrame:
        """(i, j), i before j, of all lists."""
        a, b = entries.alias("a"), entries.alias("b")
        on = (F.col("a.h") == F.col("b.h")) & (F.col("a.id") < F.col("b.id"))
        return a.join(b, on & _may("a", "b", self.threshold)).select(F.col("a.id").alias("i"), F.col("b.id").alias("j")).distinct()

    def similar(self, pairs: DataFrame) -> DataFrame:
        return _similar(pairs, self.side, self.side, self.threshold)


def similar_pairs(df: DataFrame, key: str, domain: str, text: str, threshold: float = 0.9) -> DataFrame:
    """(i, j), i before j, of one domain with a Jaccard similarity of at least the threshold. No pair is missed; blank texts
    and rows without a key are in none."""
    join = _Join(df, key, domain, text, threshold)
    entries, _ = join.met()
    out = join.similar(join.candidates(entries))
    discard(join.prints, entries)
    return out


def _settled(join: _Join, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries that are left, rows that go), after settling the rows that come first in each of their lists: nothing can
    remove them, and they remove what is similar to them."""
    lists = stored(entries.groupBy("h").agg(F.min(F.struct("id", "c", "before")).alias("head")), "lists")
    on = entries.join(lists, "h")
    first = stored(on.groupBy("id").agg(F.bool_and(F.col("id") == F.col("head.id")).alias("is_first")).where("is_first").select("id"), "first")
    met = on.where("id <> head.id").join(first.select(F.col("id").alias("of")), F.col("head.id") == F.col("of"), "left_semi")
    met = met.select(F.col("head").alias("a"), F.struct("id", "c", "before").alias("b")).where(_may("a", "b", join.threshold))
    similar = join.similar(met.select(F.col("a.id").alias("i"), F.col("b.id").alias("j")).distinct())
    gone = stored(similar.select(F.col("j").alias("d")).distinct(), "gone")
    left = stored(entries.join(gone.select(F.col("d").alias("id")).unionByName(first), "id", "left_anti"), "entries")
    discard(lists, first, entries, similar)
    return left, gone


def _leaders(join: _Join, prints: DataFrame | None = None) -> DataFrame:
    """(d) of the rows that go; see leaders(). `prints`: those of the join's rows that take part, if not all."""
    entries, longest = join.met(prints)
    gone = []
    before = math.inf
    for _ in range(ROUNDS):
        if longest < LONG_LIST:
            break
        longest, n, pairs = join.pairs(entries)
        if longest < LONG_LIST or pairs <= FEW * n or pairs > before / 2:
            break
        before = pairs
        entries, more = _settled(join, entries)
        gone.append(more)
    open_ = join.similar(join.candidates(entries))
    while not open_.isEmpty():
        later = open_.select(F.col("j").alias("n")).distinct()
        stay = open_.select(F.col("i").alias("n")).distinct().join(later, "n", "left_anti")
        drop = stored(open_.join(stay, open_["i"] == stay["n"], "left_semi").select(F.col("j").alias("d")).distinct(), "gone")
        gone.append(drop)
        before, open_ = open_, stored(open_.join(drop, open_["i"] == drop["d"], "left_anti").join(drop, open_["j"] == drop["d"], "left_anti"), "pairs")
        discard(before)
    discard(entries, open_)
    out = join.prints.sparkSession.createDataFrame([], "d long")
    for g in gone:
        out = out.unionByName(g)
    return out.distinct()


def leaders(df: DataFrame, key: str, domain: str, text: str, threshold: float = 0.9) -> DataFrame:
    """(key) of the rows that go: a row goes if an earlier row that stays is similar to it.

    Rounds: rows without an undecided or staying earlier neighbour stay, their later neighbours go; until none is undecided.
    Blank texts, and rows without a key, stay; a null domain is one of its own.
    """
    join = _Join(df, key, domain, text, threshold)
    out = _leaders(join)
    discard(join.prints)
    return out.select(F.col("d").alias(key))


def kept(df: DataFrame, key: str, domain: str, text: str, threshold: float = 0.9) -> DataFrame:
    """The rows of df that leaders() leaves, with all their columns: from the one table that comparing them made, so that df is run
    once and its texts aren't shuffled again."""
    join = _Join(df, key, domain, text, threshold, whole=True)
    gone = F.col("d").isNotNull()
    rows = join.prints.join(_leaders(join), F.col("id") == F.col("d"), "left").where(~gone)
    staying = F.when(~gone, F.col("text"))  # else what is made of texts would be made before the join, in Python, after which buckets don't count
    return rows.select(*(staying.alias(c) if c == text else F.col("rest")[c].alias(c) for c in df.columns))


class LeaderIndex:
    """The rows that stayed of the batches cleaned so far, in a folder: keys, in buckets by hash, and signatures and texts.

    A batch's rows are compared with the leaders of the batches before it, then with each other. What they cost grows with the
    batch: of the index, keys are read without being shuffled, and signatures and texts of the leaders that a key points at are
    picked by id. Cleaning the batches one after the other gives what one run over all of them gives, if
    a batch's rows come after those of the batches before. A batch that is added again, after a failure or not, replaces what
    it had added before; batches after it must then be added again too.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.9, buckets: int = 64):
        self.spark, self.threshold, self.buckets = spark, threshold, buckets
        self.keys, self.sets = (f"leaders_{kind}_{hashlib.md5(path.encode()).hexdigest()}" for kind in ("keys", "sets"))
        parts = lambda by: f"USING parquet PARTITIONED BY (batch) CLUSTERED BY ({by}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.keys} (h BIGINT, id BIGINT, c INT, before BIGINT, batch INT) {parts('h')} LOCATION '{path}/keys'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.sets} (id BIGINT, dom STRING, c INT, sign ARRAY<BIGINT>, text STRING, batch INT) {parts('id')} LOCATION '{path}/sets'")
        at = spark._jvm.org.apache.hadoop.fs.Path(path, "sets")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            for table in (self.keys, self.sets):
                spark.sql(f"MSCK REPAIR TABLE {table}")  # batches that another session added

    def batches(self) -> list[int]:
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.sets}").collect())

    def pairs(self, prints: DataFrame, batch: int) -> DataFrame:
        """(i of the index, j of the prints) that a key points at."""
        a, b = self.spark.table(self.keys).where(F.col("batch") < batch).alias("a"), _entries(prints).alias("b")
        return b.join(a, (F.col("a.h") == F.col("b.h")) & _may("a", "b", self.threshold)).select(F.col("a.id").alias("i"), F.col("b.id").alias("j")).distinct()

    def add(self, df: DataFrame, key: str, domain: str, text: str, batch: int) -> DataFrame:
        """(key) of the batch's rows that go; those that stay become part of the index."""
        if any(b > batch for b in self.batches()):
            raise ValueError(f"batches after {batch} are in the index already")
        join = _Join(df, key, domain, text, self.threshold)
        rest, known, used = join.prints, None, []
        if any(b < batch for b in self.batches()):
            old = self.spark.table(self.sets).where(F.col("batch") < batch)
            met = stored(self.pairs(join.prints, batch), "pairs")
            leaders_ = _Side(old.join(met.select(F.col("i").alias("id")).distinct(), "id", "left_semi"), lambda ids: _texts(old, ids))
            similar = _similar(met, leaders_, join.side, self.threshold)
            known = stored(similar.select(F.col("j").alias("d")).distinct(), "gone")
            rest = join.prints.join(known, F.col("id") == F.col("d"), "left_anti")
            used = [met, similar, known]
        gone = _leaders(join, rest)
        gone = stored(gone.unionByName(known) if known is not None else gone, "gone")
        stay = join.prints.where("c > 0 and id is not null").join(gone, F.col("id") == F.col("d"), "left_anti")
        self._put(self.keys, _entries(stay).select("h", "id", "c", "before"), batch)
        self._put(self.sets, stay.select("id", "dom", "c", "sign", "text"), batch)
        discard(join.prints, *used)
        return gone.select(F.col("d").alias(key))

    def _put(self, table: str, rows: DataFrame, batch: int) -> None:
        """Replaces the batch's part of a table: a task for each bucket."""
        rows.repartition(self.buckets, rows.columns[0]).createOrReplaceTempView(f"{table}_new")
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch = {batch}) SELECT * FROM {table}_new")
        self.spark.catalog.dropTempView(f"{table}_new")
