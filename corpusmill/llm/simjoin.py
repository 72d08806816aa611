"""Exact similarity join of documents on word n-grams (Jaccard), by set-relation skipping.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Equal sets are one node. Two sets link when
100 * intersection >= 80 * union, that is 9 * intersection >= 4 * (n1 + n2).

1. A sketch of hashed shingle counts marks frequent shingles (a bitmap of fixed size). All sets are put in one order,
   frequent shingles last; similar sets share a shingle among their first n // 5 + 1 (the prefix).
2. Index lists: prefix entries (shingle, node, n, position, the shingle before) are sorted by shingle; lists with one entry
   go. Lists are kept sorted by size, so that a search skips the blocks whose size rules them out; long lists are dealt to
   tasks in blocks of SPLIT entries.
3. Two sets meet at the first shingle that they share. What follows its positions bounds their intersection, and so do the
   bits in which their signatures differ. Where the shingles before are equal too, it isn't their first: they met before.
   So a pair comes about once for each run of shingles that two sets share, and not once for each shingle.
4. In each long list a set is first compared with those of a few leaders whose signatures are nearest to its own. What
   leaders link is one component, and its sets needn't be compared with each other again.
5. Then sets of different components that meet in a list are compared. Where a similar set's answer is known, theirs is
   derived: |x & y| lies between |l & y| - |l - x| and |l & y| + |x - l|; only what that leaves open is looked up.
6. Open pairs are verified on whole sets, in a grid of tasks, to each of which a set goes once at most; one side's sets are
   held, the other's pass by.
7. Components by alternating large-star and small-star steps.

No step gathers a list's pairs, links or components on the driver, and none caps a list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, documents, map_arrow, written

#: Leaders of a list, those of them that a set is compared with, the length from which a list is searched set by set, eight
#: times which it has leaders, and the entries of a list that go to one task.
WORDS, LEADERS, NEAREST, LONG_LIST, SPLIT = 5, 64, 2, 8, 100_000
#: Counters of the sketch, and the count above chance from which a shingle is frequent. Only speed depends on them.
COUNTERS, FREQUENT, PART = 1 << 24, 24, 1 << 18
#: Bits of a set's signature: the power of two from its size on, within these.
LEAST_BITS, MOST_BITS = 512, 4096
#: Ids up to which those needed for verification are broadcast; pairs in a task of it; pairs that are looked at together, in
#: long lists, and by their signatures.
BROADCAST_IDS, TASK_PAIRS, TOGETHER, AT_ONCE, FAR_AT_ONCE = 2_000_000, 256, 1 << 20, 1 << 17, 1 << 13
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `width` words (five at most); with fewer words, of the whole sequence;
    without, none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(h) < width:
        return _mixed((h * _MULT[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - width + 1
    return np.unique(_mixed(sum(h[k : n + k] * _MULT[k] for k in range(width))))


def prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first n // 5 + 1 shingles in the common order."""
    if not len(s):
        return s
    slot = s >> np.uint64(40)
    late = (frequent[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return np.concatenate([s[~late], s[late]])[: len(s) // 5 + 1]


def width(n: np.ndarray) -> np.ndarray:
    """Bits of the signature of sets of these sizes."""
    return np.clip(2 ** np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), LEAST_BITS, MOST_BITS)


def signature(s: np.ndarray) -> bytes:
    """The parity of the number of shingles that fall on each bit. Each bit in which two signatures differ stands for at
    least one shingle that only one of the sets has. Halves laid over each other (by exclusive or) are a signature of half
    the bits."""
    bits = int(width(len(s)))
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def folded(signs: list[bytes | None], bits: int) -> np.ndarray:
    """Signatures of that many bits or more as rows of 64-bit words, laid over each other to that many bits (None: zeros)."""
    out = np.zeros((len(signs), bits // 64), np.uint64)
    size = np.array([len(g) if g is not None else 0 for g in signs], np.int64)
    for k in np.unique(size[size > 0]):
        own = np.flatnonzero(size == k)
        words = np.frombuffer(b"".join([signs[i] for i in own]), "<u8").reshape(len(own), -1, bits // 64)
        out[own] = np.bitwise_xor.reduce(words, axis=1)
    return out


def frequent_slots(rows: DataFrame, sets: Callable = shingles) -> np.ndarray:
    """A bitmap of COUNTERS bits: where the items of `sets`, applied to the second column of all rows, exceed chance by FREQUENT."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint8)
        n = 0
        for b in batches:
            found = np.concatenate([np.zeros(0, np.uint64), *map(sets, b.column(1).to_pylist())])
            n += len(found)
            slot, k = np.unique((found >> np.uint64(40)).astype(np.int32), return_counts=True)
            total[slot] = np.minimum(total[slot].astype(np.int64) + k, 255)
        if n:
            parts = range(COUNTERS // PART)
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int32()), "counts": pa.array([total[i * PART : (i + 1) * PART].tobytes() for i in parts], pa.binary()), "n": pa.array([n if i == 0 else 0 for i in parts], pa.int64())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        n = 0
        for b in batches:
            for part, counts, k in zip(*(c.to_pylist() for c in b.columns), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.uint8).astype(np.uint32)
                n += k
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([s.astype("<u4").tobytes() for s in sums.values()], pa.binary()), "n": pa.array([n if i == 0 else 0 for i in range(len(sums))], pa.int64())})

    parts = COUNTERS // PART
    counts = map_arrow(rows, count, "part int, counts binary, n long")
    summed = written(map_arrow(counts.repartition(min(parts, 16), "part"), add, "part int, counts binary, n long"), "sketch")
    least = FREQUENT + 2 * (summed.agg(F.sum("n")).first()[0] or 0) // COUNTERS

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flags = [np.packbits(np.frombuffer(c, "<u4") >= least, bitorder="little").tobytes() for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(flags, pa.binary())], ["part", "flags"])

    bits = np.zeros(COUNTERS // 8, np.uint8)
    for r in map_arrow(summed.select("part", "counts"), flag, "part int, flags binary").collect():  # 2 MB in all
        bits[r["part"] * PART // 8 : (r["part"] + 1) * PART // 8] = np.frombuffer(r["flags"], np.uint8)
    discard(summed)
    return bits


def fingerprints(docs: DataFrame) -> DataFrame:
    """A written table of doc_id, n, digest of the set (null: empty), the prefix and the signature."""
    frequent = frequent_slots(documents(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), pa.array([prefix(s, frequent).tobytes() for s in sets], pa.binary()), pa.array([signature(s) for s in sets], pa.binary())], ["doc_id", "n", "digest", "prefix", "sign"])

    return written(map_arrow(documents(docs), run, "doc_id long, n long, digest binary, prefix binary, sign binary"), "fingerprints")


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of values, which end where `ends` says (0 first), as binary."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype("<i8")), pa.py_buffer(values)]).cast(pa.binary())


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column without nulls, and how many each row has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind) if ends[-1] > ends[0] else np.zeros(0, kind)
    return values, np.diff(ends) // np.dtype(kind).itemsize


LISTS = "shingle long, nodes binary, sizes binary, places binary, befores binary"


def index_lists(nodes: DataFrame) -> DataFrame:
    """Lists of two nodes or more, by shingle, sorted by size and node. `befores` has the shingle before it in the prefix (at
    place 0, none: 0)."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = [np.frombuffer(p, "<i8") for p in b.column(2).to_pylist()]
            k = np.array([len(p) for p in first], np.int64)
            if k.sum():
                flat = np.concatenate(first)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(k) - k, k)
                before = np.where(place > 0, np.append(0, flat[:-1]), 0)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), k)), pa.array(np.repeat(b.column(1).to_numpy(), k).astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(before)], ["shingle", "node", "n", "place", "before"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, starts, ends, cols in runs(batches, 5):
            k = ends - starts
            many = k > 1
            if many.any():
                rows, ends_ = np.repeat(many, k), np.append(0, np.cumsum(k[many]))
                packed = lambda c, t: _binary(np.ascontiguousarray(cols[c][rows], t), ends_)
                yield pa.RecordBatch.from_arrays([pa.array(keys[many]), packed(1, "<i8"), packed(2, "<i4"), packed(3, "<i4"), packed(4, "<i8")], ["shingle", "nodes", "sizes", "places", "befores"])

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = map_arrow(nodes.select("node", "n", "prefix"), spread, "shingle long, node long, n int, place int, before long")
    rows = rows.repartition(n, "shingle").sortWithinPartitions("shingle", "n", "node", "place")
    return written(map_arrow(rows, gather, LISTS, rows=50_000), "lists")


def runs(batches: Iterator[pa.RecordBatch], width: int, keys: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Whole runs of rows with equal first columns (`keys` of them), over sorted batches: keys (of the first column), starts
    and ends in the columns given."""
    held: list[list[np.ndarray]] = []

    def cuts(cols: list[np.ndarray]) -> np.ndarray:
        new = np.zeros(len(cols[0]), bool)
        new[:1] = True
        for c in cols[:keys]:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    def out(cols: list[np.ndarray]):
        starts = cuts(cols)
        return cols[0][starts], starts, np.append(starts, len(cols[0]))[1:], cols

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(width)]
        edge = int(cuts(cols)[-1])
        if held and not edge and all(c[0] == h[-1] for c, h in zip(cols[:keys], held[0][:keys], strict=True)):
            held.append(cols)
            continue
        held.append([c[:edge] for c in cols])
        yield out([np.concatenate([h[k] for h in held]) for k in range(width)])
        held = [[c[edge:] for c in cols]]
    if held:
        yield out([np.concatenate([h[k] for h in held]) for k in range(width)])


def _may(nx, px, ny, py):
    """Whether sizes, and positions of a first common shingle, leave room for a link."""
    return (5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)) & (9 * np.minimum(nx - px, ny - py) >= 4 * (nx + ny))


PAIRS = "x long, nx int, y long, ny int, far float"


class _Pairs:
    """Collects pairs and gives batches without repeats. The set that comes first in a seeded order of all sets, as leaders
    do, is x. `far` is the share of the bits that differ in both sizes (1: not known)."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, far: np.ndarray) -> None:
        a = np.empty((len(y), 5), np.int64)
        hx, hy = _mixed(x.astype(np.uint64)), _mixed(y.astype(np.uint64))
        low = (hy < hx) | ((hy == hx) & (ny < nx))
        a[:, 0], a[:, 1] = np.where(low, y, x), np.where(low, ny, nx)
        a[:, 2], a[:, 3] = np.where(low, x, y), np.where(low, nx, ny)
        a[:, 4] = far.astype(np.float32).view(np.int32)
        self.parts.append(a)
        self.n += len(a)

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.n > least:
            a = np.unique(np.concatenate(self.parts), axis=0)
            self.parts, self.n = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1].astype(np.int32)), pa.array(a[:, 2]), pa.array(a[:, 3].astype(np.int32)), pa.array(a[:, 4].astype(np.int32).view(np.float32))], ["x", "nx", "y", "ny", "far"])


#: Columns of an entry: what it is found by, and what its set is like. `guest`: from another block of a list that is split.
ENTRY = ("shingle", "block", "node", "n", "place", "before", "guest", "component", "sign")


def entries(lists: DataFrame, of: DataFrame, leaders: bool) -> DataFrame:
    """Rows of ENTRY, a block's rows together and in order; `of` has the components and signatures.

    For leaders, of the lists of 8 * LONG_LIST or more: a list's leaders are guests in each of its blocks. Else, of all
    lists: the sets that aren't of a split list's largest component are guests in its other blocks.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shingle = b.column(0).to_numpy()
            (x, k), (n, _), (p, _), (q, _) = (_values(b.column(c), t) for c, t in ((1, "<i8"), (2, "<i4"), (3, "<i4"), (4, "<i8")))
            if not len(k):
                continue
            at = np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
            cols = [np.repeat(shingle, k), (at // SPLIT).astype(np.int32), x, n, p, q, np.zeros(len(x), bool), np.repeat(-(-k // SPLIT), k).astype(np.int32)]
            more = [cols]
            if leaders:
                for s, e in zip(np.cumsum(k) - k, np.cumsum(k), strict=True):
                    first = s + np.argsort(_mixed(x[s:e].astype(np.uint64)), kind="stable")[:LEADERS]
                    cols[6][first] = True
                    for c in range(1, int(cols[7][s])):
                        more.append([v[first] for v in cols])
                        more[-1][1] = (more[-1][1] + c) % cols[7][s]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([m[c] for m in more])) for c in range(8)], ["shingle", "block", "node", "n", "place", "before", "guest", "blocks"])

    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = lists.where(F.octet_length("nodes") >= 8 * 8 * LONG_LIST) if leaders else lists
    rows = map_arrow(chosen, spread, "shingle long, block int, node long, n int, place int, before long, guest boolean, blocks int", rows=5000).join(of, "node")
    if not leaders and (lists.agg(F.max(F.octet_length("nodes"))).first()[0] or 0) > 8 * SPLIT:
        counts = rows.where("blocks > 1").groupBy("shingle", "component").agg(F.count("*").alias("k"))
        largest = counts.groupBy("shingle").agg(F.max_by("component", F.struct("k", "component")).alias("largest"))  # a row for SPLIT entries at most
        out = rows.where("blocks > 1").join(largest, "shingle").where("component <> largest").drop("largest")
        other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda c: c != F.col("block"))
        rows = rows.unionByName(out.withColumn("block", F.explode(other)).withColumn("guest", F.lit(True)))
    return rows.select(*ENTRY).repartition(parts, "shingle", "block").sortWithinPartitions("shingle", "block", "n", "node")


def _meet(px: np.ndarray, qx: np.ndarray, py: np.ndarray, qy: np.ndarray) -> np.ndarray:
    """Whether two sets' common shingle, with these places and shingles before, may be their first."""
    return (px == 0) | (py == 0) | (qx != qy)


def _far(nx: np.ndarray, gx: list, ny: np.ndarray, gy: list) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sizes and signatures: whether these leave room for a link, and the share of bits that differ (1: of an id
    with several texts, which has no signature and isn't ruled out)."""
    differ, known, bits = np.zeros(len(nx), np.int64), np.ones(len(nx), bool), width(np.minimum(nx, ny))
    for w in np.unique(bits):
        own = np.flatnonzero(bits == w)
        a, b = [gx[i] for i in own], [gy[i] for i in own]
        known[own] = [u is not None and v is not None for u, v in zip(a, b, strict=True)]
        differ[own] = np.bitwise_count(folded(a, int(w)) ^ folded(b, int(w))).sum(axis=1, dtype=np.int64)
    total = nx + ny
    return ~known | (9 * (total - differ) >= 8 * total), np.where(known, differ / np.maximum(total, 1), 1.0)


class Bounds(NamedTuple):
    """What sets may link, by sizes and places, and by what entries carry of their sets: see _may and _far."""

    may: Callable
    far: Callable


SIGNATURES = Bounds(_may, _far)


def leader_pairs(lists: DataFrame, of: DataFrame, by: Bounds = SIGNATURES) -> DataFrame:
    """The sets of each list of 8 * LONG_LIST or more, each with the NEAREST of its leaders, which are the LEADERS sets
    that come first in a seeded order of all sets. Which leaders are taken touches speed only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Pairs()
        for _, starts, ends, cols in runs(batches, len(ENTRY), 2):
            for s, e in zip(starts, ends, strict=True):
                x, n, p, q, lead, sign = (cols[c][s:e] for c in (2, 3, 4, 5, 6, 8))
                n = n.astype(np.int64)
                first = np.flatnonzero(lead)
                far = np.full((len(first), e - s), np.inf)
                for k, i in enumerate(first):
                    lo, hi = np.searchsorted(n, -(-4 * n[i] // 5)), np.searchsorted(n, 5 * n[i] // 4, side="right")  # blocks outside are skipped
                    at = lo + np.flatnonzero(by.may(n[i], p[i], n[lo:hi], p[lo:hi]) & (x[lo:hi] != x[i]))
                    if len(at):
                        ok, share = by.far(np.full(len(at), n[i]), [sign[i]] * len(at), n[at], sign[at])
                        far[k, at] = np.where(ok, share, np.inf)
                near = np.argsort(far, axis=0, kind="stable")[:NEAREST]
                for k, i in enumerate(first):
                    at = np.flatnonzero(((near == k) & np.isfinite(far[k])).any(axis=0) & _meet(p[i], q[i], p, q))
                    if len(at):
                        out.add(np.full(len(at), x[i]), np.full(len(at), n[i]), x[at], n[at], far[k, at])
                yield from out.take(300_000)
        yield from out.take()

    return map_arrow(entries(lists, of, True), run, PAIRS, rows=50_000).select("x", "nx", "y", "ny").distinct()


def cross_pairs(lists: DataFrame, of: DataFrame, by: Bounds = SIGNATURES) -> DataFrame:
    """Pairs of each list whose components differ, that sizes, positions and signatures leave room for, in the lists where
    they may meet first. Members of a long list's largest component are only met from outside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Pairs()

        def look(cols: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> None:
            """Pairs of rows i and j."""
            n, p, q, c = cols[3].astype(np.int64), cols[4], cols[5], cols[7]
            ok = (c[i] != c[j]) & ~(cols[6][i] & cols[6][j]) & _meet(p[i], q[i], p[j], q[j]) & by.may(n[i], p[i], n[j], p[j])
            some, other = i[ok], j[ok]
            for at in range(0, len(some), FAR_AT_ONCE):
                i, j = some[at : at + FAR_AT_ONCE], other[at : at + FAR_AT_ONCE]
                ok, far = by.far(n[i], cols[8][i], n[j], cols[8][j])
                i, j = i[ok], j[ok]
                out.add(cols[2][i], n[i], cols[2][j], n[j], far[ok])

        for _, starts, ends, cols in runs(batches, len(ENTRY), 2):
            if not len(starts):
                continue
            mixed = np.minimum.reduceat(cols[7], starts) != np.maximum.reduceat(cols[7], starts)
            # short lists, all at once: each row with those after it, up to the size that is too large
            short = mixed & (ends - starts < 8 * LONG_LIST)
            rows = np.flatnonzero(np.repeat(short, ends - starts))
            run_of = np.repeat(np.arange(len(starts)), ends - starts)
            key = (run_of << 32) + cols[3]
            last = np.searchsorted(key, (run_of[rows] << 32) + np.minimum(5 * cols[3][rows].astype(np.int64) // 4, (1 << 32) - 1), side="right")
            k = last - rows - 1
            ends_ = np.cumsum(k)
            at = 0
            while at < len(rows):
                z = max(at + 1, int(np.searchsorted(ends_, (ends_[at - 1] if at else 0) + TOGETHER)))
                i = np.repeat(rows[at:z], k[at:z])
                j = i + 1 + np.arange(len(i)) - np.repeat(ends_[at:z] - k[at:z] - (ends_[at - 1] if at else 0), k[at:z])
                look(cols, i, j)
                yield from out.take(300_000)
                at = z
            for s, e in zip(starts[mixed & ~short], ends[mixed & ~short], strict=True):
                n, c = cols[3][s:e].astype(np.int64), cols[7][s:e]
                _, own, size = np.unique(c, return_inverse=True, return_counts=True)
                largest = own == size.argmax()
                rest = np.flatnonzero(~largest)
                lo, hi = np.searchsorted(n, -(-4 * n[rest] // 5)), np.searchsorted(n, 5 * n[rest] // 4, side="right")
                sums, at = np.cumsum(hi - lo), 0
                while at < len(rest):  # many sets at once
                    z = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + AT_ONCE)))
                    k = (hi - lo)[at:z]
                    i, j = np.repeat(rest[at:z], k), np.repeat(lo[at:z] - np.cumsum(k) + k, k) + np.arange(k.sum())
                    ok = largest[j] | (j > i)
                    look(cols, s + i[ok], s + j[ok])
                    yield from out.take(300_000)
                    at = z
        yield from out.take()

    return map_arrow(entries(lists, of, False), run, PAIRS, rows=50_000).distinct()


def verified(docs: DataFrame, pairs: DataFrame, items: Callable = shingles) -> DataFrame:
    """Pairs (written) with `both`, the size of their intersection on whole sets.

    Pairs are dealt to a grid of tasks by the hash of either side, so that a set that is in many pairs goes to a row or a
    column of the grid, and not once for each pair. A task holds the sets of its x, and reads those of its y one by one, each
    before its pairs.
    """
    spark = docs.sparkSession
    count = pairs.count()
    if not count:  # no text is read for nothing
        return spark.createDataFrame([], "x long, nx int, y long, ny int, both int")
    side = max(1, int(np.ceil(np.sqrt(count / TASK_PAIRS))))
    at = lambda c, salt: F.pmod(F.xxhash64(F.lit(salt), c), F.lit(side)).cast("int")
    placed = pairs.select("x", "nx", "y", "ny", (at("x", 1) * side + at("y", 2)).alias("task"))
    needs = placed.select("task", F.lit(0).alias("kind"), F.col("x").alias("id")).unionByName(placed.select("task", F.lit(1).alias("kind"), F.col("y").alias("id"))).distinct()
    ids = needs.select("id").distinct()
    few = 2 * count <= BROADCAST_IDS
    texts = documents(docs).join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("id"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [items(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in found], pa.int32()), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "n", "items"])

    found = map_arrow(texts, sets, "id long, n int, items binary").join(F.broadcast(needs) if few else needs, "id")
    blank = lambda t: F.lit(None).cast(t)
    rows = found.select("task", "kind", "id", "n", F.lit(0).alias("pair"), blank("long").alias("x"), blank("int").alias("nx"), "items")
    rows = rows.unionByName(placed.select("task", F.lit(1).alias("kind"), F.col("y").alias("id"), F.col("ny").alias("n"), F.lit(1).alias("pair"), "x", "nx", blank("binary").alias("items")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "task").sortWithinPartitions("task", "kind", "id", "pair")

    def common(a: np.ndarray, c: np.ndarray) -> int:
        if len(a) > len(c):
            a, c = c, a
        i = np.searchsorted(c, a)
        return int((c[np.minimum(i, len(c) - 1)] == a).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, own, now = None, {}, {}, None  # an id with several texts has several sets, even of one size
        for b in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for t, kind, i, n, pair, x, nx, items in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if t != task:
                    task, held, own, now = t, {}, {}, None
                if kind == 0:
                    held.setdefault((i, n), []).append(np.frombuffer(items, "<u8"))
                    continue
                if i != now:
                    now, own = i, {}
                if not pair:
                    own.setdefault(n, []).append(np.frombuffer(items, "<u8"))
                elif (x, nx) in held and n in own:
                    out.append((x, nx, i, n, max(common(u, v) for u in held[x, nx] for v in own[n])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["x", "nx", "y", "ny", "both"])

    return written(map_arrow(rows, run, "x long, nx int, y long, ny int, both int"), "verified")


_LINK = "9 * both >= 4 * (nx + ny)"


def derived(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """pairs with `link`: true or false where the answers of a set highly similar to x or y decide it, else null."""
    both_ways = answers.select("x", "nx", "y", "ny", "both").unionByName(answers.select(F.col("y").alias("x"), F.col("ny").alias("nx"), F.col("x").alias("y"), F.col("nx").alias("ny"), "both"))
    nearest = both_ways.where(_LINK).groupBy("x", "nx").agg(F.max(F.struct("both", "y", "ny")).alias("m"))
    near = nearest.select(F.col("x").alias("s"), F.col("nx").alias("ns"), F.col("m.y").alias("l"), F.col("m.ny").alias("nl"), F.col("m.both").alias("sl"))
    known = both_ways.select(F.col("x").alias("l"), F.col("nx").alias("nl"), F.col("y").alias("o"), F.col("ny").alias("no"), F.col("both").alias("lo"))
    out = pairs.withColumn("low", F.lit(0)).withColumn("high", F.least("nx", "ny"))
    for s, ns, o, no in (("x", "nx", "y", "ny"), ("y", "ny", "x", "nx")):
        step = out.join(near.withColumnsRenamed({"s": s, "ns": ns}), [s, ns], "left").join(known.withColumnsRenamed({"o": o, "no": no}), ["l", "nl", o, no], "left")
        low = F.greatest("low", F.coalesce(F.col("lo") - (F.col("nl") - F.col("sl")), F.lit(0)))
        high = F.least("high", F.coalesce(F.col("lo") + (F.col(ns) - F.col("sl")), F.col("high")))
        out = step.withColumn("low", low).withColumn("high", high).select("x", "nx", "y", "ny", "far", "low", "high")
    need = 4 * (F.col("nx") + F.col("ny"))
    return out.select("x", "nx", "y", "ny", "far", F.when(9 * F.col("low") >= need, True).when(9 * F.col("high") < need, False).alias("link"))


def connected(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node in a link (x, y).

    Large-star and small-star steps alternate, each a minimum by node and an equi-join, until every component is a star: each
    node has one edge to a smaller one, which has none. Links that are stars already take no step.
    """
    edges = written(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(F.count_if(F.expr("up + down > 1 and up > 0"))).first()[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, edges = edges, written(small, "edges")
        discard(before)


def stars(components: DataFrame) -> DataFrame:
    """The links (x, y) of nodes with their components, from which connected() goes on."""
    return components.where("node <> component").select(F.col("node").alias("x"), F.col("component").alias("y"))


def placed_in(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """pairs with the components cx and cy of their sets; a set in no link is its own."""
    for side, name in (("x", "cx"), ("y", "cy")):
        c = components.select(F.col("node").alias(side), F.col("component").alias(name))
        pairs = pairs.join(c, side, "left").withColumn(name, F.coalesce(name, side))
    return pairs


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Null, empty and blank texts have no shingles and are their own component; a null id is linked with nothing and has a
    null component; rows with the same id are one document, linked through any of its texts. An empty table gives no rows.
    """
    prints = fingerprints(docs)
    usable = prints.where("digest is not null and doc_id is not null")
    nodes = written(usable.groupBy("digest", "n").agg(F.min("doc_id").alias("node"), F.first("prefix").alias("prefix"), F.first("sign").alias("sign")), "nodes")
    lists = index_lists(nodes)
    signs = written(nodes.groupBy("node").agg(F.when(F.count("*") == 1, F.first("sign")).alias("sign")), "signs")
    pair = ["x", "nx", "y", "ny"]
    near = written(leader_pairs(lists, signs.withColumn("component", F.col("node"))), "pairs")
    first = verified(docs, near)
    known = written(connected(first.where(_LINK).select("x", "y")), "components")
    cross = written(cross_pairs(lists, signs.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "sign")), "pairs")
    derived_ = written(derived(cross, first), "open")
    links = stars(known).unionByName(derived_.where("link").select("x", "y"))
    # one link joins two components, so that each set's likeliest pair comes first
    open_ = derived_.where("link is null").select(*pair, "far")
    both_ways = open_.select(F.col("x").alias("s"), F.col("nx").alias("ns"), F.struct("far", *pair).alias("p")).unionByName(open_.select(F.col("y").alias("s"), F.col("ny").alias("ns"), F.struct("far", *pair).alias("p")))
    likeliest = written(both_ways.groupBy("s", "ns").agg(F.min("p").alias("p")).select("p.*").distinct(), "likeliest")
    second = verified(docs, likeliest.select(pair))
    links = links.unionByName(second.where(_LINK).select("x", "y"))
    now = written(connected(links), "components")
    left = written(placed_in(open_.join(likeliest.select(pair), pair, "left_anti"), now).where("cx <> cy").drop("cx", "cy"), "pairs")
    rest = written(derived(left, first.unionByName(second)), "open")
    third = verified(docs, rest.where("link is null").select(pair))
    links = stars(now).unionByName(rest.where("link").select("x", "y")).unionByName(third.where(_LINK).select("x", "y"))
    out = labelled(prints, nodes, links)
    discard(lists, signs, near, first, known, cross, derived_, likeliest, second, now, left, rest, third)
    return out


def labelled(prints: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of prints, by links (x, y) of nodes; nodes have digest and n."""
    usable = prints.where("digest is not null and doc_id is not null")
    same = usable.select("doc_id", "digest", "n").distinct().groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id")
    classes = nodes.select("digest", "n", "node")
    twice = usable.select("doc_id", "digest", "n").join(same, "doc_id").join(classes, ["digest", "n"]).select(F.col("doc_id").alias("x"), F.col("node").alias("y"))
    found = connected(links.unionByName(twice))
    rows = prints.select("doc_id", "n", "digest").join(classes, ["digest", "n"], "left").join(found, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
