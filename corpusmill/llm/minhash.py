"""Near duplicates by bottom-k sketches of one hash function.

A document's set is its distinct 4-word shingles; two sets link when 100 * intersection >= 80 * union. Equal sets are one node.

1. A sketch is the KEPT smallest of a set's 64-bit hashes (of a smaller set, all).
2. Inverted lists of retained values: where two sets link, their sketches have at least LEAST values in common, so that they
   share one of the first KEPT - LEAST + 1 in any common order: rare values come first, and the most frequent have no lists.
   Two sets meet in the list of the first value that they share.
3. The KEPT smallest values of both sketches are the sketch of the union; those that both have estimate the similarity.
   Pairs with fewer than LEAST of them go. Of sets that are retained whole the sketches decide exactly. Of the others, parity
   signatures of the full sets bound the similarity from above, as a first step of the exact check.
4. In long lists, sets meet their nearest leaders first, and later only those of other components.
5. What is left is verified on full sets; links make components.

That a pair with a similarity of 0.8 has fewer than LEAST = 24 of 64 in common has a chance below 2 * 10^-12. Nothing else can
lose a link: lists and partners have no cap.

Null, empty and blank texts have no shingles and are their own component; a null id is linked with nothing, has a null
component and is kept; rows with the same id are one document, linked through any of its texts. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simjoin
from .common import discard, documents, map_arrow, written

WORDS = 4
#: Values of a sketch; how many of a union's sketch both sets have at least; pairs whose sketches are merged together.
KEPT, LEAST, TOGETHER = 64, 24, 4096
_NONE = np.uint32(0xFFFFFFFF)

shingles = partial(simjoin.shingles, width=WORDS)


def _values(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, "<u8")


def _spread(sketch: bytes) -> np.ndarray:
    """Values as they are counted: retained values are small, counters go by the highest bits."""
    return simjoin._mixed(_values(sketch))


def indexed(s: np.ndarray, n: int, frequent: np.ndarray) -> np.ndarray:
    """The values of a sketch by which its set is found."""
    slot = _spread(s.tobytes()) >> np.uint64(40)
    late = (frequent[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    few = n // 5 + 1  # of sets that only link with sets that are retained whole
    return np.concatenate([s[~late], s[late]])[: few if 5 * n <= 4 * KEPT else max(few, n - LEAST + 1) if n <= KEPT else KEPT - LEAST + 1]


def _may(nx, px, ny, py):
    """Whether sizes leave room for a link."""
    return 5 * np.minimum(nx, ny) >= 4 * np.maximum(nx, ny)


def _rows(sketches: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sketches as rows of their highest 32 bits, filled up with _NONE, and which are known."""
    out = np.full((len(sketches), KEPT), _NONE, np.uint32)
    for size in {len(s) for s in sketches if s}:
        own = [i for i, s in enumerate(sketches) if s and len(s) == size]
        out[own, : size // 4] = np.frombuffer(b"".join([sketches[i] for i in own]), "<u4").reshape(len(own), -1)
    return out, np.array([s is not None for s in sketches])


def estimated(nx: np.ndarray, gx: list, ny: np.ndarray, gy: list) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sizes and sketches: whether the sketch of their union leaves room for a link, and the share of it that only
    one has (1: of an id with several texts, which isn't ruled out)."""
    ok, far = np.ones(len(nx), bool), np.ones(len(nx))
    for at in range(0, len(nx), TOGETHER):
        z = slice(at, at + TOGETHER)
        (a, known_a), (b, known_b) = _rows(gx[z]), _rows(gy[z])
        both = np.sort(np.concatenate([a, b], axis=1), axis=1)
        same = np.zeros(both.shape, bool)
        same[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _NONE)
        whole = (nx[z] <= KEPT) & (ny[z] <= KEPT)
        place = np.arange(1, 2 * KEPT + 1) - np.cumsum(same, axis=1)  # of a value among the union's
        k = (same & (whole[:, None] | (place <= KEPT))).sum(axis=1)
        of = np.where(whole, np.maximum(nx[z] + ny[z] - k, 1), KEPT)
        known = known_a & known_b
        ok[z] = ~known | np.where(whole, 9 * k >= 4 * (nx[z] + ny[z]), k >= LEAST)
        far[z] = np.where(known, 1 - k / of, 1.0)
    return ok, far


def _far(nx: np.ndarray, gx: list, ny: np.ndarray, gy: list) -> tuple[np.ndarray, np.ndarray]:
    """What the signatures that follow the sketches leave, and of that, `estimated`: signatures take a fraction of the time."""
    cut = lambda n, g: (None, None) if g is None else (g[: 4 * min(n, KEPT)], g[4 * min(n, KEPT) :])
    (sx, px), (sy, py) = (zip(*(cut(n, g) for n, g in zip(ns.tolist(), gs, strict=True)), strict=True) if len(ns) else ((), ()) for ns, gs in ((nx, gx), (ny, gy)))
    ok, far = simjoin.SIGNATURES.far(nx, px, ny, py)[0], np.ones(len(nx))
    at = np.flatnonzero(ok)
    if len(at):
        ok[at], far[at] = estimated(nx[at], [sx[i] for i in at], ny[at], [sy[i] for i in at])
    return ok, far


SKETCHES = simjoin.Bounds(_may, _far)


def sketched(docs: DataFrame) -> DataFrame:
    """A written table of doc_id, n, digest of the set (null: empty), its sketch and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), pa.array([s[:KEPT].tobytes() for s in sets], pa.binary()), pa.array([simjoin.signature(s) for s in sets], pa.binary())], ["doc_id", "n", "digest", "sketch", "parity"])

    return written(map_arrow(documents(docs), run, "doc_id long, n long, digest binary, sketch binary, parity binary"), "sketches")


def _with_prefix(nodes: DataFrame) -> DataFrame:
    """node, n, prefix (the values by which it is found) and sign (the sketch's highest 32 bits, then the signature)."""
    frequent = simjoin.frequent_slots(nodes.select("node", "sketch"), _spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [_values(s) for s in b.column(2).to_pylist()]
            first = [indexed(s, n, frequent).tobytes() for s, n in zip(sets, b.column(1).to_pylist(), strict=True)]
            high = [np.minimum(s >> np.uint64(32), np.uint64(_NONE - 1)).astype("<u4").tobytes() + g for s, g in zip(sets, b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(first, pa.binary()), pa.array(high, pa.binary())], ["node", "n", "prefix", "sign"])

    return map_arrow(nodes.select("node", "n", "sketch", "parity"), run, "node long, n long, prefix binary, sign binary")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the row's id is its component's) of every row."""
    prints = sketched(docs)
    usable = prints.where("digest is not null and doc_id is not null")
    nodes = written(usable.groupBy("digest", "n").agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity")), "nodes")
    found = written(_with_prefix(nodes), "prefixes")
    lists = simjoin.index_lists(found)
    signs = written(found.groupBy("node").agg(F.when(F.count("*") == 1, F.first("sign")).alias("sign")), "signs")
    pair = ["x", "nx", "y", "ny"]
    placed = lambda links: written(simjoin.connected(links), "components")
    near = written(simjoin.leader_pairs(lists, signs.withColumn("component", F.col("node")), SKETCHES), "pairs")
    first = simjoin.verified(docs, near, shingles)
    known = placed(first.where(simjoin._LINK).select("x", "y"))
    cross = written(simjoin.cross_pairs(lists, signs.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "sign"), SKETCHES), "pairs")
    # one link joins two components, so that each set's likeliest pair comes first
    p = F.struct("far", *pair).alias("p")
    both_ways = cross.select(F.col("x").alias("s"), F.col("nx").alias("ns"), p).unionByName(cross.select(F.col("y").alias("s"), F.col("ny").alias("ns"), p))
    likeliest = written(both_ways.groupBy("s", "ns").agg(F.min("p").alias("p")).select("p.*").distinct(), "likeliest")
    second = simjoin.verified(docs, likeliest.select(pair), shingles)
    now = placed(simjoin.stars(known).unionByName(second.where(simjoin._LINK).select("x", "y")))
    left = written(simjoin.placed_in(cross.join(likeliest.select(pair), pair, "left_anti"), now).where("cx <> cy").select(pair), "pairs")
    third = simjoin.verified(docs, left, shingles)
    out = simjoin.labelled(prints, nodes, simjoin.stars(now).unionByName(third.where(simjoin._LINK).select("x", "y")))
    discard(found, lists, signs, near, first, known, cross, likeliest, second, now, left, third)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
