"""k-means in exact integers, by filtering partition-local ball trees.

Vectors of `dim` components, none null or non-finite, become integers floor(scale * x). Centroids 0, 1, ... start as the k
vectors whose sha256 of "<seed>:<key>" is smallest. Each round assigns every vector to its nearest centroid (squared
Euclidean distance, ties to the smaller number); each centroid that has vectors becomes their floor(sum / count).

1. Each task puts its vectors into trees of TREE vectors at most. A node (ball) has the count, the integer sum and the radius of
   its vectors about their mean. Trees are rows of a table in the shared folder, made once.
2. In a round the triangle inequality gives a whole ball to one centroid where all others are farther from all of the ball,
   beyond any rounding; count and sum are those of the node. Else its two parts are looked at, and in leaves the vectors, in
   exact integers.
3. Sums of tasks are added in two steps; k sums reach the driver.

Vectors with components beyond LIMIT are no part of balls: they, and all vectors while a centroid is that large, are compared
in Python's integers. A distance, or a sum of distances, beyond a long is null. Null keys come last among the starting
vectors, equal keys in the order of their vectors. Fewer vectors than k start as many centroids; none give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, written

#: Vectors of a tree and of a leaf; parts in which tasks' sums are added first.
TREE, LEAF, PARTS = 4096, 16, 32
#: Up to this size of all components, products and squared distances are exact in doubles (64 components: below 2^53).
LIMIT = 1 << 22
_LONG = (1 << 63) - 1


def whole_vectors(df: DataFrame, key: str, vector: str, dim: int, scale: int) -> DataFrame:
    """key (long) and x, the integer components as doubles (which hold them exactly), of the vectors that take part."""
    x = F.col(vector)
    fine = F.coalesce(F.size(x) == dim, F.lit(False)) & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))), F.lit(False))
    return df.where(fine).select(F.col(key).cast("long").alias("key"), F.transform(x, lambda v: v.cast("double") * F.lit(float(scale))).alias("x"))


def build(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of the vectors; of each node, its first vector, the one after its last, and its left and right child (-1: none);
    sums; radii. Node 0 is the root. A ball is cut between the vector farthest from its mean and the one farthest from that."""
    order, nodes, sums, radii = np.arange(len(x)), [[0, len(x), -1, -1]], [], []
    at = 0
    while at < len(nodes):
        s, e = nodes[at][:2]
        own = x[order[s:e]]
        total = own.sum(axis=0)
        far = np.sqrt(((own - total / (e - s)) ** 2).sum(axis=1))
        sums.append(total)
        radii.append(far.max())
        if e - s > LEAF and radii[-1] > 0:
            a = own[far.argmax()]
            to_a = ((own - a) ** 2).sum(axis=1)
            right = ((own - own[to_a.argmax()]) ** 2).sum(axis=1) < to_a
            k = e - s - int(right.sum())
            if 0 < k < e - s:
                order[s:e] = np.concatenate([order[s:e][~right], order[s:e][right]])
                nodes[at][2:] = [len(nodes), len(nodes) + 1]
                nodes += [[s, s + k, -1, -1], [s + k, e, -1, -1]]
        at += 1
    return order, np.array(nodes, np.int32), np.array(sums), np.array(radii)


def trees(vectors: DataFrame, dim: int) -> DataFrame:
    """A table of trees: keys and points in tree order, nodes, sums and radii; large vectors in rows without nodes."""

    def pack(keys: list, x: np.ndarray, plain: bool) -> pa.RecordBatch:
        if plain:
            order, nodes, sums, radii = build(x)
            keys, x = [keys[i] for i in order], x[order].astype("<i4")
            more = [nodes.astype("<i4").tobytes(), sums.astype("<i8").tobytes(), radii.tobytes()]
        else:
            more = [None, None, None]
        return pa.RecordBatch.from_arrays([pa.array([keys], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()), *(pa.array([m], pa.binary()) for m in more)], ["keys", "points", "nodes", "sums", "radii"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list] = {True: [[], []], False: [[], []]}
        for b in batches:
            x = np.floor(np.array(b.column(1).to_pylist(), np.float64).reshape(-1, dim))
            keys, small = b.column(0).to_pylist(), (np.abs(x) <= LIMIT).all(axis=1)
            for plain, h in held.items():
                own = np.flatnonzero(small == plain)
                h[0] += [keys[i] for i in own]
                h[1].append(x[own])
                while len(h[0]) >= TREE:
                    every = np.concatenate(h[1])
                    yield pack(h[0][:TREE], every[:TREE], plain)
                    h[0], h[1] = h[0][TREE:], [every[TREE:]]
        for plain, h in held.items():
            if h[0]:
                yield pack(h[0], np.concatenate(h[1]), plain)

    return written(map_arrow(vectors, run, "keys array<long>, points binary, nodes binary, sums binary, radii binary", rows=TREE), "trees")


def _exact(x: np.ndarray, z: list[list[int]]) -> tuple[np.ndarray, list[int]]:
    """Nearest centroid and squared distance of each vector, in Python's integers."""
    near, far = [], []
    for v in x:
        row = [int(c) for c in v]
        d = [sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in z]
        far.append(min(d))
        near.append(d.index(far[-1]))
    return np.array(near, np.int64), far


def _nearest(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Of vectors within LIMIT; argmin takes the smaller number of a tie."""
    return ((z**2).sum(axis=1) - 2 * (x @ z.T)).argmin(axis=1)


def filtered(x: np.ndarray, nodes: np.ndarray, sums: np.ndarray, radii: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Runs of vectors that go to one centroid: (first, after the last, centroid, node or -1)."""
    middle = sums / (nodes[:, 1] - nodes[:, 0])[:, None]
    front = np.zeros(1, np.int64)
    while len(front):
        d = np.sqrt(((middle[front][:, None, :] - z[None]) ** 2).sum(axis=2))
        best = d.argmin(axis=1)
        line = np.arange(len(front))
        nearest = d[line, best]
        d[line, best] = np.inf
        r = radii[front]
        whole = nearest + 2 * r + 1e-6 * (1 + nearest + r) < d.min(axis=1)
        for i, c in zip(front[whole].tolist(), best[whole].tolist(), strict=True):
            yield int(nodes[i, 0]), int(nodes[i, 1]), c, i
        left = front[~whole]
        leaf = nodes[left, 2] < 0
        for i in left[leaf].tolist():
            s, e = int(nodes[i, 0]), int(nodes[i, 1])
            near = _nearest(x[s:e], z)
            cut = np.flatnonzero(np.append(True, near[1:] != near[:-1]))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), e - s], strict=True):
                yield s + a, s + b, int(near[a]), -1
        front = nodes[left[~leaf], 2:].ravel().astype(np.int64)


def _read(points: bytes, nodes: bytes | None, sums: bytes | None, radii: bytes | None, dim: int) -> tuple:
    x = np.frombuffer(points, "<f8" if nodes is None else "<i4").reshape(-1, dim)
    if nodes is None:
        return x, None, None, None
    return x.astype(np.float64), np.frombuffer(nodes, "<i4").reshape(-1, 4), np.frombuffer(sums, "<i8").reshape(-1, dim), np.frombuffer(radii, np.float64)


def _totals(table: DataFrame, z: list[list[int]], dim: int) -> list[tuple[int, list[int]]]:
    """Count and sum of the vectors nearest to each centroid."""
    small = all(abs(c) <= LIMIT for row in z for c in row)
    zs = np.array(z, np.float64) if small else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = [0] * len(z), [[0] * dim for _ in z]
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, nodes, sums, radii = _read(*row, dim)
                k, part = np.zeros(len(z), np.int64), np.zeros((len(z), dim), np.int64)
                if small and nodes is not None:
                    for s, e, c, i in filtered(x, nodes, sums, radii, zs):
                        k[c] += e - s
                        part[c] += sums[i] if i >= 0 else x[s:e].sum(axis=0).astype(np.int64)
                    parts = part.tolist()
                else:
                    near, _ = _exact(x, z)
                    k, parts = np.bincount(near, minlength=len(z)), [[sum(int(v) for v in x[near == c, j]) for j in range(dim)] for c in range(len(z))]
                n = [a + int(d) for a, d in zip(n, k, strict=True)]
                total = [[a + d for a, d in zip(t, p, strict=True)] for t, p in zip(total, parts, strict=True)]
        yield pa.RecordBatch.from_pydict({"c": pa.array(range(len(z)), pa.int32()), "n": pa.array(n, pa.int64()), "total": pa.array([",".join(map(str, t)) for t in total], pa.string())})

    def added(rows: list[tuple[int, int, str]]) -> tuple[int, list[int]]:
        return sum(r[1] for r in rows), [sum(c) for c in zip(*([int(v) for v in r[2].split(",")] for r in rows), strict=True)]

    def add(t: pa.Table) -> pa.Table:
        n, total = added(list(zip(t["c"].to_pylist(), t["n"].to_pylist(), t["total"].to_pylist(), strict=True)))
        return pa.table({"c": t["c"][:1].combine_chunks(), "n": pa.array([n], pa.int64()), "total": pa.array([",".join(map(str, total))], pa.string())})

    sums = map_arrow(table.select("points", "nodes", "sums", "radii"), run, "c int, n long, total string", rows=4)
    sums = sums.groupBy("c", F.pmod(F.xxhash64("total"), F.lit(PARTS)).alias("part")).applyInArrow(add, "c int, n long, total string")
    rows = sums.collect()  # PARTS rows a centroid at most
    return [added(own) if (own := [r for r in rows if r["c"] == c]) else (0, [0] * dim) for c in range(len(z))]


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 (of its components as decimals joined by ',')."""
    spark = df.sparkSession
    vectors = whole_vectors(df, key, vector, dim, scale)
    first = vectors.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)), "x").limit(k).collect()
    z = [[math.floor(v) for v in r["x"]] for r in first]
    table = trees(vectors, dim)
    if z:
        for _ in range(rounds):
            after = [[s // n for s in total] if n else old for old, (n, total) in zip(z, _totals(table, z, dim), strict=True)]
            if after == z:  # so are all later rounds
                break
            z = after
    small = all(abs(c) <= LIMIT for row in z for c in row)
    zs = np.array(z, np.float64).reshape(-1, dim) if small else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, nodes, sums, radii = _read(*row, dim)
                if small and nodes is not None:
                    near = np.zeros(len(x), np.int64)
                    for s, e, c, _ in filtered(x, nodes, sums, radii, zs):
                        near[s:e] = c
                    far = ((x - zs[near]) ** 2).sum(axis=1).astype(np.int64).tolist()
                else:
                    near, far = _exact(x, z)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(near, pa.int32()), pa.array([d if d <= _LONG else None for d in far], pa.int64())], [key, "cluster", "distance"])

    out = written(map_arrow(table, assign, f"`{key}` long, cluster int, distance long", rows=4), "clusters")
    discard(table)
    found = {r["cluster"]: r["d"] for r in out.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("d")).collect()}  # k rows
    fits = lambda d: int(d) if d is not None and d <= _LONG else None
    total = None if None in found.values() else fits(sum(found.values()))
    of = [(c, fits(d), total, hashlib.sha256(",".join(map(str, z[c])).encode()).hexdigest()) for c, d in found.items()]
    return out.join(F.broadcast(spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
