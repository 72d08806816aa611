"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals.

Centroids and codebooks are fitted on at most SAMPLE vectors, taken by hash; every vector is indexed. There are about as many
lists as the square root of the vectors. Lists are put together into cells of CELL vectors or so, each a task's work, and
longer lists are dealt over several cells by hash. How many lists a query probes is found on the sample: as few as give the
recall that is asked for there (vectors without clusters need more than half of the lists; clustered ones few). In each cell
that has some of its lists, asymmetric distance tables over all of them pick the query's RERANK best, whose inner products are
computed exactly, in double precision, on the original vectors; so are those of all others that the tables' error, as seen on
these, leaves room for. A recall of 1 probes all lists and computes all products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written

SAMPLE, PARTS, CODES, CELL, RERANK, TOP = 20_000, 16, 256, 16_384, 256, 20
#: Lists at most; the recall that the number of probed lists gives on the sample; its queries for that; queries scored together.
MOST_LISTS, RECALL, TRIALS, BLOCK = 1024, 0.97, 256, 64


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part: no null or non-finite component, not all zero, and of the most
    frequent length (the longer of equally frequent ones)."""
    e = F.col("embedding")
    ok = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & e.isNotNull() & ok)
    most = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (most["d"] if most else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    r = np.random.default_rng(seed)
    c = x[r.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        s = np.stack([np.bincount(near, v, len(c)) for v in x.T], 1)
        c[n > 0] = s[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[r.integers(0, len(x), int((n == 0).sum()))]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((half - x[i : i + 4096] @ c.T).argmin(axis=1) for i in range(0, len(x), 4096))])


class Quantiser:
    """Coarse centroids, and one codebook for each of PARTS slices of a residual."""

    def __init__(self, sample: np.ndarray, lists: int):
        distinct = np.unique(sample, axis=0)  # copies would draw centroids onto themselves
        self.coarse = kmeans(distinct, min(lists, len(distinct)))
        rest = distinct - self.coarse[nearest(distinct, self.coarse)]
        self.slices = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        self.books = [kmeans(rest[:, s], min(CODES, len(rest))) for s in self.slices]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which = nearest(x, self.coarse)
        rest = x - self.coarse[which]
        return which, np.stack([nearest(rest[:, s], b) for s, b in zip(self.slices, self.books, strict=True)], 1).astype(np.uint8)

    def probed(self, q: np.ndarray, probes: int) -> np.ndarray:
        """The lists of each query, by the inner product with their centroids."""
        return np.argsort(-(q @ self.coarse.T), axis=1, kind="stable")[:, :probes]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of queries with the codes of each slice."""
        return np.stack([np.pad((q[:, s] @ b.T).astype(np.float32), ((0, 0), (0, CODES - len(b)))) for s, b in zip(self.slices, self.books, strict=True)], 1)

    def approximate(self, q: np.ndarray, which: int, codes: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Inner products of queries with coded vectors of one list."""
        out = np.repeat((q @ self.coarse[which]).astype(np.float32)[:, None], len(codes), axis=1)
        for j in range(codes.shape[1]):
            out += tables[:, j][:, codes[:, j]]
        return out

    def probes_for(self, sample: np.ndarray, recall: float, top: int) -> int:
        """As few lists as hold that share of the `top` best of some of the sample's vectors among the sample."""
        k = len(self.coarse)
        sample = np.unique(sample, axis=0)  # copies find each other in one list, and would make the rest look easy
        if recall >= 1 or len(sample) <= top:
            return k
        q = sample[:: max(1, len(sample) // TRIALS)][:TRIALS]
        which, place = nearest(sample, self.coarse), np.argsort(self.probed(q, k), axis=1)
        found = np.zeros(k)
        for i in range(len(q)):
            score = sample @ q[i]
            best = np.argsort(-score, kind="stable")[1 : top + 1]  # the first is the vector itself, or its copy
            found += np.bincount(place[i, which[best]], minlength=k)
        return int(np.searchsorted(np.cumsum(found) / found.sum(), recall)) + 1


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def cells_of(counts: dict[int, int], lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each list, its first cell and how many it has. Short lists share cells, in order, up to CELL vectors."""
    first, many, cell, held = np.zeros(lists, np.int64), np.ones(lists, np.int64), 0, 0
    for k in range(lists):
        n = counts.get(k, 0)
        if held and held + n > CELL:
            cell, held = cell + 1, 0
        first[k], many[k] = cell, max(1, -(-n // CELL))
        held += n
        if many[k] > 1:
            cell, held = cell + int(many[k]), 0
    return first, many


def needed(ids: np.ndarray, xs: np.ndarray, top: int) -> np.ndarray:
    """Places of all rows but those that can be in no answer: copies of a vector beyond its top + 1 smallest ids, as equal scores
    rank by id. So a vector with very many copies doesn't fill the shortlists."""
    _, of = np.unique(np.ascontiguousarray(xs).view(np.dtype((np.void, xs.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((ids, of))
    g, i = of[order], ids[order]
    new = np.append(True, (g[1:] != g[:-1]) | (i[1:] != i[:-1]))  # rows of one id and vector are one
    order, g = order[new], g[new]
    first = np.append(True, g[1:] != g[:-1])
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    return np.sort(order[rank <= top])


def search(vectors: DataFrame, every: int = 20, top: int = TOP, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score for the rows whose id is divisible by `every`, against all other ids.

    Rows that don't take part (see usable()) are neither queries nor candidates. Equal scores rank by smaller id. Rows with a
    query's id aren't its candidates. Of rows that share a query's id, the one with the smallest vector (as a list) asks; of
    candidates that share an id, the one with the best score counts. Without candidates a query has no rows. With a recall
    of 1 the result is exact.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    n_rows = rows.count()
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE).select("embedding").toArrow()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not got.num_rows:
        return empty
    sample = _matrix(got["embedding"].combine_chunks())
    quantiser = Quantiser(sample, min(MOST_LISTS, max(1, int(np.sqrt(n_rows)))))
    n_lists = len(quantiser.coarse)
    probes = quantiser.probes_for(sample, recall, top)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                which, codes = quantiser.encode(_matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(which.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], ["vec_id", "embedding", "list", "codes"])

    indexed = written(map_arrow(rows, index, "vec_id long, embedding array<double>, list int, codes binary"), "index")
    first, many = cells_of({r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}, n_lists)  # MOST_LISTS rows at most
    n_cells = int((first + many).max())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            near = quantiser.probed(_matrix(b.column(1)), probes)
            to = [np.unique(np.concatenate([first[w], *(first[k] + np.arange(1, many[k]) for k in w[many[w] > 1])])) for w in near]
            pick = pa.array(np.repeat(np.arange(b.num_rows), [len(t) for t in to]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to).astype(np.int32)), b.column(0).take(pick), b.column(1).take(pick)], ["cell", "id", "embedding"])

    at = lambda x: F.element_at(F.array(*[F.lit(int(v)) for v in x]), F.col("list") + 1)
    deal = at(first) + F.pmod(F.xxhash64("vec_id"), at(many).cast("long")).cast("int")
    placed = indexed.select(deal.cast("int").alias("cell"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "embedding", "codes", "list")
    asked = indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = map_arrow(asked, probe, "cell int, id long, embedding array<double>", rows=200).select("cell", F.lit(1).alias("kind"), "id", "embedding", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("int").alias("list"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_cells)
    together = placed.unionByName(asked).repartition(n, "cell").sortWithinPartitions("cell", "kind", "list", "id", "embedding")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, joined, parts = None, False, ([], [], [], [])  # ids, vectors, codes and lists of the cell, in order of the lists
        for b in batches:
            at, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1
            for s, e in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if e <= s:
                    continue
                if at[s] != cell:
                    cell, joined, parts = at[s], False, ([], [], [], [])
                own, x = b.column(2)[s:e].to_numpy(), _matrix(b.column(3)[s:e])
                if kind[s] == 0:
                    for part, v in zip(parts, (own, x, np.frombuffer(b"".join(b.column(4)[s:e].to_pylist()), np.uint8).reshape(e - s, -1), b.column(5)[s:e].to_numpy()), strict=True):
                        part.append(v)
                elif parts[0]:
                    if not joined:
                        joined = True
                        ids, xs, codes, lists = (np.concatenate(v) for v in parts)
                        few = needed(ids, xs, top)
                        parts = tuple([v[few]] for v in (ids, xs, codes, lists))
                    for i in range(0, e - s, BLOCK):
                        yield _best(quantiser, own[i : i + BLOCK], x[i : i + BLOCK], *(v[0] for v in parts), probes, top, len(parts[0][0]) if recall >= 1 else RERANK)

    found = map_arrow(together, look, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _best(quantiser: Quantiser, own: np.ndarray, q: np.ndarray, ids: np.ndarray, xs: np.ndarray, codes: np.ndarray, lists: np.ndarray, probes: int, top: int, shortlist: int) -> pa.RecordBatch:
    """The best of one cell for each query: by tables over the lists that it probes, then exactly."""
    near = np.full((len(q), len(ids)), -np.inf, np.float32)
    probed = np.zeros((len(q), len(quantiser.coarse)), bool)
    np.put_along_axis(probed, quantiser.probed(q, probes), True, axis=1)
    tables = quantiser.tables(q)
    edges = np.flatnonzero(lists[1:] != lists[:-1]) + 1
    for s, e in zip([0, *edges], [*edges, len(ids)], strict=True):
        ask = np.flatnonzero(probed[:, lists[s]])
        if len(ask):
            near[ask, s:e] = quantiser.approximate(q[ask], lists[s], codes[s:e], tables[ask])
    near[own[:, None] == ids[None, :]] = -np.inf
    out: list[list[np.ndarray]] = [[], [], []]
    for i, query in enumerate(q):
        pick = np.flatnonzero(near[i] > -np.inf)
        if len(pick) > shortlist:
            least = np.partition(near[i], -shortlist)[-shortlist]
            over = np.flatnonzero(near[i] > least)  # of equal ones, such as copies of a vector, the smaller ids
            pick = np.concatenate([over, np.flatnonzero(near[i] == least)[: shortlist - len(over)]])
        score = (xs[pick] * query).sum(axis=1)
        if len(pick) > top and len(pick) == shortlist:  # by how far tables are off here, others may be as good: near copies, say
            off = np.quantile(np.abs(score - near[i, pick]), 0.95)
            again = near[i] >= np.partition(score, -top)[-top] - off
            again[pick] = False
            again = np.flatnonzero(again)
            pick, score = np.concatenate([pick, again]), np.concatenate([score, (xs[again] * query).sum(axis=1)])
        order = np.lexsort((ids[pick], -score))
        order = order[np.sort(np.unique(ids[pick][order], return_index=True)[1])][:top]  # an id's best alone
        for column, v in zip(out, (np.full(len(order), own[i]), ids[pick][order], score[order]), strict=True):
            column.append(v)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])
