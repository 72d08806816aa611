"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon (words and word beginnings that mark toxic texts) is learnt from document frequencies over all labelled
training rows; every unit that passes the test for it is kept. Features: lexicon densities, nearness of lexicon words to
second-person words, capitals, punctuation and obfuscation rates. The trees are fitted in numpy on at most SAMPLE rows, taken by hash; a quarter of those is kept for the
calibration. Scores depend on nothing but the text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, written

#: Labelled rows the trees and the calibration see at most; label rows that are broadcast at most.
SAMPLE, BROADCAST_LABELS = 40_000, 2_000_000
FOLDS = 5
BEGINNINGS = (4, 5, 6)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+(?:['@$*!][0-9a-z\x80-\xff]+)*")
OBFUSCATED = re.compile(rb"[a-z][@$*!0-9]+[a-z]")
DRAWN_OUT = re.compile(rb"([a-z!?])\1\1")
SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
LOWER, UPPER = bytes(range(97, 123)), bytes(range(65, 91))
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
#: Second-person words of the corpus' languages.
SECOND = frozenset(w.encode() for w in "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti usted ustedes vos vosotros".split())


def units(words: set[bytes]) -> set[bytes]:
    """Each word after '=', each beginning of a longer word after '^'."""
    out = {b"=" + w for w in words}
    for k in BEGINNINGS:
        out.update(b"^" + w[:k] for w in words if len(w) > k)
    return out


def nearest(a: list[int], b: list[int]) -> int:
    """The smallest distance of a place of a to one of b, both rising; 999 if either is empty."""
    if not a or not b:
        return 999
    x, y = np.array(a), np.array(b)
    k = np.searchsorted(y, x)
    return int(min(np.abs(x - y[np.minimum(k, len(y) - 1)]).min(), np.abs(x - y[np.maximum(k - 1, 0)]).min()))


@dataclass
class Model:
    lexicon: dict[bytes, float] = field(default_factory=dict)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    knots: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def features(self, text: str) -> list[float]:
        raw = text.encode()
        words = WORD.findall(text.lower().encode())
        n = max(1, len(words))
        weight = self.weights(set(words))
        at = [i for i, w in enumerate(words) if w in weight] if weight else []
        seconds = [i for i, w in enumerate(words) if w in SECOND]
        near = nearest(at, seconds)
        best = sorted(weight.values(), reverse=True)
        letters = len(raw) - len(raw.translate(None, LOWER + UPPER))
        capitals = len(raw) - len(raw.translate(None, UPPER))
        marks = len(raw) - len(raw.translate(None, MARKS))
        odd = len(OBFUSCATED.findall(text.lower().encode()))
        return [np.log1p(len(words)), len(at) / n, np.log1p(len(at)), len(weight), best[0] if best else 0.0, sum(best[:3]), sum(best) / n, len(seconds) / n, 1 / (1 + near), capitals / max(1, letters), len(SHOUTED.findall(raw)) / n, marks / max(1, len(raw)), raw.count(b"!") / n, raw.count(b"?") / n, odd / n, len(DRAWN_OUT.findall(raw)) / n]

    def weights(self, words: set[bytes]) -> dict[bytes, float]:
        """The words that the lexicon has, or a beginning of, with their largest weight."""
        get, out = self.lexicon.get, {}
        for w in words:
            x = max(get(b"=" + w, 0.0), *(get(b"^" + w[:k], 0.0) for k in BEGINNINGS if len(w) > k), 0.0)
            if x > 0:
                out[w] = x
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((apply_tree(t, x) for t in self.trees), np.zeros(len(x)))

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([self.features(t) for t in texts], np.float64)
        return np.clip(np.interp(self.raw(x), *self.knots), 0.0, 1.0)


def apply_tree(tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """A complete binary tree: inner node k has the children 2k + 1 and 2k + 2."""
    feature, cut, leaf = tree
    node = np.zeros(len(x), int)
    for _ in range(int(np.log2(len(leaf)))):
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
    return leaf[node - len(feature)]


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, ridge: float = 1.0) -> tuple[float, list]:
    """Logistic gradient boosting on histograms of quantile bins."""
    p0 = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    start, trees = float(np.log(p0 / (1 - p0))), []
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    f = np.full(len(y), start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        feature, cut, node = np.zeros(2**depth - 1, int), np.full(2**depth - 1, np.inf), np.zeros(len(y), int)
        for k in range(2**depth - 1):
            own = node == k
            best = (1e-9, None)
            if own.sum() >= 10:
                gs, hs = g[own], h[own]
                total = gs.sum() ** 2 / (hs.sum() + ridge)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(binned[own, j], gs, len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[own, j], hs, len(c) + 1))[:-1]
                    gain = gl**2 / (hl + ridge) + (gs.sum() - gl) ** 2 / (hs.sum() - hl + ridge) - total
                    b = int(gain.argmax())
                    if gain[b] > best[0]:
                        best = (gain[b], (j, c[b], b))
            if best[1]:
                feature[k], cut[k] = best[1][:2]
                node[own] = 2 * k + 1 + (binned[own, best[1][0]] > best[1][2])
            else:
                node[own] = 2 * k + 1
        leaf = node - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        trees.append((feature, cut, value))
        f += value[leaf]
    return start, trees


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising function from raw scores to label rates: pooled adjacent violators, joined by straight lines."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of raw scores
    for r, v in zip(raw[order], y[order], strict=True):
        blocks.append([v, 1, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a, strict=True)]
    at = np.array([b[2] / b[1] for b in blocks])
    rate = np.array([(b[0] + 1e-3) / (b[1] + 2e-3) for b in blocks])
    # steps at the ends keep raw scores beyond them in order
    return np.concatenate([[at[0] - 5], at, [at[-1] + 5]]), np.concatenate([[rate[0] * 0.5], rate, [1 - (1 - rate[-1]) * 0.5]])


def fold(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _counted(docs: DataFrame) -> DataFrame:
    """Document frequencies of all units in toxic and in clean rows, by (unit, t, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter[bytes], Counter[bytes]] = Counter(), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for toxic, counts in enumerate(held):
                none, n = pa.array(np.zeros(len(counts), np.int64)), pa.array(counts.values(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), n if toxic else none, none if toxic else n], ["unit", "t", "c"])
                counts.clear()

        for b in batches:
            for text, toxic in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                held[toxic != 0].update(units(set(WORD.findall(text.lower().encode()))))
            if len(held[0]) + len(held[1]) > 300_000:
                yield from out()
        yield from out()

    return map_arrow(docs, run, "unit binary, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows outside the held-out fold. Without both classes, every score is the label rate."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")).where(fold(F.col("id")) != 0)
    n_labels = known.count()
    small = F.broadcast if n_labels <= BROADCAST_LABELS else (lambda x: x)
    rows = documents(docs)
    join = lambda k: rows.join(small(k), rows["doc_id"] == k["id"])
    sample = join(known).select("doc_id", "text", "toxic", F.xxhash64("doc_id").alias("h"))
    if n_labels > SAMPLE:  # twice the share that is needed, by hash, before the exact cut
        sample = sample.where(F.pmod("h", F.lit(1_000_000)) < F.lit(int(2e6 * SAMPLE / n_labels)))
    n_toxic, n_clean = (max(r, 1) for r in _class_sizes(known))
    counted = _counted(join(known).select("doc_id", "text", "toxic"))
    model = Model(lexicon=_lexicon(counted, n_toxic, n_clean))
    width = len(model.features(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array([model.features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], ["doc_id", "toxic", "h", "x"])

    got = map_arrow(sample, run, "doc_id long, toxic int, h long, x array<double>").orderBy("h", "doc_id").limit(SAMPLE).toArrow()
    y = np.asarray(got["toxic"].to_numpy(), np.float64)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        model.knots = np.array([0.0]), np.array([rate])
        return model
    x = np.array(got["x"].to_pylist(), np.float64).reshape(len(y), width)
    apart = np.array([zlib.crc32(str(i).encode()) // FOLDS % 4 == 0 for i in got["doc_id"].to_pylist()])
    if apart.sum() < 20 or len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart = np.zeros(len(y), bool)
    model.start, model.trees = boost(x[~apart], y[~apart])
    held = apart if apart.any() else ~apart
    model.knots = isotonic(model.raw(x[held]), y[held])
    return model


def _class_sizes(known: DataFrame) -> tuple[int, int]:
    r = known.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    return r["t"] or 0, r["n"] - (r["t"] or 0)


def _lexicon(counted: DataFrame, n_toxic: int, n_clean: int) -> dict[bytes, float]:
    """Units 20 times as frequent in toxic rows, beyond what chance gives among all units of toxic rows (a likelihood-ratio
    test of the unit's toxic rows against the share of toxic rows)."""
    units = written(counted.where("t > 0"), "units")
    tests, p, t, c = max(1, units.count()), n_toxic / (n_toxic + n_clean), F.col("t"), F.col("c")
    weight = F.ln((t + 0.5) / (n_toxic + 1)) - F.ln((c + 0.5) / (n_clean + 1))
    ratio = t * F.ln(t / ((t + c) * p)) + F.when(c > 0, c * F.ln(c / ((t + c) * (1 - p)))).otherwise(0.0)
    found = units.select("unit", weight.alias("w")).where((weight >= float(np.log(20))) & (ratio >= float(np.log(tests) + 2)))
    return {bytes(r["unit"]): r["w"] for r in found.collect()}


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; the columns of docs are not carried.

    Null and empty texts get the score of their (zero) features; a null id counts as the empty text for its fold;
    repeated rows get equal scores; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    s = map_arrow(documents(docs), run, "doc_id long, score double")
    return s.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rejected_away(docs: DataFrame, model: Model) -> DataFrame:
    """docs, all columns, without the rows whose text is predicted to be toxic."""
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score([t or "" for t in b.column(at).to_pylist()]) < 0.5))

    return map_arrow(docs, run, schema)
