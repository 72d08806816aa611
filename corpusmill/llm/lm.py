"""Language-model scores: an add-one unigram score, and a causal self-attention model in numpy.

Counts cover all training documents. Words that a bounded table of frequent words doesn't have are counted and scored by a
shuffle join on 64-bit word hashes, so that no vocabulary is held by a task or the driver.

The model reads subword ids: each word, with a space before it, is split by longest match over the single bytes and the pieces
of a byte-level tokenizer file that are most frequent in the training texts, CLASSES * MEMBERS in all with the end. Pieces are put
in the order of their bytes and cut into classes; a piece's probability is that of its class, times its own in the class, both
softmax layers over what one layer of causal attention and a hidden layer make of the ids before it. So every piece has a
probability of its own in each context. Windows overlap; each id is scored once, in the first window that has it among its
last STRIDE places (or in a text's first window).
The network's weights start from a fit on the driver to windows drawn from all places of all training texts. Then workers on the
executors train on every id of every training text, in rounds between which what they learnt is averaged.
"""

from __future__ import annotations

import json
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from copy import copy
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import discard, documents, map_arrow, written

FOLDS, HELD_OUT = 7, 2
FREQUENT_WORDS, STEPS, BATCH = 100_000, 900, 96
#: The pass over all training texts: windows of a step, the rate that falls from round to round, ids that wait for steps at least, ids of a slice of the sums.
PASS_BATCH, PASS_RATE, PASS_IDS, SLICE = 256, 0.001, 60_000, 256
#: The rounds of that pass, the words of a worker, the most workers of a round, and how much of a round's move the next one adds.
ROUNDS, WORKER_WORDS, WORKERS, MOMENTUM = 4, 200_000, 1024, 0.3
CLASSES, MEMBERS, WIDTH, HIDDEN, WINDOW, STRIDE = 32, 32, 24, 48, 24, 16
#: Windows that go through the network together, and places of a sum of products.
CHUNK, PART = 32, 384
CACHE_WORDS = 200_000


def fold(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def file_tokens(path: str) -> list[bytes]:
    """The tokens of a byte-level tokenizer file, as bytes."""
    vocab = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
    byte = {c: b for b, c in enumerate(byte_symbols())}
    return [bytes(byte[c] for c in t) for t in vocab]


class Subwords:
    """Ids of lower-cased words, a space before each, by longest match over pieces, which are numbered in the order of their bytes.

    All single bytes are pieces. The id of the end is the number of pieces.
    """

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces = sorted({*pieces, *(bytes([b]) for b in range(256))})
        self.end = len(self.pieces)
        self.root: dict = {}
        for i, t in enumerate(self.pieces):
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[-1] = i
        self.words: dict[bytes, bytes] = {}

    def word(self, word: bytes) -> bytes:
        w, root, out, i = b" " + word, self.root, [], 0
        n = len(w)
        while i < n:
            node, j = root, i
            while j < n and (node := node.get(w[j])) is not None:
                j += 1
                if -1 in node:
                    last, end = node[-1], j
            out.append(last)
            i = end
        return array("i", out).tobytes()

    def __call__(self, words: list[bytes], keep=None) -> np.ndarray:
        """Ids of the words in order. Words in `keep` (all, if it is None) stay in the cache."""
        known, spell = self.words, self.word
        if len(known) > CACHE_WORDS:
            known.clear()
        parts = [known.get(w) for w in words]
        for k, x in enumerate(parts):
            if x is None:
                w = words[k]
                parts[k] = spell(w)
                if keep is None or w in keep:
                    known[w] = parts[k]
        return np.frombuffer(b"".join(parts), "<i4")


@lru_cache(maxsize=4)
def subwords(pieces: tuple[bytes, ...]) -> Subwords:
    return Subwords(pieces)


def dense(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product of matrices."""
    return (np.ascontiguousarray(x).reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[1])


ROOM: dict = {}


def room(name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
    """An array of any content, in memory that the next call with this name takes again, so that steps don't ask the system for pages."""
    size = int(np.prod(shape))
    held = ROOM.get((name, dtype))
    if held is None or len(held) < size:
        held = ROOM[name, dtype] = np.empty(size, dtype)
    return held[:size].reshape(shape)


def by_class(kind: np.ndarray) -> list[tuple[int, slice]]:
    """The classes that places have, each with its rows when places are in the order of their classes."""
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
    return [(i, slice(lo, hi)) for i, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if hi > lo]


class Attention:
    """One layer of causal self-attention and a hidden layer, then classes of ids and their members, for the next id.

    forward(), members() and log_probabilities() are the plain form, which tests hold gradient() and score() against.
    """

    def __init__(self, counts: np.ndarray, seed: int = 3):
        n = len(counts)
        size = CLASSES * MEMBERS
        total = np.zeros(size)
        total[:n] = counts + 1.0
        total = total.reshape(CLASSES, MEMBERS)
        r = np.random.default_rng(seed)
        w = lambda *s: (r.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        log = lambda x: np.log(np.maximum(x, 1e-9)).astype(np.float32)
        of = np.maximum(total.sum(1, keepdims=True), 1e-9)
        self.p = {"e": w(size, WIDTH) * np.float32(np.sqrt(size) * 0.1), "pos": w(WINDOW, WIDTH) * np.float32(0.3), "q": w(WIDTH, WIDTH), "k": w(WIDTH, WIDTH), "v": w(WIDTH, WIDTH), "o": w(WIDTH, WIDTH), "w1": w(WIDTH, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "w2": w(HIDDEN, CLASSES) * np.float32(0.3), "b2": log(total.sum(1) / total.sum()), "u": w(CLASSES, HIDDEN, MEMBERS) * np.float32(0.3), "ub": log(total / of)}
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)

    def forward(self, ids: np.ndarray, first: int = 0) -> tuple:
        """Log class probabilities after each place from `first` on of each row of ids (rows of WINDOW), and what led to them."""
        p = self.p
        x = p["e"][ids]
        x += p["pos"]
        xs = x[:, first:] if first else x
        q, k, v = dense(xs, p["q"] * np.float32(WIDTH**-0.5)), dense(x, p["k"]), dense(x, p["v"])
        a = q @ k.transpose(0, 2, 1)
        a += self.mask[first:]
        np.exp(np.minimum(a, 60, out=a), out=a)
        a *= 1 / a.sum(axis=2, keepdims=True)
        c = a @ v
        h = dense(c, p["o"])
        h += xs
        z = dense(h, p["w1"])
        z += p["b1"]
        np.maximum(z, 0, out=z)
        y = dense(z, p["w2"])
        y += p["b2"]
        np.minimum(y, 60, out=y)
        y -= np.log(np.exp(y).sum(axis=2, keepdims=True))
        return y, (x, q, k, v, a, c, h, z)

    def members(self, z: np.ndarray, goal: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each class that goals have: the class, the rows of z whose goal is in it, and the log probabilities of its members.
        A goal below 0 is none."""
        kind = np.where(goal < 0, CLASSES, goal // MEMBERS).astype(np.int16)
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=CLASSES))
        for c in range(CLASSES):
            rows = order[ends[c - 1] if c else 0 : ends[c]]
            if len(rows):
                t = z[rows] @ self.p["u"][c]
                t += self.p["ub"][c]
                np.minimum(t, 60, out=t)
                t -= np.log(np.exp(t).sum(axis=1, keepdims=True))
                yield c, rows, t

    def log_probabilities(self, y: np.ndarray, z: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Of goals (one axis; below 0: none, 0), natural logarithms; y and z are rows of class log probabilities and of the hidden
        layer."""
        out = np.where(goal < 0, 0, y[np.arange(len(goal)), np.maximum(goal, 0) // MEMBERS])
        for _, rows, t in self.members(z, goal):
            out[rows] += t[np.arange(len(rows)), goal[rows] % MEMBERS]
        return out

    def heads(self) -> np.ndarray:
        """For each class, the weights from the hidden layer and a one to the classes and to the class's own members."""
        p = self.p
        out = np.empty((CLASSES, HIDDEN + 1, CLASSES + MEMBERS), p["u"].dtype)
        out[:, :HIDDEN, :CLASSES], out[:, HIDDEN, :CLASSES], out[:, :HIDDEN, CLASSES:], out[:, HIDDEN, CLASSES:] = p["w2"], p["b2"], p["u"], p["ub"]
        return out

    def gradient(self, ids: np.ndarray, goal: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """The mean negative log probability of the next ids (goal) of rows of WINDOW ids, its gradient by weights, and the ids
        that the rows of the embedding's gradient belong to.

        As forward() and members() have it, in fewer products: a column of ones brings biases and sums, o and w1 are one matrix, and
        places in the order of their goals' classes get classes and members by one product a class.
        """
        p, n, size, d = self.p, len(ids), ids.size, WIDTH
        t = p["e"].dtype
        scale, share, one = t.type(d**-0.5), t.type(1 / size), np.ones(CLASSES, t)
        qkv = np.concatenate([p["q"] * scale, p["k"], p["v"]], 1)
        both = np.zeros((2 * d + 1, HIDDEN + 1), t)
        both[:d, :-1], both[d:-1, :-1], both[-1, :-1], both[-1, -1] = p["o"] @ p["w1"], p["w1"], p["b1"], 1
        cap = np.where(self.mask < 0, self.mask, t.type(60))
        x, a, s, c, z = (room(name, (n, WINDOW, k), t) for name, k in (("x", 3 * d + 1), ("a", WINDOW), ("s", 1), ("c", 2 * d + 1), ("z", HIDDEN + 1)))
        x[..., -1] = c[..., -1] = 1
        chunks = [slice(i, i + CHUNK) for i in range(0, n, CHUNK)]
        rows = lambda m: m.reshape(-1, m.shape[-1])
        for k in chunks:
            own = np.take(p["e"], ids[k], axis=0)
            own += p["pos"]
            c[k, :, d:-1] = own
            np.matmul(rows(own), qkv, out=rows(x[k])[:, :-1])
            np.matmul(x[k, :, :d], x[k, :, d : 2 * d].transpose(0, 2, 1), out=a[k])
            np.minimum(a[k], cap, out=a[k])
            np.exp(a[k], out=a[k])
            got = a[k] @ x[k, :, 2 * d :]
            np.divide(1, got[..., -1:], out=s[k])
            np.multiply(got[..., :-1], s[k], out=c[k, :, :d])
            np.matmul(rows(c[k]), both, out=rows(z[k]))
            np.maximum(z[k], 0, out=z[k])
        goal = goal.ravel()
        kind = (goal // MEMBERS).astype(np.int16)
        order, spans = np.argsort(kind, kind="stable"), by_class(kind)
        heads, g = self.heads(), goal[order]
        turned = np.ascontiguousarray(heads[:, :-1].transpose(0, 2, 1))
        zs, y, dz = (room(name, (size, k), t) for name, k in (("zs", HIDDEN + 1), ("y", CLASSES + MEMBERS), ("dz", HIDDEN)))
        np.take(rows(z), order, axis=0, out=zs, mode="clip")
        for i, k in spans:
            np.matmul(zs[k], heads[i], out=y[k])
        if y.max() > 60:
            np.minimum(y, 60, out=y)
        at, flat = np.arange(size) * (CLASSES + MEMBERS), y.reshape(-1)
        at = np.concatenate([at + g // MEMBERS, at + CLASSES + g % MEMBERS])
        loss = -float(np.take(flat, at).sum())
        np.exp(y, out=y)
        total = y.reshape(-1, CLASSES) @ one
        loss += float(np.log(total).sum())
        y2 = y.reshape(-1, CLASSES)
        y2 *= (share / total)[:, None]
        flat[at] -= share
        dw = np.zeros((CLASSES, HIDDEN + 1, CLASSES + MEMBERS), t)
        for i, k in spans:
            np.matmul(zs[k].T, y[k], out=dw[i])
            np.matmul(y[k], turned[i], out=dz[k])
        dz *= np.greater(zs[:, :-1], 0, out=room("on", dz.shape, np.dtype(bool)))
        back = np.empty(size, np.int64)
        back[order] = np.arange(size)
        dz = np.take(dz, back, axis=0, out=room("back", dz.shape, t), mode="clip")
        db, dqkv, dx = np.zeros((2 * d + 1, HIDDEN), t), np.zeros((d, 3 * d), t), room("dx", (n, WINDOW, d), t)
        down, up = np.ascontiguousarray(both[:-1, :-1].T), np.ascontiguousarray(qkv.T)
        for k in chunks:
            own = dz[k.start * WINDOW : k.stop * WINDOW]
            dc = (own @ down).reshape(-1, WINDOW, 2 * d)
            to = room("to", (len(dc), WINDOW, d + 1), t)
            np.multiply(dc[..., :d], s[k], out=to[..., :-1])
            np.negative(np.einsum("bwd,bwd->bw", to[..., :-1], c[k, :, :d]), out=to[..., -1])
            da = to @ x[k, :, 2 * d :].transpose(0, 2, 1)
            da *= a[k]
            m = room("m", (len(dc), WINDOW, 3 * d), t)
            np.matmul(da, x[k, :, d : 2 * d], out=m[..., :d])
            np.matmul(da.transpose(0, 2, 1), x[k, :, :d], out=m[..., d : 2 * d])
            np.matmul(a[k].transpose(0, 2, 1), to[..., :-1], out=m[..., 2 * d :])
            m, cx = rows(m), rows(c[k])
            for i in range(0, len(m), PART):
                db += cx[i : i + PART].T @ own[i : i + PART]
                dqkv += cx[i : i + PART, d:-1].T @ m[i : i + PART]
            np.matmul(m, up, out=rows(dx[k]))
            dx[k] += dc[..., d:]
        count = np.bincount(ids.ravel(), minlength=len(p["e"]))
        own = np.flatnonzero(count)
        de = np.bincount((ids.reshape(-1, 1) * d + np.arange(d)).ravel(), dx.ravel(), len(p["e"]) * d).reshape(-1, d)[own].astype(t)
        d2 = dw[..., :CLASSES].sum(0)
        g = {"e": de, "pos": dx.sum(0), "q": dqkv[:, :d] * scale, "k": dqkv[:, d : 2 * d], "v": dqkv[:, 2 * d :], "o": db[:d] @ p["w1"].T, "w1": p["o"].T @ db[:d] + db[d:-1], "b1": db[-1], "w2": d2[:-1], "b2": d2[-1], "u": dw[:, :-1, CLASSES:], "ub": dw[:, -1, CLASSES:]}
        return loss / size, g, own

    def step(self, ids: np.ndarray, goal: np.ndarray, rate: float, held: dict) -> None:
        """One step of Adam towards the next ids (goal) of rows of WINDOW ids; held keeps the moments between steps.

        Of the embedding, only the rows of the ids are moved.
        """
        p = self.p
        _, g, own = self.gradient(ids, goal)
        n = held["n"] = held.get("n", 0) + 1
        for name, d in g.items():
            w = p[name]
            m1, m2 = held.setdefault(name, (np.zeros_like(w), np.zeros_like(w)))
            if rows := name == "e" and len(own) < len(w):
                (all1, m1), (all2, m2) = (m1, m1[own]), (m2, m2[own])
            by = room("by", d.shape, w.dtype)
            m1 *= 0.9
            m1 += np.multiply(d, 0.1, out=by)
            m2 *= 0.99
            np.multiply(d, d, out=by)
            by *= 0.01
            m2 += by
            np.multiply(m2, 1 / (1 - 0.99**n), out=by)
            np.sqrt(by, out=by)
            by += 1e-8
            np.divide(m1, by, out=by)
            by *= rate / (1 - 0.9**n)
            if rows:
                w[own] -= by
                all1[own], all2[own] = m1, m2
            else:
                w -= by

    def train(self, texts: list[np.ndarray], end: int, steps: int = STEPS, batch: int = BATCH, rate: float = 0.01, seed: int = 5) -> None:
        """Steps on random windows of the id sequences (each with the end before and after it)."""
        flat = np.concatenate([np.concatenate([[end], t]) for t in texts] + [[end] * (WINDOW + 1)]).astype(np.int64)
        self.fit(np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 1), steps, batch, rate, seed)

    def fit(self, windows: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.01, seed: int = 5) -> None:
        """Steps on random rows of windows (WINDOW + 1 ids each), with a falling rate."""
        r, held = np.random.default_rng(seed), {}
        for step in range(1, steps + 1):
            own = windows[r.integers(0, len(windows), batch)]
            self.step(own[:, :-1], own[:, 1:], rate * (1 - step / (steps + 1)), held)

    def score(self, texts: list[np.ndarray], end: int) -> np.ndarray:
        """log10 probability of each id sequence and its end.

        As forward() and log_probabilities() have it: what an id brings to queries, to keys, through v, o and w1 to the hidden layer by
        being attended, and by standing there itself, is looked up in tables. Of later windows only the last STRIDE places are asked.
        """
        p, d = self.p, WIDTH
        t = p["e"].dtype
        one = lambda x, last: np.concatenate([x, np.full((len(x), 1), last, t)], 1)
        turn = p["v"] @ p["o"] @ p["w1"]
        (ask, ask_at), (own, own_at), (met, met_at) = (((p["e"] @ m), (p["pos"] @ m)) for m in (p["q"] * t.type(d**-0.5), p["w1"], np.concatenate([p["k"], turn], 1)))
        own, own_at, met, met_at, heads = one(own, 1), one(own_at + p["b1"], 0), one(met, 1), one(met_at, 0), self.heads()
        cap = np.where(self.mask < 0, self.mask, t.type(60))
        n = np.array([len(x) + 1 for x in texts])  # places; place j predicts the id of place j + 1
        flat = np.concatenate([*(y for x in texts for y in ([end], x)), [end] * (WINDOW + 1)]).astype(np.int64)
        windows = np.where(n > WINDOW, -(-(n - WINDOW + STRIDE) // STRIDE), 1)
        owner = np.repeat(np.arange(len(texts)), windows)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
        out = np.zeros(len(texts))
        for is_late in (False, True):
            first = WINDOW - STRIDE if is_late else 0
            which = np.flatnonzero((start > 0) == is_late)
            for b in range(0, len(which), 512):
                k = which[b : b + 512]
                place = ((np.cumsum(n) - n)[owner[k]] + start[k])[:, None] + np.arange(WINDOW)
                ids, goal = flat[np.minimum(place, len(flat) - 2)], flat[np.minimum(place[:, first:] + 1, len(flat) - 1)]
                z = room("hidden", (len(k), WINDOW - first, HIDDEN + 1), t)
                for i in range(0, len(k), CHUNK):  # what is made on the way stays in the processor's cache
                    x, m = ids[i : i + CHUNK, first:], np.take(met, ids[i : i + CHUNK], axis=0)
                    m += met_at
                    q = np.take(ask, x, axis=0)
                    q += ask_at[first:]
                    a = q @ m[..., :d].transpose(0, 2, 1)
                    np.minimum(a, cap[first:], out=a)
                    np.exp(a, out=a)
                    c = a @ m[..., d:]
                    c *= 1 / c[..., -1:]
                    c[..., -1] = 0
                    h = np.take(own, x, axis=0)
                    h += own_at[first:]
                    h += c
                    np.maximum(h, 0, out=z[i : i + CHUNK])
                there = np.flatnonzero((start[k][:, None] + np.arange(first, WINDOW) < n[owner[k]][:, None]).ravel())
                kind = (goal.ravel()[there] // MEMBERS).astype(np.int16)
                there = there[np.argsort(kind, kind="stable")]
                g = goal.ravel()[there]
                zs, y = room("zs", (len(there), HIDDEN + 1), t), room("y", (len(there), CLASSES + MEMBERS), t)
                np.take(z.reshape(-1, HIDDEN + 1), there, axis=0, out=zs, mode="clip")
                for i, rows in by_class(kind):
                    np.matmul(zs[rows], heads[i], out=y[rows])
                if len(y) and y.max() > 60:
                    np.minimum(y, 60, out=y)
                at = np.arange(len(y)) * (CLASSES + MEMBERS)
                lp = np.take(y, at + g // MEMBERS) + np.take(y, at + CLASSES + g % MEMBERS)
                np.exp(y, out=y)
                lp -= np.log(y.reshape(-1, CLASSES) @ np.ones(CLASSES, t)).reshape(-1, 2).sum(1)
                out += np.bincount(owner[k][there // (WINDOW - first)], lp, len(texts))
        return out / np.log(10)


def word_counts(train: DataFrame) -> DataFrame:
    """A written table of (hash, word, n) over all words of the documents given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        out = lambda: pa.RecordBatch.from_pydict({"hash": pa.array([_hash(w) for w in held], pa.int64()), "word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
        for b in batches:
            for t in b.column(1).to_pylist():
                held.update(t.encode().lower().split())
            if len(held) > 400_000:
                yield out()
                held.clear()
        yield out()

    rows = map_arrow(train, run, "hash long, word binary, n long")
    return written(rows.groupBy("hash", "word").agg(F.sum("n").alias("n")), "words")


def frequent_words(words: DataFrame, most: int = FREQUENT_WORDS) -> dict[bytes, int]:
    """The words that are more frequent than some count, `most` at most. The driver gets how many words have each count, and
    these words."""
    by = sorted(((r["n"], r["k"]) for r in words.groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True)
    total = np.cumsum([k for _, k in by])
    some = int((total <= most).sum())
    if not some:
        return {}
    return {bytes(x["word"]): x["n"] for x in words.where(F.col("n") >= by[some - 1][0]).select("word", "n").collect()}


def _hash(w: bytes) -> int:
    return xxhash.xxh64_intdigest(w) - (1 << 63)


def id_counts(words: DataFrame, pieces: tuple[bytes, ...], n_docs: int) -> np.ndarray:
    """Counts of subword ids and of the end over all training documents, from the word counts."""
    size = subwords(pieces).end + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, total = subwords(pieces), np.zeros(size)
        for b in batches:
            ws = b.column(0).to_pylist()
            for i in range(0, len(ws), 5000):
                part = ws[i : i + 5000]
                spelt = [tok.word(w) for w in part]
                ids = np.frombuffer(b"".join(spelt), "<i4")
                k = np.repeat(b.column(1).to_numpy()[i : i + 5000], [len(x) // 4 for x in spelt])
                total += np.bincount(ids, k, size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some].astype(np.int64))], ["id", "n"])

    got = map_arrow(words.select("word", "n"), run, "id long, n long", rows=20_000).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[got["id"].to_numpy()] = got["n"].to_numpy()
    out[-1] += n_docs
    return out


def chosen_pieces(words: DataFrame, path: str, size: int = CLASSES * MEMBERS) -> tuple[bytes, ...]:
    """The single bytes and the tokens of the file that are most frequent, when words are split over all its tokens; with the end
    they are `size`."""
    all_ = tuple(sorted(file_tokens(path)))
    counts = id_counts(words, all_, 0)
    tok = subwords(all_)
    order = sorted((t for t in range(tok.end) if len(tok.pieces[t]) > 1), key=lambda t: (-counts[t], tok.pieces[t]))
    return tuple(sorted([bytes([b]) for b in range(256)] + [tok.pieces[t] for t in order[: size - 257]]))


SPELT = "doc_id long, h long, n_tokens long, known long, logs double, rare binary, ids binary"


def spelt(rows: DataFrame, pieces: tuple[bytes, ...], logs: Broadcast | None = None) -> DataFrame:
    """Of each row of doc_id and text: the hash of both; the number of tokens, and of those whose logarithms are given, with their sum and
    the hashes of the other words; the ids of its words, as two bytes each. So texts are split and spelt once for training and scoring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, log = subwords(pieces), logs.value if logs else {}
        for b in batches:
            out = [[] for _ in range(5)]
            for t in b.column(1).to_pylist():
                ws = t.encode().lower().split()
                got = [log.get(w) for w in ws]
                rare = [_hash(w) for w, x in zip(ws, got, strict=True) if x is None] if logs else []
                known = [x for x in got if x is not None]
                for column, x in zip(out, (len(ws) + 1, len(known), float(sum(known)), np.array(rare, "<i8").tobytes(), tok(ws, log if logs else None).astype("<i2").tobytes()), strict=True):
                    column.append(x)
            types = pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(x, t) for x, t in zip(out, types, strict=True))], [c.split()[0] for c in SPELT.split(", ")])

    return map_arrow(rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")), run, SPELT)


def ids_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i2").astype("<i4") for x in column.to_pylist()]


def start_windows(train: DataFrame, pieces: tuple[bytes, ...], n_all: int, wanted: int = STEPS * BATCH) -> np.ndarray:
    """About `wanted` windows of WINDOW + 1 ids, from places of all training texts that the rows' hashes draw evenly. `n_all` is about
    how many places there are; rows are texts, or spelt."""
    rate, end = min(4.0, wanted / max(1, n_all)), subwords(pieces).end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, ids in zip(b.column(0).to_pylist(), ids_of(b.column(1)), strict=True):
                r = np.random.default_rng(h & (1 << 64) - 1)
                if k := r.poisson(rate * (len(ids) + 1)):
                    s = np.concatenate([[end], ids, [end] * (WINDOW + 1)]).astype("<i4")
                    out += [s[i : i + WINDOW + 1].tobytes() for i in r.integers(0, len(ids) + 1, k)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    rows = train if "ids" in train.columns else spelt(train, pieces)
    got = map_arrow(rows.select("h", "ids"), run, "ids binary").toArrow()["ids"].to_pylist()
    return np.sort(np.array(got, f"S{4 * (WINDOW + 1)}")).view("<i4").reshape(len(got), WINDOW + 1).astype(np.int64)


class Learner:
    """A worker of a round: goes on from a model over texts in the order given, and tells what that changed."""

    def __init__(self, start: Attention, end: int, rate: float, batch: int):
        self.start, self.own, self.rate, self.batch = start, copy(start), rate, batch
        self.own.p = {k: v.copy() for k, v in start.p.items()}
        self.r, self.held, self.seen, self.total = np.random.default_rng(7), {}, np.zeros(CLASSES * MEMBERS), 0
        self.waiting, self.size, self.tail = [], 1, np.full(WINDOW + 1, end)

    def take(self, ids: np.ndarray) -> None:
        self.seen += np.bincount(ids, minlength=len(self.seen))
        self.total += len(ids)
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size > PASS_IDS:
            self._cut(False)

    def _steps(self, windows: np.ndarray) -> None:
        for k in np.array_split(self.r.permutation(len(windows)), -(-len(windows) // self.batch)):
            self.own.step(windows[k, :-1], windows[k, 1:], self.rate, self.held)

    def _cut(self, last: bool) -> None:
        flat = np.concatenate([self.tail[-1:], *self.waiting])
        k = (len(flat) - 1) // WINDOW
        if k:
            self._steps(flat[np.arange(k)[:, None] * WINDOW + np.arange(WINDOW + 1)])
        left = flat[k * WINDOW :]
        self.tail = np.concatenate([self.tail, flat[1 : k * WINDOW + 1]])[-WINDOW - 1 :]
        if last and len(left) > 1:  # the last window reaches back to ids that were predicted before
            self._steps(np.concatenate([self.tail, left[1:]])[None, -WINDOW - 1 :])
        self.waiting, self.size = [left[1:]], len(left)

    def sums(self) -> Iterator[tuple[int, bytes]]:
        """(slice, sums): of each slice of the embedding, what its rows moved by times how often the worker had their ids, and that;
        of all other weights (slice -1), what they moved by times the worker's ids, and these."""
        self._cut(True)
        moved = {k: self.own.p[k] - self.start.p[k] for k in self.own.p}
        e = np.concatenate([moved.pop("e") * self.seen[:, None], self.seen[:, None]], 1)
        for i in range(0, len(e), SLICE):
            if self.seen[i : i + SLICE].any():
                yield i, e[i : i + SLICE].tobytes()
        yield -1, np.concatenate([*(d.ravel() * float(self.total) for d in moved.values()), [self.total]]).astype(float).tobytes()


def learn(model: Attention, train: DataFrame, pieces: tuple[bytes, ...], n_all: int = 0) -> int:
    """One pass of the model over every id of every training text, on the executors; returns the number of ids predicted.

    Rows are dealt to ROUNDS rounds and, in each, to workers by their hash, so that what is learnt doesn't depend on partitions or on
    how many executors there are. Rows are texts, or spelt. `n_all` is about how many words there are: a worker has some WORKER_WORDS, or more where a
    round would have more than WORKERS. A worker goes on from the round's model over its texts in the order of their hashes, as
    they stream by. Then what workers changed is averaged, of an id's embedding by how often they had the id, of the other weights by
    their ids; sums are made by shuffle, in slices. The model moves by that average and by MOMENTUM of its last move.
    """
    n_workers = min(WORKERS, max(1, -(-n_all // (ROUNDS * WORKER_WORDS))))
    end, total, last = subwords(pieces).end, 0, {}
    own = None if "ids" in train.columns else written(spelt(train, pieces), "spelt")
    rows = (own or train).select("ids", "h", F.pmod("h", F.lit(n_workers)).alias("worker"), F.pmod(F.shiftright("h", 40), F.lit(ROUNDS)).alias("round"))

    def added(t: pa.Table) -> pa.Table:
        parts = sorted(t["sums"].to_pylist())
        out = np.frombuffer(parts[0]).copy()
        for x in parts[1:]:
            out += np.frombuffer(x)
        return pa.table({"slice": t["slice"][:1], "sums": pa.array([out.tobytes()], pa.binary())})

    for k in range(ROUNDS):
        handle = train.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], handle=handle, rate=PASS_RATE * (1 - k / ROUNDS), size=PASS_BATCH) -> Iterator[pa.RecordBatch]:
            at, own = None, None
            batch = lambda: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*own.sums(), strict=True), (pa.int64(), pa.binary()), strict=True)], ["slice", "sums"])
            for b in batches:
                for ids, worker in zip(ids_of(b.column(0)), b.column(1).to_pylist(), strict=True):
                    if worker != at:
                        if own:
                            yield batch()
                        at, own = worker, Learner(handle.value, end, rate, size)
                    own.take(np.append(ids, end))
            if own:
                yield batch()

        dealt = rows.where(F.col("round") == k).repartition(2 * n_workers, "worker").sortWithinPartitions("worker", "h", "ids").select("ids", "worker")
        moved = written(map_arrow(dealt, run, "slice long, sums binary"), "learnt")
        for i, x in ((r["slice"], np.frombuffer(bytes(r["sums"]))) for r in moved.groupBy("slice").applyInArrow(added, "slice long, sums binary").collect()):
            if i >= 0:
                x = x.reshape(-1, WIDTH + 1)
                _move(model.p["e"][i : i + SLICE], x[:, :-1] / np.maximum(x[:, -1:], 1), last, i)
            else:
                total, at = total + int(x[-1]), 0
                for name in (w for w in model.p if w != "e"):
                    size = model.p[name].size
                    _move(model.p[name], (x[at : at + size] / x[-1]).reshape(model.p[name].shape), last, name)
                    at += size
        discard(moved)
        handle.unpersist()
    discard(own)
    return total


def _move(weights: np.ndarray, by: np.ndarray, last: dict, name) -> None:
    """Adds an average move and MOMENTUM of the last one, in place."""
    last[name] = by + MOMENTUM * last.get(name, 0.0)
    weights += last[name].astype(np.float32)


PARTIAL = "key long, doc_id long, n_tokens long, known long, logs double, score double"


def scores(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Null, empty and blank texts have one token, the end. A null id counts as the empty text for its fold. Repeated rows are
    documents of their own in counts and results. Without training documents N and V are 0 and every base score is 0.
    """
    rows = documents(docs)
    train = rows.where(fold(F.col("doc_id")) != HELD_OUT)
    words = word_counts(train)
    n_docs = train.count()
    r = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = r["n"] + n_docs, r["v"] + (n_docs > 0)
    frequent = frequent_words(words)
    pieces = chosen_pieces(words, path)
    end = subwords(pieces).end
    share = docs.sparkSession.sparkContext.broadcast
    all_ = written(spelt(rows, pieces, share({w: (float(np.log10(c + 1))) for w, c in frequent.items()})).withColumn("key", F.monotonically_increasing_id()), "spelt")
    counts = id_counts(words, pieces, n_docs)
    model = Attention(counts)
    if r["n"]:
        train = all_.where(fold(F.col("doc_id")) != HELD_OUT)
        start = start_windows(train, pieces, int(counts.sum()))
        if len(start):
            model.fit(start)
        learn(model, train, pieces, n_all)
    handle = share(model)
    end_log = float(np.log10(n_docs + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = ids_of(b.column(5))
            score = np.concatenate([np.zeros(0), *(handle.value.score(ids[i : i + 64], end) for i in range(0, len(ids), 64))])
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(score)], [c.split()[0] for c in PARTIAL.split(", ")])

    columns = F.col("known") + int(n_docs > 0), F.col("logs") + end_log
    part = all_.select("key", "doc_id", "n_tokens", columns[0].alias("known"), columns[1].alias("logs"), "ids")
    part = written(map_arrow(part, run, PARTIAL), "scores")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(np.frombuffer(x, "<i8"), return_counts=True) for x in b.column(1).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), [len(u) for u, _ in found])), pa.array(np.concatenate([u for u, _ in found])), pa.array(np.concatenate([c for _, c in found]).astype(np.int32))], ["key", "hash", "k"])

    rare = map_arrow(all_.select("key", "rare"), spread, "key long, hash long, k int").join(words.select("hash", "n"), "hash")
    rare = rare.groupBy("key").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more_logs"))
    all_ = part.join(rare, "key", "left")
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))
    return all_.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
