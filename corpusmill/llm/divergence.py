"""How far the sources of a language differ in their terms.

A term is a maximal run of letters A-Z, a-z and characters beyond ASCII; A-Z are lower-cased. Each language keeps the terms
that at least `least_docs` of its documents (rows) have. Shares are integers: 1 + floor(10^9 (count + 5) / (N + 5 V)).

1. Tokens: a lookup table over the concatenated UTF-8 bytes of many texts finds boundaries; slices are grouped by xxhash, and
   every slice is compared with the first of its group byte by byte. A CSR matrix of documents by terms, reduced by source,
   gives occurrences and documents. Tasks combine what they count before Spark sums it.
2. Terms are dealt to blocks of some BLOCK counts. A block has all of a term's counts, and every source of the language. Its
   CSR matrix of sources by terms gives each pair's sum over the block's terms, and each source's first terms.
3. Spark sums pairs over blocks and ranks.

Null texts, languages and sources are ''. An empty table gives no rows; a source without terms is compared like all others;
a language without kept terms has pairs of value 0. Rows with equal ids are documents of their own. Exact while a language
has fewer than 9 * 10^15 term occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_arrow, written

#: Bytes of text that are looked at together, and entries and terms that a task holds before it gives them away.
CHUNK, HELD, HELD_TERMS = 4 << 20, 1 << 20, 200_000
#: Counts of a block, and the rank up to which a source's terms are given.
BLOCK, TOP = 100_000, 50
SCALE, ADDED = 1_000_000_000, 5

#: Lower-cased byte of each byte of a term, 0 of all others.
_LOWER = np.zeros(256, np.uint8)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)


def tokens(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the terms of the texts that lie one after the other in `text` and end at `ends`."""
    low = _LOWER[text]
    inside = low != 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    first = np.append(0, ends[:-1])
    first = first[first < len(text)]
    begins[first] = inside[first]
    last = ends[ends > 0] - 1
    stops[last] = inside[last]
    return low, np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all bytes of slices, one slice after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def grouped(low: np.ndarray, starts: np.ndarray, stops: np.ndarray, digest=xxhash.xxh64_intdigest) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and each slice's place among them. Slices of one digest are compared byte by byte; where they
    differ, the bytes themselves are the groups."""
    raw = low.tobytes()
    hashes = np.fromiter((digest(raw[s:e]) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)), np.uint64, len(starts))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    sizes, own = stops - starts, first[group]
    if (sizes == sizes[own]).all() and (low[_spread(starts, sizes)] == low[_spread(starts[own], sizes)]).all():
        return [raw[s:e] for s, e in zip(starts[first].tolist(), stops[first].tolist(), strict=True)], group
    places: dict[bytes, int] = {}
    group = np.fromiter((places.setdefault(raw[s:e], len(places)) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)), np.int64, len(starts))
    return list(places), group


class _Counts:
    """Occurrences and documents by source and term, summed until there are too many to hold."""

    def __init__(self):
        self.sources: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.n = 0

    def source(self, lang: str, source: str) -> int:
        return self.sources.setdefault((lang, source), len(self.sources))

    def add(self, sources: np.ndarray, terms: list[bytes], group: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> None:
        own = np.fromiter((self.terms.setdefault(t, len(self.terms)) for t in terms), np.int64, len(terms))
        self.parts.append(np.stack([sources << 32 | own[group], counts, docs]))
        self.n += len(group)

    def summed(self) -> np.ndarray:
        """Keys, occurrences and documents."""
        a = np.concatenate([np.zeros((3, 0), np.int64), *self.parts], axis=1)
        a = a[:, np.argsort(a[0], kind="stable")]
        starts = np.flatnonzero(np.append(True, a[0, 1:] != a[0, :-1])) if a.shape[1] else np.zeros(0, np.int64)
        a = np.stack([a[0, starts], *(np.add.reduceat(c, starts) if len(starts) else c for c in a[1:])])
        self.parts, self.n = [a], a.shape[1]
        return a

    def take(self, least_entries: int = HELD, least_terms: int = HELD_TERMS) -> Iterator[pa.RecordBatch]:
        """All that is held as rows, where there are too many; each source has a row of its own without a term."""
        if self.n < 2 * least_entries and len(self.terms) < least_terms:
            return
        a = self.summed()
        if a.shape[1] < least_entries and len(self.terms) < least_terms:
            return
        names, terms = list(self.sources), pa.array(list(self.terms), pa.binary()).cast(pa.string())
        langs, sources = pa.array([k[0] for k in names], pa.string()), pa.array([k[1] for k in names], pa.string())
        none = pa.array([0] * len(names), pa.int64())
        yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(names), pa.string()), none, none], ["lang", "source", "term", "n", "docs"])
        for at in range(0, a.shape[1], 50_000):
            key, n, docs = a[:, at : at + 50_000]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(key >> 32)), sources.take(pa.array(key >> 32)), terms.take(pa.array(key & 0xFFFFFFFF)), pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])
        self.__init__()


def _of_texts(held: _Counts, text: np.ndarray, ends: np.ndarray, source: np.ndarray) -> None:
    low, starts, stops = tokens(text, ends)
    if not len(starts):
        return
    terms, group = grouped(low, starts, stops)
    row = np.searchsorted(ends, starts, side="right")
    cell, k = np.unique(row * len(terms) + group, return_counts=True)  # documents by terms
    by_source = source[cell // len(terms)] * len(terms) + cell % len(terms)
    order = np.argsort(by_source, kind="stable")
    by_source, k = by_source[order], k[order]
    first = np.flatnonzero(np.append(True, by_source[1:] != by_source[:-1]))
    held.add(by_source[first] // len(terms), terms, by_source[first] % len(terms), np.add.reduceat(k, first), np.diff(np.append(first, len(k))))


def _of_long_text(held: _Counts, text: np.ndarray, source: int) -> None:
    """A text of more than CHUNK bytes, piece by piece, cut where no term is."""
    total: dict[bytes, int] = {}
    at = 0
    while at < len(text):
        z = min(at + CHUNK, len(text))
        gaps = np.flatnonzero(_LOWER[text[at:z]] == 0)
        if z < len(text) and not len(gaps):  # one term longer than a piece
            more = np.flatnonzero(_LOWER[text[z:]] == 0)
            z = z + int(more[0]) if len(more) else len(text)
        elif z < len(text):
            z = at + int(gaps[-1]) + 1
        piece = text[at:z]
        low, starts, stops = tokens(piece, np.array([len(piece)]))
        if len(starts):
            terms, group = grouped(low, starts, stops)
            for t, k in zip(terms, np.bincount(group).tolist(), strict=True):
                total[t] = total.get(t, 0) + k
        at = z
    if total:
        n = len(total)
        held.add(np.full(n, source, np.int64), list(total), np.arange(n), np.fromiter(total.values(), np.int64, n), np.ones(n, np.int64))


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it); with a null term, a row for every source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column(0).cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
            text = np.frombuffer(column.buffers()[2], np.uint8) if ends[-1] > ends[0] else np.zeros(0, np.uint8)
            names = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            at = 0
            while at < len(names):
                z = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, side="right")) - 1)
                source = np.array([held.source(*x) for x in names[at:z]], np.int64)
                part = text[ends[at] : ends[z]] if ends[z] > ends[at] else text[:0]
                if len(part) > CHUNK:
                    _of_long_text(held, part, int(source[0]))
                else:
                    _of_texts(held, part, ends[at + 1 : z + 1] - ends[at], source)
                yield from held.take()
                at = z
        yield from held.take(0, 0)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = map_arrow(docs.select(text("text"), text("lang"), text("source")), run, "lang string, source string, term string, n long, docs long", rows=4096)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(SCALE (count + ADDED) / (n + ADDED v)), by long division in thousands."""
    rest, by = count.astype(np.int64) + ADDED, n.astype(np.int64) + ADDED * v
    out = rest // by
    rest = rest % by
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // by, rest * 1000 % by
    return out + 1


def _pair_sums(p: np.ndarray, none: np.ndarray, ptr: np.ndarray, col: np.ndarray, v: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each source a, the sums of |p_a - p_b| over the v terms, of the sources b after it. Of each source's shares, p has
    those that aren't `none`, in CSR form."""
    base = np.repeat(none, np.diff(ptr))
    some = np.flatnonzero(np.diff(ptr) > 0)
    for a in range(len(none) - 1):
        own = np.full(v, none[a])
        own[col[ptr[a] : ptr[a + 1]]] = p[ptr[a] : ptr[a + 1]]
        high = np.sort(own)
        total = np.append(0, np.cumsum(high))
        x = none[a + 1 :]
        below = np.searchsorted(high, x)
        out = x * below - total[below] + (total[-1] - total[below]) - x * (v - below)  # as if b had none of the terms
        later = some[some > a]
        if len(later):
            z = slice(ptr[a + 1], None)
            more = np.abs(own[col[z]] - p[z]) - np.abs(own[col[z]] - base[z])
            out[later - a - 1] += np.add.reduceat(more, ptr[later] - ptr[a + 1])
        yield a, out


def _block(t: pa.Table) -> pa.Table:
    """Of a block: each pair's part of its sum, and each source's first terms."""
    lang, block = t["lang"][0].as_py(), t["block"][0].as_py()
    head = t.filter(pa.compute.is_null(t["term"])).sort_by("source")
    body = t.filter(pa.compute.is_valid(t["term"]))
    out: list[list] = [[], [], [], []]
    if len(body) or block == 0:
        sources, n, v = head["source"].to_pylist(), head["total"].to_numpy().astype(np.int64), head["v"][0].as_py()
        terms = sorted(pa.compute.unique(body["term"]).to_pylist(), key=str.encode)
        place, line = {x: i for i, x in enumerate(terms)}, {x: i for i, x in enumerate(sources)}
        row = np.fromiter((line[x] for x in body["source"].to_pylist()), np.int64, len(body))
        col = np.fromiter((place[x] for x in body["term"].to_pylist()), np.int64, len(body))
        order = np.lexsort((col, row))
        row, col, count = row[order], col[order], body["n"].to_numpy()[order]
        ptr = np.searchsorted(row, np.arange(len(sources) + 1))
        if terms:
            p, none = shares(count, n[row], v), shares(np.zeros_like(n), n, v)
            by_term = np.argsort(col, kind="stable")
            q = shares(np.add.reduceat(count[by_term], np.searchsorted(col[by_term], np.arange(len(terms)))), n.sum(), v)
            more = p - q[col]
            best = np.lexsort((col, -more, row))
            best = best[(np.arange(len(best)) - ptr[row] < TOP) & (more[best] > 0)]
            for i in best.tolist():
                for c, x in zip(out, ("term", sources[row[i]], terms[col[i]], int(more[i])), strict=True):
                    c.append(x)
            sums = _pair_sums(p, none, ptr, col, len(terms))
        else:
            sums = ((a, np.zeros(len(sources) - a - 1, np.int64)) for a in range(len(sources) - 1))
        for a, values in sums:
            for c, x in zip(out, (["pair"] * len(values), [sources[a]] * len(values), sources[a + 1 :], values.tolist()), strict=True):
                c.extend(x)
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array([lang] * len(out[0]), pa.string()), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["lang", "part", "source", "item", "value"])


def audit(docs: DataFrame, least_docs: int = 30) -> DataFrame:
    """lang, source, part, item, value and rank: see the head of this module and _block."""
    counted = written(counts(docs), "counts")
    kept = counted.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("d")).where(F.col("d") >= least_docs)
    entries = written(counted.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "entries")
    blocks = max(1, -(-entries.count() // BLOCK))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = entries.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    heads = counted.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    heads = heads.select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    none = F.lit(None).cast("long")
    rows = entries.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "source", "term", "n", none.alias("total"), none.alias("v"))
    found = written(rows.unionByName(heads).groupBy("lang", "block").applyInArrow(_block, "lang string, part string, source string, item string, value long"), "blocks")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    out = ["lang", "source", "part", "item", "value"]
    terms = found.where("part = 'term'").select(*out, rank).where(F.col("rank") <= TOP)
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.lit("pair").alias("part"))
    both = pairs.select(out).unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    discard(counted, entries)
    return terms.unionByName(both.select(*out, rank))
