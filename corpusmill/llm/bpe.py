"""BPE encoding and decoding by a deterministic automaton compiled from the merge list.

The automaton reads tokens. It starts with one state in which every base symbol loops. Each merge
(u, v) is one gadget: if the state that `u` leads to has an arc `v`, that state loses the arc (in a
copy, when other labels share the state) and every state with an arc `u` gains an arc `uv`, which
leads where `v` led. A token sequence is what BPE makes of its text exactly if the automaton reads
it. States keep only what distinguishes them from the state they were copied from, with the merge at
which it changed, so that 50,000 merges take megabytes rather than the full table of arcs; arcs that
encoding meets are memoised in a transition table.

A word is encoded by the one path that spells it; decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import documents, map_arrow

ENCODED = "doc_id long, ids binary, n_tokens long, decoded string"
#: Entries of the caches of one worker: words, and arcs met so far.
CACHE_WORDS, CACHE_ARCS = 150_000, 400_000


class MergeAutomaton:
    """Tokenisation automaton of a proper merge list; labels are numbered as in `vocab`.

    A state is named by the label that leads to it. `gone` has the arcs a label's own state lost and the gadget that
    took them; what it lost before its label was made, it has from the state of the label's right part, as it then was.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocab.values(), default=-1) + 1
        self.vocab, self.size, self.end_of_time = vocab, n, len(merges) + 1
        self.left, self.right, self.rank = [-1] * n, [-1] * n, [-1] * n
        self.longest = max(map(len, vocab), default=0)
        self.gone: dict[int, int] = {}
        made = {a + b for a, b in merges}
        self.live = [True] * n
        for w in made:
            self.live[vocab[w]] = False
        self.table: dict[int, bool] = {}
        for r, (a, b) in enumerate(merges):
            self._gadget(vocab[a], vocab[b], vocab[a + b], r)

    def _gadget(self, u: int, v: int, w: int, r: int) -> None:
        """The state of u loses its arc v; states with an arc u gain w, which leads where v led before this gadget."""
        if not (self.live[u] and self.live[v] and self._has(u, v, r)):
            return
        self.gone[u * self.size + v] = r
        if not self.live[w]:
            self.live[w] = True
            self.left[w], self.right[w], self.rank[w] = u, v, r

    def _has(self, state: int, label: int, before: int) -> bool:
        """Whether the state (-1: the start) has an arc with this label when the gadgets below `before` are in place."""
        gone, n, rank, right = self.gone, self.size, self.rank, self.right
        while True:
            r = rank[label]
            if r >= before or not self.live[label]:
                return False
            s, limit = state, before
            while s >= 0:
                if gone.get(s * n + label, limit) < limit:
                    return False
                if rank[s] < limit:
                    limit = rank[s]
                s = right[s]
            if r < 0:
                return True
            label, before = self.left[label], r + 1

    def arc(self, last: int, label: int) -> bool:
        """Whether `label` may follow the token `last`."""
        key = last * self.size + label
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= CACHE_ARCS:
                self.table.clear()
            known = self.table[key] = self._has(last, label, self.end_of_time)
        return known

    def encode(self, symbols: str, end: str = "") -> list[int]:
        """Ids of the path that spells `symbols` followed by `end`, which belongs to the last symbol. [] for no symbols."""
        n = len(symbols)
        if not n:
            return []
        if (whole := self.vocab.get(symbols + end)) is not None and self.live[whole]:
            return [whole]
        best: dict[int, tuple[int, int]] = {}
        for i in range(1, n) if n > 200 else ():  # keeps the recursion shallow
            self._last(i, symbols, "", best)
        self._last(n, symbols, end, best)
        out, i = [], n
        while i:
            t, i = best[i]
            out.append(t)
        return out[::-1]

    def _last(self, i: int, symbols: str, tail: str, best: dict[int, tuple[int, int]]) -> int:
        """The token that ends at position i, which is unique; earlier positions are looked at only as needed."""
        get, live = self.vocab.get, self.live
        for j in range(max(0, i - self.longest), i):
            t = get(symbols[j:i] + tail)
            if t is None or not live[t]:
                continue
            if j == 0 or self.arc(best[j][0] if j in best else self._last(j, symbols, "", best), t):
                best[i] = t, j
                return t
        raise ValueError(f"no path for {symbols!r}")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabularies of this kind."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    odd = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(odd)) for b in range(256)]


class WordCodec:
    """Encoder and decoder for a tokenizer file with word ends (`end_of_word_suffix`)."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"] or ""
        self.automaton = MergeAutomaton(model["vocab"], merges)
        labels = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.labels = [labels.get(i, "").encode() for i in range(max(labels) + 1)]
        self.symbols = dict(enumerate(byte_symbols()))
        parts = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(parts)
        self.split_ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens: NFC, lower case letter by letter, white space dropped."""
        if text.isascii():
            return self.split_ascii.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        return self.split.findall("".join(c.lower() for c in text) if "Σ" in text else text.lower())

    def word(self, word: str) -> bytes:
        ids = self.automaton.encode(word.encode().decode("latin-1").translate(self.symbols), self.end)
        return np.asarray(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        words, found = self.words, self.pieces(text)
        try:
            return b"".join([words[w] for w in found])
        except KeyError:
            if len(words) > CACHE_WORDS:
                words.clear()
            for w in found:
                if w not in words:
                    words[w] = self.word(w)
            return b"".join([words[w] for w in found])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.marks is None or not (hits := list(self.marks.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in hits:
            out += [self._plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """The arcs' labels, with single spaces between them, in UTF-8."""
        labels = self.labels
        return b" ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens and the decoded text of every document.

    A null or empty text has no ids and decodes to an empty text. Rows are handled one by one, so repeated ids,
    null ids, ties and further columns make no difference; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = [c.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([c.decode(i).decode() for i in ids], pa.string())], ["doc_id", "ids", "n_tokens", "decoded"])

    return map_arrow(documents(docs), run, ENCODED)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the text decoded from them; cases as in encode()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            ids = [c.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha(i) for i in ids], pa.string()), pa.array([sha(c.decode(i)) for i in ids], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(documents(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
