"""Token-id files in Simple-8b: each 64-bit word holds a selector and as many ids as fit.

Word layout: the selector is in the top 4 bits, ids follow from the lowest bits up. Selectors 0 to 13 pack
COUNTS[s] ids of WIDTHS[s] bits; selector 15 is an escape: the next word is one raw 64-bit id. A document's words
start at a word boundary, so that a block is the concatenation of its documents' words and can be decoded at once.

A file set is a Parquet table of blocks (shard, block, doc_ids, counts, offsets, words), documents ascending by id
over shards, blocks and places. Spark's committer makes rewriting after a lost executor safe.
"""

from __future__ import annotations

import codecs
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, map_arrow, shared_dir

WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = 60 // WIDTHS
ESCAPE = 15
#: Bits of the ids below 2**16, one at least.
BITS = np.maximum(np.frexp(np.arange(1 << 16))[1], 1).astype(np.int8)
PACKED = "doc_id long, n_tokens long, words binary"
BLOCK = "shard int, block long, n_tokens long, doc_ids binary, counts binary, offsets binary, words binary"
#: Documents and bytes after which a block is closed.
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20
#: Words of a generation of the cache; two are kept.
CACHE_WORDS = 250_000
#: The library's byte-level splitting rule (a fixed value of the file format).
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def _latin(kind: str) -> str:
    """The characters below 256 of a Unicode class, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(kind, chr(c)))


def _latin_split() -> re.Pattern[str]:
    """SPLIT for texts of characters below 256, which the faster library reads; what is met most comes first, where no other
    alternative matches."""
    letter, number, space = _latin(r"\p{L}"), _latin(r"\p{N}"), _latin(r"\s")
    return re.compile(f" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


SPLIT_LATIN = _latin_split()


def encode(ids: np.ndarray) -> np.ndarray:
    """Words of a sequence of ids (any unsigned 64-bit values); an empty sequence has none."""
    return encode_many([ids])[0]


def encode_many(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Words of each sequence. The selector at each place is the one that packs most ids; places are then followed from the
    first. Sequences are laid out with a stop between them that fits no selector, so that no word crosses it."""
    if not parts:
        return []
    stops = np.cumsum([len(p) + 1 for p in parts]) - 1
    ids = np.full(int(stops[-1]) + 1, np.uint64(2**64 - 1))
    is_stop = np.zeros(len(ids), bool)
    is_stop[stops] = True
    given = np.concatenate(parts)
    ids[~is_stop] = given.astype(np.uint64)
    n = len(ids)
    bits = np.full(n, 64, np.int8)
    if given.dtype == np.uint32 and len(given) and given.max() < len(BITS):
        bits[~is_stop] = BITS[given]
    else:
        bits = np.frexp(ids.astype(np.float64))[1].astype(np.int8)  # 2**60 - 1 rounds up: it is escaped
        np.maximum(bits, 1, out=bits)
    best = np.full(n, -1, np.int8)
    most, have = bits, 1  # most[i]: the largest of bits[i : i + have]
    for s in range(len(WIDTHS) - 1, -1, -1):
        k = int(COUNTS[s])
        if k > n:
            break
        while have < k:
            step = min(have, k - have)
            most = np.maximum(most[: len(most) - step], most[step:])
            have += step
        fits = most <= WIDTHS[s]
        if not fits.any():  # nor do more ids in fewer bits
            break
        np.copyto(best[: len(most)], np.int8(s), where=fits)
    step = np.where(best >= 0, COUNTS[best], 1).tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at)
    at = at[~is_stop[at]]
    sel = best[at]
    size = np.where(sel >= 0, 1, 2)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(sel):
        here = sel == s
        if s < 0:
            out[place[here]] = np.uint64(ESCAPE << 60)
            out[place[here] + 1] = ids[at[here]]
            continue
        word = np.full(int(here.sum()), np.uint64(int(s) << 60))
        first = at[here]
        for k in range(int(COUNTS[s])):
            word |= ids[first + k] << np.uint64(k * int(WIDTHS[s]))
        out[place[here]] = word
    per = np.bincount(np.searchsorted(stops, at), size, len(parts)).astype(int)
    return np.split(out, np.cumsum(per)[:-1])


def decode(words: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
    """Ids of whole words, all selectors at once. After an escape comes a raw word, which may look like any selector; where the
    offsets of documents are given, only the words of those with an escape are read one after the other."""
    words = np.ascontiguousarray(words, np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    escapes = np.flatnonzero(sel == ESCAPE)
    if len(escapes):
        starts = np.zeros(1, np.int64) if offsets is None else np.unique(offsets.astype(np.int64))
        head, ends = np.ones(len(words), bool), np.append(starts, len(words))[1:]
        for d in np.unique(np.searchsorted(starts, escapes, side="right") - 1):
            i, found = int(starts[d]), sel[starts[d] : ends[d]].tolist()
            at = 0
            while at < len(found):
                if found[at] == ESCAPE:
                    head[i + at + 1] = False
                    at += 1
                at += 1
        heads = np.flatnonzero(head)
    else:
        heads = np.arange(len(words))
    sel = sel[heads]
    count = np.where(sel == ESCAPE, 1, COUNTS[np.minimum(sel, len(COUNTS) - 1)])
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(sel):
        here = sel == s
        if s == ESCAPE:
            out[start[here]] = words[heads[here] + 1]
            continue
        w, to, mask = words[heads[here]], start[here], np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[to + k] = (w >> np.uint64(k * int(WIDTHS[s]))) & mask
    return out


class ByteEncoder:
    """A byte-level tokenizer file, read by the library, with the ids of words met before kept: words are what it splits first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from .bpe import byte_symbols

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = "".join(byte_symbols())
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._stop()

    def _stop(self) -> None:
        """A byte that UTF-8 never has, whose symbol is in the vocabulary and in no merge: what stands between two of them is encoded
        as it is alone, so that the library's model reads many words at once. None where the model isn't plain BPE."""
        spec = json.loads(self.tokenizer.to_str())["model"]
        plain = spec["type"] == "BPE" and not any(spec.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback"))
        merged = {c for m in spec.get("merges", []) for c in "".join(m)}
        never = [b for b in (0xFF, 0xFE, 0xC0, 0xC1, *range(0xF5, 0xFE)) if self.symbols[b] not in merged]
        self.model, self.stop = self.tokenizer.model, None
        if plain and never and set(self.symbols) <= set(spec["vocab"]):
            self.stop, self.stop_id = chr(0xDC00 + never[0]), spec["vocab"][self.symbols[never[0]]]

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return SPLIT.findall(text)
        return SPLIT_LATIN.findall(text)

    def _read(self, data: bytes) -> str:
        """The character that stands for each byte."""
        return codecs.charmap_decode(data, "strict", self.symbols)[0]

    def word(self, word: str) -> bytes:
        """Ids of a word: the library's model reads a character for each byte."""
        return np.array([t.id for t in self.model.tokenize(self._read(word.encode()))], "<u4").tobytes()

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        if self.stop is None:
            return [self.word(w) for w in words]
        out, stop = [], self.stop
        for at in range(0, len(words), 256):
            data = (stop.join(words[at : at + 256]) + stop).encode("utf-8", "surrogateescape")  # the stop is a byte that is no UTF-8
            ids = np.array([t.id for t in self.model.tokenize(self._read(data))], "<u4")
            ends = (4 * np.flatnonzero(ids == self.stop_id)).tolist()
            data = ids.tobytes()
            out += [data[a:z] for a, z in zip([0, *[e + 4 for e in ends[:-1]]], ends, strict=True)]
        return out

    def _known(self, found: list[str]) -> list[bytes]:
        words, old = self.words, self.old
        out = list(map(words.get, found))
        if None in out:
            at = [i for i, x in enumerate(out) if x is None]
            fresh = dict.fromkeys([found[i] for i in at])
            for w in fresh:
                fresh[w] = old.get(w)
            new = [w for w, x in fresh.items() if x is None]
            fresh.update(zip(new, self.encoded(new), strict=True))
            for i in at:
                out[i] = fresh[found[i]]
            words.update(fresh)
            if len(words) > CACHE_WORDS:  # words that are met again soon come back from the generation before
                self.words, self.old = {}, words
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if any(s in text for s in self.special):
                out.append(np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(b"".join(self._known(self.split(text))))
        return out


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def packed(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """doc_id, n_tokens and Simple-8b words of every document, its end id included; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, end = byte_encoder(path), end_id.to_bytes(4, "little")
        for b in batches:
            ids = [np.frombuffer(x + end, "<u4") for x in enc(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([w.tobytes() for w in encode_many(ids)], pa.binary())], ["doc_id", "n_tokens", "words"])

    return map_arrow(documents(docs), run, PACKED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, block = None, 0
    ids: list[int | None] = []
    counts: list[int] = []
    words: list[bytes] = []

    def close() -> pa.RecordBatch:
        nonlocal block
        ends = np.cumsum([len(w) // 8 for w in words])
        row = {"shard": [shard], "block": [block], "n_tokens": [sum(counts)], "doc_ids": [np.array([_NULL if i is None else i for i in ids], "<i8").tobytes()], "counts": [np.array(counts, "<u8").tobytes()], "offsets": [(ends - [len(w) // 8 for w in words]).astype("<u8").tobytes()], "words": [b"".join(words)]}
        block += 1
        ids.clear(), counts.clear(), words.clear()
        return pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("counts", pa.binary()), ("offsets", pa.binary()), ("words", pa.binary())]))

    held = 0
    for b in batches:
        for s, i, n, w in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if ids and (s != shard or len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES):
                yield close()
                held = 0
            if s != shard:
                shard, block = s, 0
            ids.append(i)
            counts.append(n)
            words.append(w)
            held += len(w)
    if ids:
        yield close()


#: Stands for a null id in a block.
_NULL = -(1 << 63)


def write(docs: DataFrame, path: str, out: str, end_id: int = 0, shards: int | None = None) -> None:
    """Writes the token-id files of all documents, ascending by doc_id (null first, by hash; of equal ids, by content)."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    rows = packed(docs, path, end_id)
    size = docs.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("none")).first()
    first = max(1, -(-size["none"] * n // max(1, size["n"])))  # shards of rows without an id, which come first, by hash
    shard = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    shard = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("words"), F.lit(first))).otherwise(shard + first).cast("int")
    dealt = rows.select(shard.alias("shard"), "doc_id", "n_tokens", "words").repartitionById(first + len(cuts) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "n_tokens", "words")
    map_arrow(dealt, _blocks, BLOCK).write.parquet(out)


def read(spark, out: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) read from the files.

    Starts come from block counts: a running sum inside each shard, plus the totals of the shards before it. They are a row for
    each block, and are sent to the blocks, which aren't shuffled.
    """
    blocks = spark.read.schema(BLOCK).parquet(out)
    count = blocks.select("shard", "block", "n_tokens")
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = count.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", before.alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = count.select("shard", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("in_shard")).join(shards, "shard").select("shard", "block", (F.col("in_shard") + F.col("shard_start")).alias("start"))
    return blocks.drop("n_tokens").join(F.broadcast(starts), ["shard", "block"]).select("start", "doc_ids", "counts", "offsets", "words")


def unpack(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of each document of the blocks that read() gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, ids, counts, offsets, words in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                ids, counts = np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<u8").astype(np.int64)
                flat = decode(np.frombuffer(words, "<u8"), np.frombuffer(offsets, "<u8")).astype("<u4")
                ends = np.cumsum(counts)
                crc = [zlib.crc32(flat[e - c : e].tobytes()) for e, c in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == _NULL), pa.array(ends - counts + start, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(blocks, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document(block: dict, k: int) -> np.ndarray:
    """Ids of document k of one block, decoded from its own words alone."""
    offsets, words = np.frombuffer(block["offsets"], "<u8").astype(int), np.frombuffer(block["words"], "<u8")
    return decode(words[offsets[k] : offsets[k + 1] if k + 1 < len(offsets) else len(words)])


def round_trip(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes the files into the shared folder and returns what unpack() reads from them.

    Empty and null texts have their end id alone; an empty table gives no rows.
    """
    out = shared_dir(docs.sparkSession, "tokens")
    write(docs, path, out, end_id)
    return unpack(read(docs.sparkSession, out))
