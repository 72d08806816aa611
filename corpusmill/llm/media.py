"""Media columns: bytes kept losslessly as 8-bit samples, with audio features and time spans.

The stored form is a RIFF/WAVE file of one channel of unsigned 8-bit samples. Features: polyphase resampling to half the
rate, overlapped log-mel filterbanks, and spans found by an energy gate with hysteresis.

A media table is a Parquet table of blocks in the shared folder. A block is an Arrow stream with the columns doc_id, media, tensor
(of the fixed-shape tensor type, POOLS x BANDS 32-bit floats) and spans (lists of start and end in seconds): Spark has no such
type, Arrow streams keep it. Spark's committer makes rewriting after a lost executor safe.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, map_arrow, written

UNIT, FILL = 576, b"\xff"
RATE, DOWN, TAPS = 8000, 2, 16
FRAME, HOP, BANDS, POOLS = 256, 128, 16, 8
#: The gate opens above the first and closes below the second, in decibels from the mean energy.
OPEN_DB, CLOSE_DB = 1.0, -1.0


def padded(payload: bytes, unit: int = UNIT) -> bytes:
    """Fill bytes up to a positive multiple of the unit."""
    return payload + FILL * (max(1, -(-len(payload) // unit)) * unit - len(payload))


def to_wave(samples: bytes, rate: int = RATE) -> bytes:
    pad = b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + len(pad)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + pad


def from_wave(media: bytes) -> bytes:
    """The samples, found by walking the chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE value")
    at = 12
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        if media[at : at + 4] == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def _lowpass() -> np.ndarray:
    n = np.arange(TAPS * DOWN) - (TAPS * DOWN - 1) / 2
    h = np.sinc(n / DOWN) * np.hamming(TAPS * DOWN)
    return (h / h.sum()).astype(np.float32)


def _mel() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(40), mel(RATE / DOWN / 2), BANDS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FRAME, DOWN / RATE)
    up = (f - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - f) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)).astype(np.float32).T


LOWPASS, MEL, WINDOW = _lowpass(), _mel(), np.hanning(FRAME).astype(np.float32)


def resampled(x: np.ndarray) -> np.ndarray:
    """Half the rate: each phase of the samples is filtered with its phase of the low-pass, and the phases are added."""
    n = -(-len(x) // DOWN)
    x = np.concatenate([x, np.zeros(n * DOWN - len(x), np.float32)]).reshape(n, DOWN)
    return sum(np.convolve(x[:, p], LOWPASS[DOWN - 1 - p :: DOWN])[TAPS // 2 : TAPS // 2 + n] for p in range(DOWN))


def features(samples: bytes) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """A tensor of POOLS x BANDS log-mel means over equal parts of the time, and the spans of high energy in seconds."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    y = resampled(x)
    if len(y) < FRAME:
        y = np.concatenate([y, np.zeros(FRAME - len(y), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    power = np.empty((len(frames), FRAME // 2 + 1), np.float32)
    for i in range(0, len(frames), 256):  # bounded memory for very long payloads
        s = np.fft.rfft(frames[i : i + 256] * WINDOW, axis=1)
        power[i : i + 256] = s.real**2 + s.imag**2
    mel = np.log10(np.maximum(power @ MEL, 1e-8))
    cuts = np.linspace(0, len(mel), POOLS + 1).astype(int)
    pooled = np.stack([mel[min(a, len(mel) - 1) : max(b, a + 1)].mean(axis=0) for a, b in zip(cuts, cuts[1:])])
    level = 10 * np.log10(np.maximum(power.sum(axis=1), 1e-8))
    level -= level.mean()
    # the gate: frames between the thresholds keep the state of the last decisive frame
    mark = np.where(level > OPEN_DB, 1, np.where(level < CLOSE_DB, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = np.concatenate([[False], (last >= 0) & (mark[last] > 0), [False]])
    edges = np.flatnonzero(on[1:] != on[:-1])
    second = HOP * DOWN / RATE
    return pooled, [(round(a * second, 3), round(b * second, 3)) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


#: Bytes of media after which a block is closed.
BLOCK_BYTES = 4 << 20
BLOCK = "n long, block binary"


SPANS = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))


def tensors(rows: list[np.ndarray]) -> pa.ExtensionArray:
    """Fixed-shape Arrow tensors of POOLS x BANDS 32-bit floats."""
    kind = pa.fixed_shape_tensor(pa.float32(), (POOLS, BANDS))
    flat = pa.array(np.concatenate([r.ravel() for r in rows]) if rows else np.zeros(0), pa.float32())
    return pa.ExtensionArray.from_storage(kind, pa.FixedSizeListArray.from_arrays(flat, POOLS * BANDS))


def blocks(docs: DataFrame) -> DataFrame:
    """n and block (an Arrow stream) of the media, tensors and spans of all texts (null: empty, which is one unit of fill bytes)."""

    def packed(ids: list, media: list[bytes]) -> pa.RecordBatch:
        found = [features(from_wave(m)) for m in media]
        spans = pa.array([[{"start": a, "end": z} for a, z in s] for _, s in found], SPANS)
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(media, pa.binary()), tensors([t for t, _ in found]), spans], ["doc_id", "media", "tensor", "spans"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["n", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, media, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                media.append(to_wave(padded(t.encode())))
                held += len(media[-1])
                if held >= BLOCK_BYTES:
                    yield packed(ids, media)
                    ids, media, held = [], [], 0
        if ids:
            yield packed(ids, media)

    return map_arrow(documents(docs), run, BLOCK, rows=256)


def opened(block: bytes) -> pa.RecordBatch:
    """The batch of a block: doc_id, media, tensor and spans."""
    return pa.ipc.open_stream(block).read_next_batch()


def store(docs: DataFrame) -> DataFrame:
    """The media table of all texts, written into the shared folder and read again."""
    return written(blocks(docs), "media")


def digests(docs: DataFrame) -> DataFrame:
    """Per document, sizes and digests of the payload and of the stored form, both read from the media table, and a
    feature string: number of spans, their total time and the first numbers of the tensor. A text's values depend on
    nothing but the text; repeated and null ids are kept as they are; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            for block in b.column(1):
                got = opened(block.as_buffer())
                mean = got.column(2).to_numpy_ndarray().mean(axis=1) + 0.0
                out: list[list] = [[] for _ in types]
                for media, mel, spans in zip(got.column(1).to_pylist(), mel_rows(mean), got.column(3).to_pylist(), strict=True):
                    payload = from_wave(media)
                    feature = f"spans={len(spans)};active={sum(s['end'] - s['start'] for s in spans):.3f};mel={mel}"
                    for column, x in zip(out, (len(payload.rstrip(FILL)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature), strict=True):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([got.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return map_arrow(store(docs), run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows=16)


def mel_rows(mean: np.ndarray) -> list[str]:
    return [",".join(f"{x:.2f}" for x in row) for row in mean]
