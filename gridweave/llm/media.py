"""Media columns: texts as 8-bit WAV, short-time Fourier transforms, and spectral-peak pair fingerprints.

A payload (UTF-8 bytes, padded with spaces to a positive multiple of ``FRAME``)
is stored as mono 8-bit samples by the ``wave`` module, so that it is lossless.
Features come from the samples read back: Hann-windowed frames of ``FRAME``
samples every ``HOP``, the strongest bin of each band of each frame that is no
weaker than the same bin in the frames beside it, and pairs of such a peak with
the next ``FAN`` peaks of the same text within ``REACH`` frames.  A landmark is
one pair: frame of its first peak << 32 | bin << 20 | other bin << 8 | frames
between.

Edge cases: a null or empty text is one frame of spaces; it has peaks of
strength zero, hence none, and an empty array.  Equal texts have equal values;
repeated rows stay; extra columns are not read.  Memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

FRAME, HOP, RATE = 192, 96, 8000
BANDS = ((1, 13), (13, 37), (37, 97))
FAN, REACH = 3, 8
_WINDOW = np.hanning(FRAME).astype(np.float32)


def store(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def load(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def padded(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // FRAME)) * FRAME, b" ")


def landmarks(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(landmarks of all payloads in order, the payloads' offsets in them)."""
    samples = np.frombuffer(b"".join(payloads), np.uint8).astype(np.float32) - 128
    sizes = np.array([len(p) for p in payloads], np.int64)
    first = np.cumsum(sizes) - sizes
    count = np.maximum(1, (sizes - FRAME) // HOP + 1)
    owner = np.repeat(np.arange(len(payloads)), count)
    frame = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    strength = np.empty((len(owner), FRAME // 2 + 1), np.float32)
    at = first[owner] + frame * HOP
    for a in range(0, len(owner), 4096):
        cut = samples[at[a : a + 4096, None] + np.arange(FRAME)]
        # The mean carries no tone.
        strength[a : a + 4096] = np.abs(np.fft.rfft((cut - cut.mean(1, keepdims=True)) * _WINDOW))
    rows = np.arange(len(owner))
    before, after = np.maximum(rows - 1, 0), np.minimum(rows + 1, len(rows) - 1)
    before[owner[before] != owner] = rows[owner[before] != owner]
    after[owner[after] != owner] = rows[owner[after] != owner]
    peaks = []
    for a, b in BANDS:
        bins = strength[:, a:b].argmax(1) + a
        own = strength[rows, bins]
        keep = (own > 1.0) & (own >= strength[before, bins]) & (own >= strength[after, bins])
        peaks.append(np.stack([rows[keep], bins[keep]], 1))
    found = np.concatenate(peaks)
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    whose, when = owner[found[:, 0]], frame[found[:, 0]]
    pairs, owners = [], []
    for k in range(1, FAN + 1):
        x, y = slice(None, -k), slice(k, None)
        apart = when[y] - when[x]
        good = (whose[x] == whose[y]) & (apart <= REACH)
        pairs.append((when[x] << 32 | found[x, 1] << 20 | found[y, 1] << 8 | apart)[good])
        owners.append(whose[x][good])
    marks, whose = np.concatenate(pairs), np.concatenate(owners)
    order = np.lexsort((marks, whose))
    return marks[order], np.searchsorted(whose[order], np.arange(len(payloads) + 1))


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media binary, landmarks array<long>): no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, "text"):
            texts = [body[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            stored = [store(padded(t)) for t in texts]
            marks, cuts = landmarks([load(m) for m in stored])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(stored, pa.binary()), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(marks))], ["id", "n_bytes", "media", "landmarks"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "id long, n_bytes long, media binary, landmarks array<long>").withColumnRenamed("id", id_col)


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What media columns hold, as sizes and digests of the bytes read back; feature: landmarks, their number and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            marks = batch.column(3)
            cuts = marks.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(marks.values.to_numpy().astype("<i8")).view(np.uint8))
            for media, a, b in zip(batch.column(2), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                stored = media.as_buffer()
                payload = load(stored)
                row = len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{b - a}:{hashlib.blake2b(flat[8 * a : 8 * b], digest_size=16).hexdigest()}"
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, out)], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kept = df.select(F.col(id_col).alias("id"), "n_bytes", "media", "landmarks")
    return kept.mapInArrow(run, "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").withColumnRenamed("id", id_col)
