"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a text's run between line feeds (an empty text has one empty
paragraph).  Each paragraph is hashed to a wide vector of two sections, and a
document's state is the sum of its paragraphs' vectors:

* ``LANES`` lanes modulo 2**64, drawn from the paragraph's 128-bit BLAKE2b
  digest.  Equal multisets of paragraphs have equal sums in any order; different
  ones have equal sums only by collision.
* ``SKETCH`` lanes modulo 2**16, a count sketch of the paragraph's word
  triples.  Its inner products estimate how much two documents share, so that
  near copies have near states.

Sums are taken modulo powers of two, so a paragraph is inserted or deleted in
constant time without the rest of the text (:func:`insert`, :func:`delete`).

Edge cases: a null text is an empty text; a null id comes before all others in
the order of documents, and rows of one id are ordered by their text.  Repeated
rows are rows of their own.  Extra columns are not read.  An empty table gives
an empty result.  Paragraphs' vectors are summed in slices, so memory follows the
longest text (about 40 bytes for each of its bytes), whatever its paragraphs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import partitions, slices

LANES = 64
SKETCH = 512
TRIPLE = 3
STATE_BYTES = 8 * LANES + 2 * SKETCH
#: Paragraphs whose vectors are held at once.
PARAGRAPHS = 4096
_STEPS = np.random.default_rng(71).integers(1, 1 << 63, LANES, dtype=np.uint64) | np.uint64(1)


def states(offsets: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x LANES of uint64, rows x SKETCH of uint16) for UTF-8 texts."""
    n = len(offsets) - 1
    if not n:
        return np.zeros((0, LANES), np.uint64), np.zeros((0, SKETCH), np.uint16)
    feeds = np.flatnonzero(body == 10)
    lanes = _lanes(offsets, body, feeds)
    words, row, at = tv.words(body, offsets)
    # Word runs do not cross paragraphs; those with words are numbered.
    new = np.diff(np.searchsorted(feeds, at) + row, prepend=-1) != 0
    paragraph = np.cumsum(new) - 1
    runs, of = tv.shingles(words, paragraph, int(new.sum()), TRIPLE)
    sign = np.where(runs >> np.uint64(63), 1.0, -1.0)
    cell = row[new][of] * SKETCH + (runs % np.uint64(SKETCH)).astype(np.int64)
    sketch = np.bincount(cell, weights=sign, minlength=n * SKETCH).astype(np.int64).astype(np.uint16)
    return lanes, sketch.reshape(n, SKETCH)


def _lanes(offsets: np.ndarray, body: np.ndarray, feeds: np.ndarray) -> np.ndarray:
    """Sums of the paragraphs' wide vectors, row by row, in slices of ``PARAGRAPHS``."""
    n = len(offsets) - 1
    out = np.zeros((n, LANES), np.uint64)
    view = memoryview(np.ascontiguousarray(body))
    # A row's first paragraph and those after its line feeds.
    before = np.searchsorted(feeds, offsets) + np.arange(n + 1)
    for a in range(0, int(before[-1]), PARAGRAPHS):
        number = np.arange(a, min(a + PARAGRAPHS, int(before[-1])))
        row = np.searchsorted(before, number, "right") - 1
        first = number == before[row]
        last = number == before[row + 1] - 1
        none = not len(feeds)
        starts = np.where(first, offsets[row], 0 if none else feeds[np.maximum(number - row - 1, 0)] + 1)
        ends = np.where(last, offsets[row + 1], 0 if none else feeds[np.minimum(number - row, len(feeds) - 1)])
        digests = b"".join([hashlib.blake2b(view[x:y], digest_size=16).digest() for x, y in zip(starts.tolist(), ends.tolist(), strict=True)])
        seeds = np.frombuffer(digests, "<u8").reshape(-1, 2)
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        with np.errstate(over="ignore"):
            out[row[begin]] += np.add.reduceat(tv.mix(tv.mix(seeds[:, :1] + _STEPS) ^ (seeds[:, 1:] * _STEPS)), begin, axis=0)
    return out


def pack(lanes: np.ndarray, sketch: np.ndarray) -> list[bytes]:
    joined = np.concatenate([lanes.astype("<u8").view(np.uint8), sketch.astype("<u2").view(np.uint8)], axis=1)
    return [row.tobytes() for row in joined]


def unpack(state: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(state, "<u8", LANES), np.frombuffer(state, "<u2", SKETCH, 8 * LANES)


def _of(paragraphs: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    kept = [p for x in paragraphs for p in x.split("\n")]
    lanes, sketch = states(*tv.utf8(pa.array(kept, pa.string())))
    with np.errstate(over="ignore"):
        return lanes.sum(0, dtype=np.uint64), sketch.sum(0, dtype=np.uint16)


def insert(state: bytes, paragraphs: Iterable[str]) -> bytes:
    """The state after paragraphs are added, from the state alone."""
    (a, b), (c, d) = unpack(state), _of(paragraphs)
    with np.errstate(over="ignore"):
        return pack((a + c)[None], (b + d)[None])[0]


def delete(state: bytes, paragraphs: Iterable[str]) -> bytes:
    """The state after paragraphs are taken away, from the state alone."""
    (a, b), (c, d) = unpack(state), _of(paragraphs)
    with np.errstate(over="ignore"):
        return pack((a - c)[None], (b - d)[None])[0]


def digest(state: bytes) -> str:
    return hashlib.sha256(state).hexdigest()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosine of the sketches row by row, cut to 0..1; 1 where the states are equal."""
    x, y = (s[1].view(np.int16).astype(np.float64) for s in (a, b))
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.clip((x * y).sum(1) / np.where(norm > 0, norm, 1), 0, 1)
    return np.where((a[0] == b[0]).all(1) & (a[1] == b[1]).all(1), 1.0, cosine)


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, state binary, fingerprint): one row for each row of df; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, body in slices(batches, "text"):
            packed = pack(*states(offsets, body))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(packed, pa.binary()), pa.array([digest(x) for x in packed])], ["id", "state", "fingerprint"])

    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "id long, state binary, fingerprint string").withColumnRenamed("id", id_col)


def with_next(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(bucket, halo, id, text), in order within partitions: each bucket is a range of ids, followed by the first row of the next range.

    Buckets are cut at approximate percentiles and their least ids are taken
    exactly; only those rows are sent twice.  The last range is followed by the
    first one's head.  n ids reach the driver; rows of one id are in one bucket.
    """
    kept = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = kept.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], max(10_000, 10 * n))).first()[0] if n > 1 else None
    kept = kept.withColumn("bucket", F.lit(0))
    # Bucketizer reads doubles: any function of the id that does not fall will do for the ranges.
    if splits := sorted({float(x) for x in cuts or []}):
        cut = Bucketizer(splits=[-float("inf"), *splits, float("inf")], inputCol="at", outputCol="range", handleInvalid="keep")
        kept = cut.transform(kept.withColumn("at", F.col("key").cast("double"))).withColumn("bucket", F.col("range").cast("int"))
    heads = {r.bucket: r.head for r in kept.groupBy("bucket").agg(F.min("key").alias("head")).collect()}
    if not heads:
        return kept.select("bucket", F.lit(False).alias("halo"), "id", "text")
    order = sorted(heads)
    size = order[-1] + 1
    head = F.element_at(F.array(*[F.lit(heads.get(b)).cast("long") for b in range(size)]), F.col("bucket") + 1)
    previous = {b: order[i - 1] for i, b in enumerate(order)}
    before = F.element_at(F.array(*[F.lit(previous.get(b, 0)) for b in range(size)]), F.col("bucket") + 1)
    own = F.struct(F.col("bucket"), F.lit(False).alias("halo"))
    places = F.when(F.col("key") == head, F.array(own, F.struct(before.alias("bucket"), F.lit(True).alias("halo")))).otherwise(F.array(own))
    placed = kept.select(F.explode(places).alias("place"), "key", "id", "text").select("place.bucket", "place.halo", "key", "id", "text")
    return placed.repartition(partitions(df.sparkSession), "bucket").sortWithinPartitions("bucket", "halo", "key", "text").select("bucket", "halo", "id", "text")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, whose second half comes from the next document in id order.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  One shuffle, by ranges of ids; a task holds one
    block of texts at a time.
    """

    def finished(pairs: list[tuple]) -> pa.RecordBatch:
        ids, texts, following = zip(*pairs, strict=True)
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, following, strict=True)]
        own, new, after = (states(*tv.utf8(pa.array(x, pa.large_string()))) for x in (texts, edited, following))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([digest(x) for x in pack(*own)]),
                pa.array([digest(x) for x in pack(*new)]),
                pa.array(likeness(own, new)),
                pa.array(likeness(own, after)),
            ],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for rows, _, _ in slices(batches, "text"):
            pairs = []
            for bucket, halo, key, text in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
                if waiting is not None and waiting[0] == bucket and not waiting[1]:
                    pairs.append((waiting[2], waiting[3], text))
                waiting = (bucket, halo, key, text)
            if pairs:
                yield finished(pairs)

    placed = with_next(df, id_col, text_col, 4 * partitions(df.sparkSession))
    out = placed.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
