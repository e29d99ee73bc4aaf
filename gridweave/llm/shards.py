"""Token-id shards in training order.

Documents become sequences of ``length`` ids (a closing id ends each document,
the last sequence is padded).  Sequences are numbered by the tasks that make
them; a keyed Feistel network, walked along its cycle until the value is below
the number of sequences, permutes the numbers to global slots.  Range partitions
of slots write shards in slot order; every sequence takes the same number of bytes
in its shard, so slot s is in shard s // per_shard at byte (s % per_shard) * stride.

A shard is stored in one of two ways.  :func:`write` makes a table of blocks, one
a shard, whose payload is the shard's bytes (compressed on disk, so that it meets
a budget of disk; :func:`read` goes on from a slot).  :func:`export` writes the
payloads as plain files next to an index, and :func:`fetch` reads a range of slots
by seeking to (s % per_shard) * stride.

Tokens are made once, kept in the shared folder with their numbers (a task that
is repeated replaces its own rows), and shuffled once.  A task holds one shard.

Edge cases: null and empty texts are the closing id alone; very long texts are as
many sequences as they need (memory follows the longest one); repeated rows are
sequences of their own; a null id is kept; an empty table gives no shards; extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from .common import partitions, removed, scratch
from .tokens import encoded, vocabulary

LENGTH = 512
PER_SHARD = 4096
ROUNDS = 6


def permuted(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size-1 for each value of x."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = tv.mix(np.uint64(key & (1 << 64) - 1) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & low
        for k in keys:
            left, right = right, left ^ (tv.mix(right + k) & low)
        return left << np.uint64(half) | right

    with np.errstate(over="ignore"):
        out = once(x.astype(np.uint64))
        while (over := out >= np.uint64(size)).any():
            out[over] = once(out[over])
    return out.astype(np.int64)


def width(path: str) -> np.dtype:
    """The unsigned little-endian type that holds all ids of a tokenizer file."""
    return np.dtype("<u2" if len(vocabulary(path)[0]) <= 1 << 16 else "<u4")


def sequences(df: DataFrame, path: str, length: int, id_col: str, text_col: str) -> DataFrame:
    """(task, number, doc_id, part, n_tokens, ids binary): numbers count up from 0 in each task."""
    kind = width(path)
    closing = max(vocabulary(path)[2].values(), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for rows, ids, cuts in encoded(batches, path):
            of, part, size, stored = [], [], [], []
            ids = ids.astype(kind)
            for row, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                own = np.append(ids[a:b], kind.type(closing))
                for k in range(0, len(own), length):
                    cut = own[k : k + length]
                    of.append(row)
                    part.append(k // length)
                    size.append(len(cut))
                    stored.append(cut.tobytes())
            number = np.arange(made, made + len(of))
            made += len(of)
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(of), pa.int32()), pa.array(number), rows.column(0).take(pa.array(of, pa.int64())), pa.array(part, pa.int32()), pa.array(size, pa.int32()), pa.array(stored, pa.binary())], ["task", "number", "doc_id", "part", "n_tokens", "ids"])

    kept = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "task int, number long, doc_id long, part int, n_tokens int, ids binary")


def write(df: DataFrame, path: str, to: str, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Writes the shards of df's texts as a table of blocks at ``to`` and returns the number of sequences.

    A block has shard, first_slot, n, stride, id_bytes, payload (n * stride bytes of ids,
    padded with the closing id) and, in slot order, doc_ids, parts and sizes.
    """
    spark = df.sparkSession
    staged = scratch(spark, "sequences")
    sequences(df, path, length, id_col, text_col).write.option("compression", "zstd").parquet(staged)
    held = spark.read.schema("task int, number long, doc_id long, part int, n_tokens int, ids binary").parquet(staged)
    # One number a task reaches the driver.
    per_task = {r.task: r.n for r in held.groupBy("task").agg(F.count("*").alias("n")).collect()}
    base = np.zeros(max(per_task, default=-1) + 1, np.int64)
    total = 0
    for task in sorted(per_task):
        base[task] = total
        total += per_task[task]
    kind = width(path)
    closing = max(vocabulary(path)[2].values(), default=0)
    stride = length * kind.itemsize

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = permuted(base[batch.column(0).to_numpy()] + batch.column(1).to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot // per_shard), pa.array(slot), *batch.columns[2:]], ["shard", "slot", "doc_id", "part", "n_tokens", "ids"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, rows, body = None, 0, [], bytearray()
        blank = np.full(length, closing, kind).tobytes()

        def done() -> pa.RecordBatch:
            ids, parts, sizes = zip(*rows, strict=True)
            values = [pa.array([x], pa.int64()) for x in (shard, first, len(rows), stride, kind.itemsize)]
            lists = [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(parts)], pa.list_(pa.int32())), pa.array([list(sizes)], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([*values, pa.array([bytes(body)], pa.binary()), *lists], ["shard", "first_slot", "n", "stride", "id_bytes", "payload", "doc_ids", "parts", "sizes"])

        for batch in batches:
            for s, slot, doc_id, part, n, ids in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if s != shard:
                    if rows:
                        yield done()
                    shard, first, rows, body = s, slot, [], bytearray()
                rows.append((doc_id, part, n))
                body += ids + blank[len(ids) :]
        if rows:
            yield done()

    placed = held.mapInArrow(slots, "shard long, slot long, doc_id long, part int, n_tokens int, ids binary")
    dealt = placed.repartitionByRange(max(1, min(partitions(spark), -(-total // per_shard))), "shard").sortWithinPartitions("slot")
    out = dealt.mapInArrow(blocks, "shard long, first_slot long, n long, stride long, id_bytes long, payload binary, doc_ids array<long>, parts array<int>, sizes array<int>")
    out.write.mode("overwrite").option("compression", "zstd").parquet(to)
    removed(spark, staged)
    return total


_READ = "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, ids binary"


def _rows(shard: int, begin: int, stride: int, picked: range, doc_ids: list, parts: list, sizes: list, ids: list) -> pa.RecordBatch:
    columns = [
        pa.array([begin + i for i in picked], pa.int64()),
        pa.array([shard] * len(picked), pa.int64()),
        pa.array([i * stride for i in picked], pa.int64()),
        pa.array([doc_ids[i] for i in picked], pa.int64()),
        pa.array([parts[i] for i in picked], pa.int32()),
        pa.array([sizes[i] for i in picked], pa.int32()),
        pa.array(ids, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["slot", "shard", "byte_offset", "doc_id", "part", "n_tokens", "ids"])


def _between(table: DataFrame, first: int, last: int | None) -> DataFrame:
    """Shards with slots first..last-1; others are not read."""
    table = table.where(F.col("first_slot") + F.col("n") > first)
    return table if last is None else table.where(F.col("first_slot") < last)


def read(spark: SparkSession, at: str, first: int = 0, last: int | None = None) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, part, n_tokens, ids binary) of slots first..last-1; shards outside are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, begin, n, stride, unit, doc_ids, parts, sizes, payload in zip(*(batch.column(i).to_pylist() for i in range(8)), batch.column(8), strict=True):
                data = payload.as_buffer()
                picked = range(max(0, first - begin), n if last is None else min(n, last - begin))
                ids = [data[i * stride : i * stride + sizes[i] * unit].to_pybytes() for i in picked]
                yield _rows(shard, begin, stride, picked, doc_ids, parts, sizes, ids)

    table = _between(spark.read.parquet(at), first, last)
    return table.select("shard", "first_slot", "n", "stride", "id_bytes", "doc_ids", "parts", "sizes", "payload").mapInArrow(run, _READ)


def _store(at: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that tasks write to: local, or one that pyarrow has a client of."""
    return fs.FileSystem.from_uri(at) if "://" in at or at.startswith("file:") else (fs.LocalFileSystem(), at)


def file_of(at: str, shard: int) -> str:
    return f"{at}/shard-{shard:010d}.bin"


def export(spark: SparkSession, at: str, to: str) -> None:
    """Every block of the table at ``at`` as a plain file of ``to``, n * stride bytes, and their index as a table ``index``.

    A file appears whole or not at all, and a task that is repeated writes the same one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(to)
        store.create_dir(top, recursive=True)
        for batch in batches:
            for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = f"{top}/.{shard}-{uuid.uuid4().hex}"
                with store.open_output_stream(own) as f:
                    f.write(payload.as_buffer())
                store.move(own, file_of(top, shard))
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:]], ["shard", "first_slot", "n", "stride", "id_bytes", "doc_ids", "parts", "sizes"])

    table = spark.read.parquet(at).select("shard", "payload", "first_slot", "n", "stride", "id_bytes", "doc_ids", "parts", "sizes")
    index = table.mapInArrow(run, "shard long, first_slot long, n long, stride long, id_bytes long, doc_ids array<long>, parts array<int>, sizes array<int>")
    index.write.mode("overwrite").parquet(f"{to}/index")


def fetch(spark: SparkSession, at: str, first: int = 0, last: int | None = None) -> DataFrame:
    """As :func:`read`, from exported files: only the bytes of slots first..last-1 are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(at)
        for batch in batches:
            for shard, begin, n, stride, unit, doc_ids, parts, sizes in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                a, b = max(0, first - begin), n if last is None else min(n, last - begin)
                with store.open_input_file(file_of(top, shard)) as f:
                    f.seek(a * stride)
                    data = f.read((b - a) * stride)
                ids = [data[(i - a) * stride : (i - a) * stride + sizes[i] * unit] for i in range(a, b)]
                yield _rows(shard, begin, stride, range(a, b), doc_ids, parts, sizes, ids)

    table = _between(spark.read.parquet(f"{at}/index"), first, last)
    return table.select("shard", "first_slot", "n", "stride", "id_bytes", "doc_ids", "parts", "sizes").mapInArrow(run, _READ)
