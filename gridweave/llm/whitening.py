"""Whitening of vectors by a covariance that is summed in tiles.

An entry c becomes x = floor(1024 * c) + ``SHIFT``.  The covariance of all rows
that take part (see ``vectors``) comes from tiles:

1. Pairs of dimensions are cut into tiles of ``TILE`` x ``TILE``; the pair of
   column blocks is the tile's key.
2. Every batch of at most ``ROWS`` rows is a row block.  Its column blocks (rows x
   ``TILE``) are shuffled by row block, each once, so that all of them meet in one task.
3. That task centres them, multiplies the pairs of every tile and adds the
   products to its own sum of the tile.
4. The tasks' sums are shuffled by tile and added in a fixed order.
5. Tiles are assembled and decomposed on the driver: width x width numbers,
   whatever the number of rows.

Sums of entries are whole numbers and exact.  Memory of a task: one row block and
one set of tiles (width^2 / 2 doubles).  The covariance of the whitened values,
from which ``identity_error`` is read, takes the same road.

Edge cases: a row of a null id is whitened as any other; repeated rows count as
often as they come; of a table without usable rows the result is empty.
Components are as many as asked for or the width, if less.  A component without
variance (eigenvalue at most 1e-12 of the trace) has null as ``whitened`` and no
part in ``identity_error``; if no component has variance, that is null, and
``explained`` too where the trace is 0.  Entries beyond 2^52 stand at it.  A
``deviation`` that fits no long is null.  Of equal eigenvalues any orthonormal
vectors are taken, the same for all rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import partitions

SHIFT = 100_000
TILE = 16
ROWS = 4096
BOUND = 1 << 52
NO_VARIANCE = 1e-12

Cells = Callable[[pa.Array], np.ndarray]


def whole(size: int) -> Cells:
    """The reader of a vector column as x, rows x size longs."""
    return lambda column: vectors.scaled(vectors.matrix(column, size)[1], BOUND) + SHIFT


def sums(df: DataFrame, vector_col: str, size: int) -> tuple[int, list[int]]:
    """(n, exact sums of x by dimension)."""
    read = whole(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            x = read(batch.column(0))
            for a in range(0, len(x), 512):  # 512 times 2^53 fit a long
                total = [t + int(s) for t, s in zip(total, x[a : a + 512].sum(0), strict=True)]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), pa.array([str(v) for v in [n, *total]])], ["dimension", "total"])

    parts = df.select(F.col(vector_col)).mapInArrow(run, "dimension int, total string")
    found = {r.dimension: int(r.total) for r in parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


def covariance(df: DataFrame, vector_col: str, cells: Cells, mean: np.ndarray, n: int) -> np.ndarray:
    """The covariance (divisor n) of what ``cells`` reads from the vectors, centred at ``mean`` before multiplying."""
    size = len(mean)
    blocks = [(a, min(a + TILE, size)) for a in range(0, size, TILE)]
    tasks = partitions(df.sparkSession)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                x = cells(batch.column(0).slice(start, ROWS))
                if len(x):
                    bodies = [np.ascontiguousarray(x[:, a:b], np.float64).tobytes() for a, b in blocks]
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(blocks)), pa.array(range(len(blocks)), pa.int32()), pa.array(bodies, pa.binary())], ["rows", "block", "body"])
                    number += 1

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles: dict[tuple[int, int], np.ndarray] = {}
        at, have = None, []
        for batch in batches:
            for rows, block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if rows != at:
                    at, have = rows, []
                a, b = blocks[block]
                have.append(np.frombuffer(body.as_buffer(), np.float64).reshape(-1, b - a) - mean[a:b])
                for i, left in enumerate(have):  # blocks come in order: the pairs (i, block) with i <= block
                    product = left.T @ have[-1]
                    tiles[i, block] = tiles[i, block] + product if (i, block) in tiles else product
        if tiles:
            keys, task = list(tiles), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in keys], pa.int32()), pa.array([j for _, j in keys], pa.int32()), pa.array([task] * len(keys), pa.int32()), pa.array([tiles[k].tobytes() for k in keys], pa.binary())], ["i", "j", "task", "body"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for i, j, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
                part = np.frombuffer(body.as_buffer(), np.float64)
                if (i, j) == at:
                    total = total + part
                else:
                    if at:
                        yield sent(at, total)
                    at, total = (i, j), part
        if at:
            yield sent(at, total)

    def sent(at: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["i", "j", "body"])

    cut = df.select(F.col(vector_col)).mapInArrow(columns, "rows long, block int, body binary")
    met = cut.repartition(tasks, "rows").sortWithinPartitions("rows", "block").mapInArrow(products, "i int, j int, task int, body binary")
    tiled = met.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "task").mapInArrow(added, "i int, j int, body binary")
    out = np.zeros((size, size))
    for r in tiled.collect():  # width^2 / 2 numbers
        (a, b), (c, d) = blocks[r.i], blocks[r.j]
        tile = np.frombuffer(bytes(r.body), np.float64).reshape(b - a, d - c)
        out[a:b, c:d] = tile
        out[c:d, a:b] = tile.T
    return out / n


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, unit eigenvectors as columns); the greatest entry of each vector is positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return np.maximum(e, 0.0), u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The exact sum over dimensions of (n * x - S)^2 of each row; null beyond a long."""
    rough = float(np.abs(x * float(n) - np.array(total, float)).max(initial=0.0))
    if rough * rough * x.shape[1] < 2.0**62 and n * (float(np.abs(x).max(initial=0)) + 1) < 2.0**62:
        return ((n * x - np.array(total, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable row of df and component."""
    ddl = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    size = vectors.width(df, vector_col)
    if size is None:
        return df.sparkSession.createDataFrame([], ddl)
    n, total = sums(df, vector_col, size)
    read = whole(size)
    mean = np.array([s / n for s in total])
    v = covariance(df, vector_col, read, mean, n)
    e, u = components(v, most)
    trace = float(np.trace(v))
    has = e > NO_VARIANCE * trace
    scale = u[:, has] / np.sqrt(e[has])

    def projected(column: pa.Array) -> np.ndarray:
        return (read(column) - mean) @ scale

    error = None
    if has.any():
        error = float(np.abs(covariance(df, vector_col, projected, np.zeros(int(has.sum())), n) - np.eye(int(has.sum()))).max())
    explained = [float(x) / trace if trace > 0 else None for x in e]
    k = len(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                at, cells = vectors.matrix(part.column(1), size)
                x = vectors.scaled(cells, BOUND) + SHIFT
                out = np.full((len(x), k), np.nan)
                out[:, has] = (x - mean) @ scale
                m = len(x)
                ids = part.column(0).take(pa.array(np.repeat(at, k)))
                repeated = pa.array(deviations(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                values = pa.array(out.ravel(), mask=np.tile(~has, m)) if m else pa.array([], pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), repeated, values, pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return df.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col)).mapInArrow(run, ddl)
