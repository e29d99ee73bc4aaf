"""Vectors as matrices: which rows take part, and how a batch becomes numbers.

A row takes part if its vector is not null, has no null, NaN or infinite entry
and has the table's width: the most frequent length among such vectors (the
longer one of two equally frequent).  Rows of another length have no place in a
matrix and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their lengths, all entries as doubles) of a list column; the entries are those of usable rows only."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(column)
    cells = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    at = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    bad = np.zeros(len(lengths), bool)
    bad[at[~np.isfinite(cells)]] = True
    usable = (lengths >= 0) & ~bad
    return usable, lengths, cells[usable[at]] if len(at) else cells


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows that take part, rows x width)."""
    usable, lengths, cells = lists(column)
    fits = lengths[usable] == width
    if not fits.all():
        cells = cells[np.repeat(fits, lengths[usable])]
    return np.flatnonzero(usable)[fits], cells.reshape(-1, width)


def scaled(cells: np.ndarray, bound: int) -> np.ndarray:
    """floor(1024 * c) as longs; what lies beyond ``bound`` stands at it, so that sums of products stay exact."""
    return np.clip(np.floor(cells * 1024), -bound, bound).astype(np.int64)


def width(df: DataFrame, vector_col: str) -> int | None:
    """The most frequent length of vectors without missing or non-finite entries; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            usable, lengths, _ = lists(batch.column(0))
            for size, n in zip(*np.unique(lengths[usable], return_counts=True), strict=True):
                found[int(size)] = found.get(int(size), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["length", "n"])

    counts = df.select(F.col(vector_col)).mapInArrow(run, "length long, n long").where("length > 0").groupBy("length").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), F.desc("length")).first()
    return int(top.length) if top else None
