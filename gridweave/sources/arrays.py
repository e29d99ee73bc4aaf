"""Daily array files as a table: one file a day, an array a variable over the whole grid.

A file is a NumPy archive, ``day=YYYY-MM-DD.npz``, whose members can be read one
by one.  The format ``day_arrays`` reads a folder of them as (day, cell,
variables...): a partition is one day, a schema with fewer variables reads fewer
members, and filters on the day leave out files before any is opened.  Paths are
of any file system that Arrow opens.

Edge cases: a cell whose variables are all missing in a file has no row; NaN is
missing; a folder without files, or without those asked for, has no rows; a file
that lacks a variable has it missing.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..grid import Grid

ROWS = 65536


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(path if path.startswith("file:") else f"file://{path}")


def write_days(df: DataFrame, grid: Grid, path: str, variables: list[str]) -> DataFrame:
    """(day, cells): writes a file for each day of df (day, cell, variables), over one that is there; nothing is written before the result is read.

    A task holds one day's grid.  A file gets its name when it is whole, so a task
    that runs twice writes it twice.
    """

    def write(table: pa.Table) -> pa.Table:
        day, cell = table.column("day")[0].as_py(), table.column("cell").to_numpy()
        out = {}
        for v in variables:
            out[v] = np.full(grid.nx * grid.ny, np.nan)
            out[v][cell] = table.column(v).to_numpy(zero_copy_only=False).astype(float)
        body = io.BytesIO()
        np.savez(body, **out)
        store, at = opened(path)
        store.create_dir(at, recursive=True)
        with store.open_output_stream(draft := f"{at}/.{uuid.uuid4().hex}") as f:
            f.write(body.getbuffer())
        store.move(draft, f"{at}/day={day}.npz")
        return pa.table({"day": pa.array([day], pa.date32()), "cells": pa.array([len(cell)], pa.int64())})

    kept = df.select("day", F.col("cell").cast("int").alias("cell"), *[F.col(v).cast("double").alias(v) for v in variables])
    return kept.groupBy("day").applyInArrow(write, "day date, cells long")


class Day(InputPartition):
    def __init__(self, day: date, path: str) -> None:
        self.day, self.path = day, path


class DayReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema
        self.first, self.last, self.days = date.min, date.max, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("day",) or not isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                yield f
            elif isinstance(f, EqualTo | In):
                asked = set(f.value if isinstance(f, In) else [f.value])
                self.days = asked if self.days is None else self.days & asked
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.first = max(self.first, f.value)
                yield from [f] if isinstance(f, GreaterThan) else []  # the day itself is left to Spark
            else:
                self.last = min(self.last, f.value)
                yield from [f] if isinstance(f, LessThan) else []

    def partitions(self) -> list[InputPartition]:
        store, at = opened(self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if info.base_name.startswith("day=") and info.base_name.endswith(".npz"):
                day = date.fromisoformat(info.base_name[4:-4])
                if self.first <= day <= self.last and (self.days is None or day in self.days):
                    found.append(Day(day, info.path))
        return sorted(found, key=lambda d: d.day)

    def read(self, partition: Day) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file is asked for
            return
        names = [f.name for f in self.schema if f.name not in ("day", "cell")]
        store, _ = opened(self.path)
        with store.open_input_file(partition.path) as f, np.load(f) as members:
            held = {n: members[n] for n in names if n in members.files}
            probe = held or {n: members[n] for n in members.files[:1]}
        size = len(next(iter(probe.values()))) if probe else 0
        here = np.zeros(size, bool)
        for x in probe.values():
            here |= ~np.isnan(x)
        cells = np.flatnonzero(here).astype(np.int32)
        for a in range(0, len(cells), ROWS):
            c = cells[a : a + ROWS]
            columns = []
            for f in self.schema:
                if f.name == "day":
                    columns.append(pa.array([partition.day] * len(c), pa.date32()))
                elif f.name == "cell":
                    columns.append(pa.array(c))
                else:
                    x = held[f.name][c] if f.name in held else np.full(len(c), np.nan)
                    columns.append(pa.array(x, mask=np.isnan(x)))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in self.schema])


class DayArrays(DataSource):
    """``spark.read.format("day_arrays").load(path)``; all variables without a schema, those of the newest file."""

    @classmethod
    def name(cls) -> str:
        return "day_arrays"

    def schema(self) -> str:
        newest = DayReader(self.options["path"], StructType()).partitions()[-1:]
        if not newest:
            return "day date, cell int"
        store, _ = opened(self.options["path"])
        with store.open_input_file(newest[0].path) as f, np.load(f) as members:
            return ", ".join(["day date", "cell int", *(f"`{n}` double" for n in members.files)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return DayReader(self.options["path"], schema)


def read_days(spark: SparkSession, path: str, variables: list[str] | None = None) -> DataFrame:
    """The folder as a table; only the variables asked for are read, and only the files of days that a filter asks for."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DayArrays)
    reader = spark.read.format("day_arrays")
    if variables is not None:
        reader = reader.schema(", ".join(["day date", "cell int", *(f"`{v}` double" for v in variables)]))
    return reader.load(path)
