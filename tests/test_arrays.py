"""Daily array files: round trip, and what a scan opens."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridweave.grid import Grid
from gridweave.sources import arrays

GRID = Grid(0, 0, 1, -1, 4, 3)
DAY = date(2024, 1, 1)


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(DAY + timedelta(d), c, float(d * 100 + c) if c % 5 else None, float(c) if c != 7 else float("nan")) for d in range(6) for c in range(12) if c != 2]
    df = spark.createDataFrame(rows, "day date, cell int, a double, b double")
    at = str(tmp_path / "days")
    assert sorted((str(r.day), r.cells) for r in arrays.write_days(df, GRID, at, ["a", "b"]).collect())[0] == ("2024-01-01", 11)
    assert sorted(os.listdir(at)) == [f"day={DAY + timedelta(d)}.npz" for d in range(6)]
    return at


def test_all_that_was_written_is_read(spark, folder):
    got = {(r.day, r.cell): (r.a, r.b) for r in arrays.read_days(spark, folder).collect()}
    assert len(got) == 66 and got[DAY, 1] == (1.0, 1.0) and got[DAY, 0] == (None, 0.0) and got[DAY + timedelta(2), 7] == (207.0, None)
    only = arrays.read_days(spark, folder, ["a"])
    assert only.columns == ["day", "cell", "a"] and only.count() == 6 * 8
    assert arrays.read_days(spark, folder, ["a", "other"]).where("other is not null").count() == 0


@pytest.mark.parametrize("condition, days", [("day = date'2024-01-02'", [1]), ("day in (date'2024-01-02', date'2024-01-05', date'2030-01-01')", [1, 4]), ("day > date'2024-01-04'", [4, 5]), ("day between date'2024-01-02' and date'2024-01-03' and a > 105", [1, 2]), ("day < date'2020-01-01'", [])])
def test_a_day_filter_opens_only_its_files(spark, folder, condition, days):
    found = arrays.read_days(spark, folder, ["a"]).where(condition)
    opened = {1, 4} if "in (" in condition else set(days) | ({3} if ">" in condition and "2024-01-04" in condition else set())
    for d in set(range(6)) - opened:
        with open(f"{folder}/day={DAY + timedelta(d)}.npz", "wb") as f:
            f.write(b"not an archive")
    assert sorted({(r.day - DAY).days for r in found.collect()}) == days


def test_no_files_and_files_written_again(spark, folder, tmp_path):
    assert arrays.read_days(spark, str(tmp_path / "none")).count() == 0
    one = spark.createDataFrame([(DAY, 3, 9.0, 1.0)], "day date, cell int, a double, b double")
    arrays.write_days(one, GRID, folder, ["a", "b"]).collect()
    assert [(r.cell, r.a) for r in arrays.read_days(spark, folder).where(F.col("day") == F.lit(DAY)).collect()] == [(3, 9.0)]
