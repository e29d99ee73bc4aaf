"""Gates, appends that leave nothing, tables in buckets, locks, headers by file."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridweave.plans import maintain
from gridweave.sources import readers, sinks


def days(spark, *rows):
    return spark.createDataFrame([(date(2024, 1, d), c, v) for d, c, v in rows], "day date, cell int, x double")


def test_failing_data_leave_no_partition(spark, tmp_path):
    at = str(tmp_path / "t")
    assert [r.day for r in sinks.append_new(days(spark, (1, 0, 1.0)), at, gate=["x"]).collect()] == [date(2024, 1, 1)]
    bad = days(spark, (2, 0, None), (3, 0, float("nan")), (3, 1, float("inf")))
    with pytest.raises(ValueError, match="x"):
        sinks.append_new(bad, at, gate=["x"])
    assert sorted(n for n in os.listdir(at) if not n.startswith((".", "_SUCCESS"))) == ["day=2024-01-01"]
    assert [r.day for r in sinks.append_new(bad, at).orderBy("day").collect()] == [date(2024, 1, 2), date(2024, 1, 3)]
    assert sinks.append_new(bad, at, gate=["x"]).count() == 0 and spark.read.parquet(at).count() == 4


def test_appended_rows_are_computed_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        runs.add(1)
        yield from batches

    df = days(spark, (1, 0, 1.0), (2, 0, 2.0)).coalesce(1)
    sinks.append_new(df.mapInArrow(seen, df.schema), str(tmp_path / "t"), gate=["x"]).collect()
    assert runs.value == 1


def test_bucketed_layout_shuffles_nothing(spark, small):
    settings = ("spark.sql.adaptive.enabled", "spark.sql.requireAllClusterKeysForCoPartition")
    before = {k: spark.conf.get(k) for k in settings}
    for k in settings:
        spark.conf.set(k, "false")
    try:
        plan = entry.queries()["bucketed_layout"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "Window" in plan and plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan


def test_a_stale_lock_is_taken_over_once(spark, tmp_path):
    at = str(tmp_path / "lock")
    lost, one, two = (maintain.RunLock(spark, at, stale=180.0) for _ in range(3))
    assert lost.claim()
    os.utime(at, (0, 0))
    # Both see it stale; the first takes over, and the second finds a fresh one in its place.
    age, two.age = one.age(), lambda: 10_000.0
    assert age > 180 and one.claim() and not two.claim() and one.age() < 1
    one.release()
    assert not two.store.exists(two.at) and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == []


def test_each_file_has_a_header_of_its_own(spark, tmp_path):
    at = tmp_path / "feed"
    at.mkdir()
    (at / "a.csv").write_text("latitude,longitude,acq_date,confidence\n40.0,-3.0,2024-01-01,h\nbroken,line,x,y\n")
    (at / "b.csv").write_text("acq_date,Longitude,latitude,extra\n2024-01-02,-4.5,41.5,z\n")
    got = {str(r.acq_date): (r.latitude, r.longitude, r.confidence) for r in readers.detections(spark, str(at)).collect()}
    assert got == {"2024-01-01": (40.0, -3.0, "h"), "2024-01-02": (41.5, -4.5, None)} and readers.refused(spark, str(at)).count() == 1
    (at / "c.csv").write_text("Invalid MAP_KEY.\n")
    with pytest.raises(ValueError, match="Invalid MAP_KEY"):
        readers.detections(spark, str(at))
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text("latitude,longitude,acq_date\n")
    assert readers.detections(spark, str(empty)).where(F.col("latitude").isNotNull()).count() == 0
