"""Versions of a table: readers keep theirs, columns are replaced alone, crashes leave nothing."""

import os

import pytest
from pyspark.sql import functions as F

from gridweave.sources.snapshots import Conflict, Snapshots


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    assert s.create(spark.createDataFrame([(d, c, 10.0 * d + c, "x") for d in (1, 2) for c in (0, 1)], "day int, cell int, a double, b string"), ["day", "cell"]) == 1
    return s


def test_a_reader_keeps_its_version_while_a_column_is_replaced(spark, store):
    old = store.read()
    assert store.put(store.read(["a"]).withColumns({"a": -F.col("a"), "c": F.col("a") * 2})) == 2
    assert rows(old) == rows(store.read(version=1)) == [(1, 0, 10.0, "x"), (1, 1, 11.0, "x"), (2, 0, 20.0, "x"), (2, 1, 21.0, "x")]
    new = store.read()
    assert new.columns == ["day", "cell", "a", "b", "c"] and rows(new)[0] == (1, 0, -10.0, "x", 20.0)
    m1, m2 = store.manifest(1)["columns"], store.manifest(2)["columns"]
    assert m1["b"] == m2["b"] and m1["a"] != m2["a"] and m2["a"] == m2["c"]
    only = store.read(["b"])  # opens the one folder that holds it
    assert only.columns == ["day", "cell", "b"] and all(m1["b"][0] in f for f in only.inputFiles())
    with pytest.raises(FileNotFoundError):
        store.read(version=9)


def test_rows_are_appended_with_all_columns(spark, store):
    store.put(store.read(["a"]).select("day", "cell", (F.col("a") + 1).alias("a")))
    with pytest.raises(ValueError, match="b"):
        store.append(store.read(["a"]))
    assert store.append(spark.createDataFrame([(3, 0, "y", 5)], "day int, cell int, b string, a int")) == 3
    assert rows(store.read())[-1] == (3, 0, 5.0, "y") and store.read().count() == 5 and store.read(version=2).count() == 4
    gone = store.vacuum(1)
    assert len(gone) == 0 and store.versions() == [3] and store.read().count() == 5


def test_a_crash_before_the_manifest_changes_nothing(spark, store, monkeypatch):
    before = rows(store.read())
    monkeypatch.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.put(store.read(["a"]).select("day", "cell", F.lit(0.0).alias("a")))
    monkeypatch.undo()
    assert store.versions() == [1] and rows(store.read()) == before
    assert len(store.vacuum()) == 1 and rows(store.read()) == before


def test_writers_do_not_overwrite_each_other(spark, store):
    other = Snapshots(spark, store.path)
    change = store.read(["a"]).select("day", "cell", F.lit(0.0).alias("a"))
    other.put(change)
    with pytest.raises(Conflict, match="newer"):
        store.put(change, base=1)
    # A writer that claimed its number and went away holds others up, until its claim is stale.
    store._fs.createNewFile(store._at("claims/3"))
    with pytest.raises(Conflict, match="being written"):
        store.put(change)
    store.stale = 0.0
    assert store.put(change) == 4 and store.versions() == [1, 2, 4]
    assert not [f for f in os.listdir(f"{store.path}/manifests") if not f.endswith(".json") and not f.endswith(".crc")]


def test_columns_in_buckets_are_joined_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        s = Snapshots(spark, str(tmp_path / "it's"))
        days = spark.range(300).select((F.col("id") % 30).cast("int").alias("day"), (F.col("id") / 30).cast("int").alias("cell"), F.col("id").cast("double").alias("a"), F.lit("x").alias("b"))
        s.create(days, ["day", "cell"], buckets=3)
        old = s.read(["a"])
        s.put(s.read(["a"]).withColumn("a", (-F.col("a")).cast("string")))  # of another type than before
        put = s.put(s.read(["b"]).select("day", "cell", F.lit(5).alias("d")))
        new = s.read()
        both = new.join(old.withColumnRenamed("a", "before"), ["day", "cell"])
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        assert rows(both) == sorted((k % 30, k // 30, str(-float(k)), "x", 5, float(k)) for k in range(300))
        # Rows that are appended are read with the others, as plain files, and a column that is replaced after them holds all.
        s.append(spark.createDataFrame([(99, 0, "9.0", "y", 6)], "day int, cell int, a string, b string, d int"))
        s.put(s.read(["d"]).withColumn("d", F.col("d") * 2))
        assert rows(s.read())[-2:] == [(29, 9, "-299.0", "x", 10), (99, 0, "9.0", "y", 12)] and s.read().count() == 301
        # Another session, whose catalog has no name of it, reads the same.
        for t in spark.catalog.listTables(pattern="snapshot_*"):
            spark.sql(f"DROP TABLE {t.name}")
        assert rows(Snapshots(spark, s.path).read()) == rows(s.read()) and rows(s.read(version=put)) == rows(new)
        assert len(s.vacuum()) == 1 and s.read().count() == 301
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_empty_table_in_buckets(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    s.create(spark.createDataFrame([], "day int, cell int, a double"), ["day", "cell"], buckets=2)
    s.put(s.read(["a"]).withColumn("c", F.col("a") + 1))
    assert s.read().columns == ["day", "cell", "a", "c"] and s.read().count() == 0
