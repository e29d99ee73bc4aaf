"""Sinks: partitioned tables that are appended, replaced by day, checked before and announced after."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="gridweave-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def replace_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Writes df's days over the table's, leaving other days; one commit."""
    df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def _folder(spark: SparkSession, path: str):
    """(the file system, a path of it)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def append_new(df: DataFrame, path: str, day: str = "day", gate: list[str] | None = None) -> DataFrame:
    """Appends days that the table does not have and returns them; a second call appends nothing.

    df is computed once: its days are written where no reader looks, and each is
    renamed into the table.  With ``gate``, the written columns that must have a
    finite value are counted before that, and without one nothing is appended and the
    columns are named in an error.  (Observed metrics would count while writing, but
    after one of them the session of Spark 4.1.2 refuses models whose functions hold it.)
    """
    spark = df.sparkSession
    kind = df.schema[day].dataType
    if exists(spark, path):
        have = spark.read.parquet(path).select(F.col(day).cast(kind).alias(day)).distinct()
        df = df.join(F.broadcast(have), day, "left_anti")
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    df.repartition(day).write.partitionBy(day).parquet(draft)
    store, at = _folder(spark, draft)
    try:
        entries = [e for e in store.listStatus(at) if e.getPath().getName().startswith(f"{day}=")]
        if gate and entries:
            quality_gate(spark.read.schema(df.schema).parquet(*[e.getPath().toString() for e in entries]), gate)
        added = []
        for entry in entries:
            name = entry.getPath().getName()
            if store.rename(entry.getPath(), _folder(spark, f"{path}/{name}")[1]):
                added.append((name.partition("=")[2],))
    finally:
        store.delete(at, True)
    return spark.createDataFrame(sorted(added), f"`{day}` string").select(F.col(day).cast(kind).alias(day))


def finite(c: str) -> Column:
    """How many finite values a column has."""
    return F.count(F.when(F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf")), 1))


def quality_gate(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error naming the columns that have no finite value."""
    row = df.agg(*[finite(c).alias(c) for c in columns]).first()
    if empty := [c for c in columns if not row[c]]:
        raise ValueError(f"no finite value in {', '.join(empty)}")
    return df


def with_column(df: DataFrame, name: str, value: Column, replace: bool = False) -> DataFrame:
    """Adds a variable; one that is there stays unless it is to be replaced."""
    return df.withColumn(name, value) if replace or name not in df.columns else df


def static_layers(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row a cell of the columns that do not change by day."""
    return df.groupBy("cell").agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])


def narrowed(df: DataFrame) -> DataFrame:
    """Doubles as floats."""
    return df.select(*[F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def relaid(df: DataFrame, files: int, by: list[str], sort: list[str]) -> DataFrame:
    """Another physical layout: rows of a key together and sorted, so that scans skip row groups."""
    return df.repartition(files, *by).sortWithinPartitions(*sort)


def bucketed(df: DataFrame, table: str, path: str, buckets: int, by: list[str], sort: list[str]) -> DataFrame:
    """df as a table in ``buckets`` by key, sorted within: joins and windows by the key shuffle none of it.

    Joins of two such tables need the same number of buckets; joins by further columns too (a day) keep to the buckets
    in sessions with ``spark.sql.requireAllClusterKeysForCoPartition`` off.
    """
    spark = df.sparkSession
    df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*sort).option("path", path).saveAsTable(table)
    return spark.table(table)


def stacked(df: DataFrame, features: list[str], stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(day, cell, x array<float>): features standardised and in order, missing ones at their mean."""
    return df.select("day", "cell", F.array(*[F.coalesce((F.col(f) - stats[f][0]) / stats[f][1], F.lit(0.0)).cast("float") for f in features]).alias("x"))


def publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Writes the manifest, a single small file, after the data that it names."""
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, path: str) -> dict | None:
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect())) if exists(spark, path) else None


def manifest_if_newer(spark: SparkSession, path: str, seen: str | None, version: str = "version") -> dict | None:
    """The manifest if its version differs from the one seen last; nothing otherwise."""
    found = manifest(spark, path)
    return found if found is not None and found.get(version) != seen else None
