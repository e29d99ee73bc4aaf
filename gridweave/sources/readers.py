"""Sources: cubes, bronze days, detections, hourly payloads, vintages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.nulls import nan_to_null
from ..functions.projection import geostationary_inverse

DETECTIONS = "latitude double, longitude double, acq_date date, confidence string"
#: Longest gap between byte ranges that are read as one.
NEAR_BYTES = 0


def cube(spark: SparkSession, path: str, columns: list[str] | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """A cube's columns between two days; both reach the scan, days as partitions where the table has them."""
    df = spark.read.parquet(path)
    df = df.select("day", "cell", *columns) if columns else df
    for op, bound in ((">=", first), ("<=", last)):
        if bound:
            df = df.where(F.expr(f"day {op} date'{bound}'"))
    return nan_to_null(df)


def bronze_days(spark: SparkSession, path: str) -> DataFrame:
    """(day) of a table partitioned by day."""
    return spark.read.parquet(path).select(F.col("day").cast("date")).distinct()


def detections(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the detections feed; lines that do not fit are in ``refused``, and a feed that answers with a text fails."""
    return _feed(spark, path).where("_bad is null").drop("_bad")


def refused(spark: SparkSession, path: str) -> DataFrame:
    """(line): what of the detections feed is no detection."""
    return _feed(spark, path).where("_bad is not null").select(F.col("_bad").alias("line"))


def _feed(spark: SparkSession, path: str) -> DataFrame:
    names = [c.split()[0] for c in DETECTIONS.split(", ")]
    kinds = dict(c.split() for c in DETECTIONS.split(", "))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    # Files hold a header each, of columns in an order of their own; a service that refuses a request sends its reason instead.
    said = F.transform(F.split("value", ","), lambda c: F.lower(F.trim(c)))
    header = F.array_contains(said, names[0]) & F.array_contains(said, names[1])
    heads = lines.where(header).groupBy("_file").agg(F.min("value").alias("_head"))
    whole = lines.join(F.broadcast(heads), "_file", "left")  # a row a file
    if (odd := whole.where("_head is null and trim(value) <> ''").first()) is not None:
        raise ValueError(f"no detections: {odd.value[:200]}")
    orders = [r._head for r in heads.select("_head").distinct().collect()]
    # As an expression, so that what a line is does not depend on the columns that are asked for.
    rows, found = None, []
    for head in sorted(orders):
        columns = [c.strip().lower() for c in head.split(",")]
        found += [c for c in columns if c in kinds and c not in found]
        schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in columns) + ", _bad string"
        one = F.from_csv("value", F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
        same = F.struct(*[(one[c] if c in columns else F.lit(None).cast(kinds[c])).alias(c) for c in names], one["_bad"].alias("_bad"))
        rows = F.when(F.col("_head") == head, same) if rows is None else rows.when(F.col("_head") == head, same)
    if rows is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", _bad string")
    return whole.where(~header).select(rows.alias("d")).select(*[F.col(f"d.{c}").alias(c) for c in names if c in found], "d._bad")


# Classes of the geostationary product that are fires.
FIRE_CLASSES = (1, 2, 3)


def granule_fires(pixels: DataFrame, kind: str = "fire_result", x: str = "x", y: str = "y") -> DataFrame:
    """(longitude, latitude) of a granule's pixels of the fire classes, from their scan angles; those off the disk are left out."""
    lon, lat = geostationary_inverse(F.col(x), F.col(y))
    other = [c for c in pixels.columns if c not in (kind, x, y, "longitude", "latitude")]
    return pixels.where(F.col(kind).isin(*FIRE_CLASSES)).select(*other, lon.alias("longitude"), lat.alias("latitude")).where("longitude is not null")


def confident(df: DataFrame, column: str = "confidence", levels: tuple[str, ...] = ("n", "h")) -> DataFrame:
    """Detections of nominal or high confidence; all where there is no such column."""
    return df.where(F.lower(F.trim(column)).isin(*levels)) if column in df.columns else df


def hourly_payload(df: DataFrame, variables: list[str], column: str = "payload", keys: tuple[str, ...] = ("src_id",)) -> DataFrame:
    """(keys, ts, variables) from JSON of the form {"time": [...], "<variable>": [...]}; a null stays missing."""
    fields = ", ".join(f"{v}: array<double>" for v in variables)
    parsed = df.select(*keys, F.from_json(column, f"struct<time: array<string>, {fields}>").alias("j"))
    zipped = F.explode(F.arrays_zip(*[F.col(f"j.{n}").alias(n) for n in ("time", *variables)])).alias("r")
    return parsed.select(*keys, zipped).select(*keys, F.to_timestamp("r.time").alias("ts"), *[F.col(f"r.{v}").alias(v) for v in variables])


def boxed(df: DataFrame, west: float, south: float, east: float, north: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows of a longitude and latitude box; longitudes from 0 to 360 are wrapped first."""
    return df.withColumn(lon, S.wrapped_longitude(F.col(lon))).where(F.col(lon).between(west, east) & F.col(lat).between(south, north))


def latest_vintage(df: DataFrame, keys: list[str], value: str, vintage: str) -> DataFrame:
    """(keys, value, vintage): the value of the last vintage that has one (final over preliminary over forecast)."""
    there = F.when(F.col(value).isNotNull(), F.col(vintage))
    return df.groupBy(*keys).agg(F.max_by(value, there).alias(value), F.max(there).alias(vintage))


def cache_key(url: Column, parameters: Column) -> Column:
    """sha1 of a request: its url and its parameters (a map) in order of their names."""
    return F.sha1(F.concat(url, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(parameters))))).cast("binary"))


def cache_valid(end: Column, today: Column, forecast: Column, age: int = 7) -> Column:
    """Whether a response may be kept: no forecast, and old enough to be final."""
    return ~forecast & (F.datediff(today, end) >= age)


def byte_spans(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", near: int = NEAR_BYTES) -> DataFrame:
    """(keys, start, end, parts): ranges that touch (or are ``near`` bytes apart) as one; ends are exclusive."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach + near), 1).otherwise(0))
    return opened.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "_run").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("parts")).drop("_run")


def station_number(x: Column) -> Column:
    """A station's number: comma for point, ``Ip`` (traces) as 0, sentinels and text missing."""
    text = F.trim(x)
    number = F.regexp_replace(text, ",", ".").try_cast("double")
    return F.when(text == "Ip", 0.0).when(F.abs(number) >= 9999, None).otherwise(number)


def scaled(x: Column, low: float, high: float, scale: float) -> Column:
    """A stored number in its valid range, scaled; missing outside."""
    return F.when(x.between(low, high), x * scale)


def last_partitions(df: DataFrame, day: str, n: int = 1) -> DataFrame:
    """Rows of the n latest days that there are."""
    days = df.select(day).distinct().orderBy(F.desc(day)).limit(n)
    return df.join(F.broadcast(days), day, "left_semi")


def document(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document (manifest, model card, report) as one row."""
    return spark.read.json(path, multiLine=True)
