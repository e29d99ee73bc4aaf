"""Registration of queries with the SQL that they are held against, and the cubes that stand in for real ones.

* E-cube: ``events`` by user (cell) and day; an event is one of type ``error``.
* L-cube: ``lineitem`` by supplier (cell) and every day of its years; rain is the
  shipped quantity, missing on days without any.  Heat is a fixed yearly wave.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import gap_free
from ..grid import Grid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: 10 columns; users and suppliers stand on it in order.
PLOT = Grid(0.0, 0.0, 2000.0, -2000.0, 10, 10)
WIDE = Grid(0.0, 0.0, 2000.0, -2000.0, 10, 16)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plot(cells: DataFrame, least: Grid = PLOT) -> Grid:
    """``least`` with as many rows as the greatest of ``cells`` needs, and never fewer rows than it has."""
    top = cells.agg(F.max("cell")).first()[0]
    return least if top is None else replace(least, ny=max(least.ny, int(top) // least.nx + 1))


def r(x: Column | str, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(F.col(x) if isinstance(x, str) else x, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6, *but: str) -> DataFrame:
    return df.select(*[r(c, digits).alias(c) if t == "double" and c not in but else F.col(c) for c, t in df.dtypes])


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("day"), F.col("user_id").cast("int").alias("cell"), "event_type", "value", "props")


def ecube(spark: SparkSession, sf: str) -> DataFrame:
    """(day, cell, n, mean, is_fire) without gaps."""
    c = gap_free(events(spark, sf), "day", "cell", F.count("*").alias("n"), F.avg("value").alias("mean"), F.max((F.col("event_type") == "error").cast("int")).alias("is_fire"))
    return c.select("day", "cell", F.coalesce("n", F.lit(0)).alias("n"), "mean", F.coalesce("is_fire", F.lit(0)).alias("is_fire"))


ECUBE = """ev AS (SELECT event_id, ts, CAST(ts AS DATE) AS day, CAST(user_id AS INTEGER) AS cell, event_type, value, props FROM events),
efound AS (SELECT day, cell, count(*) AS n, avg(value) AS mean, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS is_fire FROM ev GROUP BY 1, 2),
edays AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ev),
ecube AS (SELECT d.day, c.cell, coalesce(f.n, 0) AS n, f.mean, coalesce(f.is_fire, 0) AS is_fire FROM edays d CROSS JOIN (SELECT DISTINCT cell FROM ev) c LEFT JOIN efound f ON f.day = d.day AND f.cell = c.cell)"""


def tmax(day: Column) -> Column:
    return 18 + 12 * F.sin(2 * F.pi() * (F.dayofyear(day) - 105) / 365.25)


def lcube(spark: SparkSession, sf: str) -> DataFrame:
    """(cell, day, rain, tmax) without gaps."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("int").alias("cell"), F.to_date("l_shipdate").alias("day"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    return gap_free(li, "day", "cell", F.sum("q").cast("double").alias("rain")).withColumn("tmax", tmax(F.col("day")))


LCUBE = """li AS (SELECT CAST(l_suppkey AS INTEGER) AS cell, CAST(l_shipdate AS DATE) AS day, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS rain FROM lineitem GROUP BY 1, 2),
ldays AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM li),
lcube AS (SELECT c.cell, d.day, l.rain, 18 + 12 * sin(2 * pi() * (dayofyear(d.day) - 105) / 365.25) AS tmax FROM ldays d CROSS JOIN (SELECT DISTINCT cell FROM li) c LEFT JOIN li l ON l.cell = c.cell AND l.day = d.day)"""


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, p, y, regime, cell, day): scores with ties and labels."""
    d = table(spark, sf, "documents").select("doc_id", (F.pmod("n_chars", F.lit(997)) / 997.0).alias("p"))
    out = d.join(table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("int").alias("y")), "doc_id")
    return out.select("doc_id", F.when(F.col("y") == 1, F.least(F.col("p") + 0.2, F.lit(1.0))).otherwise(F.col("p")).alias("p"), "y", (F.pmod("doc_id", F.lit(3)) + 0).cast("int").alias("regime"))


SCORES = """sc AS (SELECT d.doc_id, (d.n_chars % 997) / 997.0::DOUBLE AS p0, CAST(l.toxic AS INTEGER) AS y, CAST(d.doc_id % 3 AS INTEGER) AS regime FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
scores AS (SELECT doc_id, CASE WHEN y = 1 THEN least(p0 + 0.2::DOUBLE, 1.0::DOUBLE) ELSE p0 END AS p, y, regime FROM sc)"""
