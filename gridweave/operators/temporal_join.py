"""Joins in time: as-of, interpolation between editions, carrying forward, seasonal warm starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _timeline(days: DataFrame, editions: DataFrame, value: str, keys: tuple[str, ...]) -> DataFrame:
    """Days and editions of a key on one axis, so that a window finds neighbours without an inequality join."""
    asked = days.select(*keys, "day", F.lit(None).cast("date").alias("ed"), F.lit(None).cast("double").alias("ev"), F.lit(True).alias("asked"))
    given = editions.select(*keys, F.col("edition").alias("day"), F.col("edition").alias("ed"), F.col(value).cast("double").alias("ev"), F.lit(False).alias("asked"))
    return asked.unionByName(given)


def _sides(df: DataFrame, keys: tuple[str, ...], later: bool = True) -> DataFrame:
    """Each day's last edition up to it (a) and first one from it on (b).

    Both are running values, b along the days in reverse: a frame that reaches to
    the end would be gone through anew for every row.  Range frames, so that an
    edition of the very day is on both sides.
    """
    edition = F.when(F.col("ev").isNotNull(), F.struct("ed", "ev"))
    last = lambda order: F.last(edition, True).over(Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    sides = {"a": last(F.col("day").asc())} | ({"b": last(F.col("day").desc())} if later else {})
    return df.withColumns(sides).where("asked")


def interpolated(days: DataFrame, editions: DataFrame, value: str = "value", keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """(keys, day, value): linear between the editions around a day, clamped beyond the first and the last; editions are (keys, edition, value)."""
    both = _sides(_timeline(days, editions, value, keys), keys)
    share = F.datediff("day", "a.ed") / F.datediff("b.ed", "a.ed")
    out = F.when(F.col("a").isNull(), F.col("b.ev")).when(F.col("b").isNull() | (F.col("a.ed") == F.col("b.ed")), F.col("a.ev")).otherwise(F.col("a.ev") + (F.col("b.ev") - F.col("a.ev")) * share)
    return both.select(*keys, "day", out.alias(value))


def nearest(days: DataFrame, editions: DataFrame, value: str = "value", keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """(keys, day, edition, value) of the nearest edition, of two as near the earlier."""
    both = _sides(_timeline(days, editions, value, keys), keys)
    earlier = F.col("b").isNull() | (F.col("a").isNotNull() & (F.datediff("day", "a.ed") <= F.datediff("b.ed", "day")))
    best = F.when(earlier, F.col("a")).otherwise(F.col("b"))
    return both.select(*keys, "day", best.alias("e")).select(*keys, "day", F.col("e.ed").alias("edition"), F.col("e.ev").alias(value))


def as_of(days: DataFrame, editions: DataFrame, value: str = "value", keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """(keys, day, edition, value) of the last edition up to the day."""
    both = _sides(_timeline(days, editions, value, keys), keys, later=False)
    return both.select(*keys, "day", F.col("a.ed").alias("edition"), F.col("a.ev").alias(value))


def carried_forward(x: Column, cell: str = "cell", day: str = "day") -> Column:
    """The last value so far."""
    return F.last(x, ignorenulls=True).over(Window.partitionBy(cell).orderBy(day).rowsBetween(Window.unboundedPreceding, 0))


def edition_year(year: Column) -> Column:
    """Land-cover edition that stands for a year."""
    return F.when(year <= 2011, 2006).when(year <= 2017, 2012).otherwise(2018)


def warm_start(targets: DataFrame, history: DataFrame, value: str = "value", keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """(keys, day, source_day, value): the value of the nearest day of the year in another year, of ties the latest.

    Of a day of the year only the two latest days can be asked for (the later one,
    or if that is of the target's own year, the other one), so a key's history is
    one row with at most 732 entries; a target meets that row alone and takes its
    least entry, without a row for each candidate.
    """
    w = Window.partitionBy(*keys, "_doy").orderBy(F.desc("source_day"))
    source = history.select(*keys, F.col("day").alias("source_day"), F.dayofyear("day").alias("_doy"), F.col(value).alias("_v"))
    latest = source.withColumn("_r", F.row_number().over(w)).where("_r <= 2")
    entry = F.struct("_doy", F.year("source_day").alias("_year"), "source_day", "_v")
    held = latest.groupBy(*keys).agg(F.collect_list(entry).alias("_held"))
    asked = targets.select(*keys, "day", F.dayofyear("day").alias("_at"), F.year("day").alias("_of")).join(held, list(keys))

    def ordered(e: Column) -> Column:
        apart = F.abs(F.col("_at") - e._doy)
        return F.struct(F.least(apart, 366 - apart).alias("near"), (-F.unix_date(e.source_day)).alias("late"), e.source_day.alias("source_day"), e._v.alias("v"))

    others = F.filter("_held", lambda e: e._year != F.col("_of"))
    best = asked.withColumn("_s", F.array_min(F.transform(others, ordered))).where("_s is not null")
    return best.select(*keys, "day", "_s.source_day", F.col("_s.v").alias(value))


def recent_or(live: Column, cached: Column, default: Column) -> tuple[Column, Column]:
    """(value, where it comes from): today's, else the last stored one, else the default."""
    value = F.coalesce(live, cached, default)
    return value, F.when(live.isNotNull(), "live").when(cached.isNotNull(), "persisted").otherwise("none")
