"""The day axis: spines, and holidays as a table of (day, region); region is null for national ones."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# National holidays of Spain (month, day), next to Good Friday.
NATIONAL = ((1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25))
# A fixed regional holiday (month, day) by region code; Maundy Thursday and Easter Monday by code.
REGIONAL = {1: (2, 28), 2: (4, 23), 3: (9, 8), 4: (3, 1), 6: (7, 28), 7: (4, 23), 8: (5, 31), 9: (9, 11), 10: (10, 9), 11: (9, 8), 12: (7, 25), 13: (5, 2), 14: (6, 9), 15: (12, 3), 16: (10, 25), 17: (6, 9)}
MAUNDY_THURSDAY = (1, 2, 3, 4, 6, 7, 8, 11, 12, 13, 14, 15, 16, 17)
EASTER_MONDAY = (4, 9, 10, 15, 16, 17)
# Regions by code; 0 stands for none and 5 is not used.
REGIONS = {1: ("AN", "Andalucía"), 2: ("AR", "Aragón"), 3: ("AS", "Asturias"), 4: ("IB", "Baleares"), 6: ("CB", "Cantabria"), 7: ("CL", "Castilla y León"), 8: ("CM", "Castilla-La Mancha"), 9: ("CT", "Cataluña"), 10: ("VC", "C. Valenciana"), 11: ("EX", "Extremadura"), 12: ("GA", "Galicia"), 13: ("MD", "Madrid"), 14: ("MC", "Murcia"), 15: ("NC", "Navarra"), 16: ("PV", "País Vasco"), 17: ("RI", "La Rioja")}


def easter(year: int) -> date:
    """Easter Sunday of a Gregorian year (the anonymous computus)."""
    a, (b, c) = year % 19, divmod(year, 100)
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (a + 11 * h) // 319
    r = (2 * e + 2 * i - k - h + m + 32) % 7
    month = (h - m + r + 90) // 25
    return date(year, month, (h - m + r + month + 19) % 32)


def holiday_rows(first: int, last: int) -> list[tuple[date, int | None]]:
    rows: list[tuple[date, int | None]] = []
    for year in range(first, last + 1):
        sunday = easter(year)
        rows += [(date(year, m, d), None) for m, d in NATIONAL] + [(sunday - timedelta(2), None)]
        rows += [(date(year, m, d), code) for code, (m, d) in REGIONAL.items()]
        rows += [(sunday - timedelta(3), code) for code in MAUNDY_THURSDAY] + [(sunday + timedelta(1), code) for code in EASTER_MONDAY]
    return sorted(rows, key=lambda r: (r[0], r[1] or 0))


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(day, region) of the years; a few dozen rows a year."""
    return spark.createDataFrame(holiday_rows(first, last), "day date, region int")


def regional_only(found: DataFrame) -> DataFrame:
    """Regional holidays on days that are not national ones."""
    national = found.where("region is null").select("day").distinct()
    return found.where("region is not null").distinct().join(F.broadcast(national), "day", "left_anti")


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, s, n) for c, (s, n) in REGIONS.items()], "code int, subdivision string, name string")


#: Rows of a table that are dealt to one task, about; a key's rows stay together.
ROWS = 100_000


def gap_free(df: DataFrame, day: str, key: str, *found: Column) -> DataFrame:
    """(key, day, what is found): every key of df with every day between df's first and last; found of the day's rows, missing on days without any.

    A day's row is repeated until the next one's day.  So no table of all keys by all
    days is joined, shuffled or broadcast: only df's own rows are dealt out, by key,
    to as many tasks as they need, and windows of a key find its days in one place.
    """
    size = df.agg(F.count("*").alias("n"), F.min(day).alias("a"), F.max(day).alias("b")).first()
    first, last = F.lit(size.a).cast("date"), F.lit(size.b).cast("date")
    rows = df.repartition(max(1, -(-size.n // ROWS)), key).groupBy(key, day).agg(*found)
    names = [c for c in rows.columns if c not in (key, day)]
    w = Window.partitionBy(key).orderBy(day)
    spans = rows.withColumns({"_from": F.when(F.row_number().over(w) == 1, first).otherwise(F.col(day)), "_to": F.coalesce(F.date_sub(F.lead(day).over(w), 1), last)})
    # A key without a name meets no rows, as in a join.
    own = (F.col("_at") == F.col(day)) & F.col(key).isNotNull()
    days = spans.where("_from <= _to").select("*", F.explode(F.sequence("_from", "_to")).alias("_at"))
    return days.select(key, F.col("_at").alias(day), *[F.when(own, F.col(c)).alias(c) for c in names])


def day_index(day: Column, first: Column | str) -> Column:
    return F.datediff(day, F.lit(first) if isinstance(first, str) else first)


def composite_day(name: Column) -> Column:
    """The first day of a composite from its tag AYYYYDDD."""
    return F.date_add(F.make_date(F.substring(name, 2, 4).cast("int"), F.lit(1), F.lit(1)), F.substring(name, 6, 3).cast("int") - 1)
