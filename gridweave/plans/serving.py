"""From scores to what is served: regimes, summaries, attribution, causes, status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators.metrics import ranked
from ..operators.sampling import top
from ..schema import CAUSES

IGNITION, SPREAD = 1, 2
NEAR_KM = 6.0


def regime(distance: Column, near: float = NEAR_KM) -> Column:
    """2 (spread) up to the distance, else 1 (ignition), also where it is missing."""
    return F.when(distance <= near, SPREAD).otherwise(IGNITION)


def scattered(cells: DataFrame, scored: DataFrame, p: str = "p") -> DataFrame:
    """All cells with their score; 0 and regime 0 off the scored ones."""
    return cells.join(scored.select("cell", p, "regime"), "cell", "left").withColumns({p: F.coalesce(p, F.lit(0.0)), "regime": F.coalesce("regime", F.lit(0))})


def drivers(rows: DataFrame, features: list[str], score: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("regime",), cells: int = 200, most: int = 6, least: float = 1e-5) -> DataFrame:
    """(keys, feature, drop, rank): how much the mean score of the riskiest rows drops when a feature is set to its mean.

    ``score`` adds p to rows of the features; all occlusions of a row are scored
    in one pass as rows of their own.
    """
    means = rows.agg(*[F.avg(f).alias(f"_m_{f}") for f in features])
    focus = top(score(rows), cells, F.col("p"), "cell", keys).withColumnRenamed("p", "_base").drop("rank")
    each = focus.join(F.broadcast(means)).withColumn("feature", F.explode(F.array(*map(F.lit, features))))
    hidden = each.withColumns({f: F.when(F.col("feature") == f, F.col(f"_m_{f}")).otherwise(F.col(f)) for f in features})
    drop = score(hidden).groupBy(*keys, "feature").agg((F.avg("_base") - F.avg("p")).alias("drop"))
    return top(drop.where(F.col("drop") > least), most, F.col("drop"), "feature", keys)


def drivers_json(found: DataFrame) -> DataFrame:
    """(regime, drivers) with drivers a JSON list of {feature, drop} in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature", "drop"))), lambda r: F.struct(r.feature.alias("feature"), r.drop.alias("drop")))
    return found.groupBy("regime").agg(F.to_json(listed).alias("drivers"))


def causes(features: Column, most: int = 2) -> Column:
    """The first phrases whose features are among those given (an array)."""
    said = F.array(*[F.when(F.arrays_overlap(features, F.array(*map(F.lit, names))), F.lit(phrase)) for names, phrase in CAUSES])
    return F.slice(F.filter(said, lambda x: x.isNotNull()), 1, most)


def expected_area(df: DataFrame, hectares: float, p: str = "p") -> DataFrame:
    return df.agg((F.sum(p) * hectares).alias("area_ha"), F.count_if(F.col(p) > 1e-4).alias("n_cells"))


def tiers(df: DataFrame, p: str = "p", region: str = "region") -> DataFrame:
    """(tier, regions, n): regions by the tier of their greatest score, in order of their names."""
    best = df.groupBy(region).agg(F.max(p).alias("m")).withColumn("tier", S.risk_band(F.col("m")))
    return best.groupBy("tier").agg(F.concat_ws(", ", F.array_sort(F.collect_list(F.col(region).cast("string")))).alias("regions"), F.count("*").alias("n"))


def riskiest(df: DataFrame, n: int = 5, p: str = "p", region: str = "region") -> DataFrame:
    """(place, region, risk, tier) of the n regions with the greatest scores; ties by name."""
    best = df.groupBy(region).agg(F.max(p).alias("risk"))
    first = best.orderBy(F.desc("risk"), region).limit(n)
    place = F.row_number().over(Window.orderBy(F.desc("risk"), region))
    return first.select(place.alias("place"), F.col(region).alias("region"), "risk", S.risk_band(F.col("risk")).alias("tier"))


def stretch(df: DataFrame, p: str = "p", share: float = 0.99) -> DataFrame:
    """(p99): that percentile of positive scores, interpolated between the two nearest.

    Scores are counted and placed by ranges (:func:`metrics.ranked`), so no task holds all of them.
    """
    r = ranked(df.where(F.col(p) > 0).withColumn("_one", F.lit(0)), p, "_one")
    at = share * (F.sum("n") - 1)
    place = r.agg(F.sum("n").alias("_all"), F.floor(at).alias("_k"), (at - F.floor(at)).alias("_part"))
    first = F.col("_all") - F.col("n_above") - F.col("n")  # how many are less
    holds = lambda k: (first <= k) & (k < first + F.col("n"))
    both = r.join(F.broadcast(place)).where(holds(F.col("_k")) | holds(F.col("_k") + 1))
    low, high = F.min("score"), F.max("score")
    return both.agg((low + (high - low) * F.max("_part")).alias("p99"))


# satellites' passes in minutes of the day (UTC), and hours until their data can be fetched.
PASSES = (("NOAA-21", 100), ("NOAA-21", 750), ("NOAA-20", 125), ("NOAA-20", 775), ("Suomi NPP", 150), ("Suomi NPP", 800))
SETTLE_HOURS = 3.5


def passes(df: DataFrame, issue: Column, now: Column, fetched: Column) -> DataFrame:
    """df with a row for each pass of its issue day: satellite, minute, settles and state: in, miss or later, by when the pass can be fetched and when the data was."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("satellite"), F.lit(m).alias("minute")) for s, m in PASSES])).alias("_pass")
    table = df.select("*", each).withColumns({"satellite": F.col("_pass.satellite"), "minute": F.col("_pass.minute")}).drop("_pass")
    settles = F.timestamp_seconds(F.unix_timestamp(issue.cast("timestamp")) + F.col("minute") * 60 + int(SETTLE_HOURS * 3600))
    state = F.when(now < F.col("settles"), "later").when(fetched.isNull() | (fetched >= F.col("settles")), "in").otherwise("miss")
    return table.withColumn("settles", settles).withColumn("state", state)


def status(found: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, status, caption) of all passes."""
    missed, later, n = F.count_if(F.col("state") == "miss"), F.min(F.when(F.col("state") == "later", F.col("settles"))), F.count("*")
    said = F.when(missed > 0, "newer passes have landed, refresh pending").when(later.isNotNull(), F.concat(F.lit("next update "), F.date_format(later, "HH:mm"))).otherwise(F.concat(F.lit("all "), n.cast("string"), F.lit(" passes in")))
    return found.groupBy(*keys).agg(F.when(missed > 0, "PARTIAL").otherwise("LIVE").alias("status"), said.alias("caption"))


def degraded(tags: Column) -> Column:
    """What a prediction lacked, from its provenance tags (an array)."""
    has = lambda prefix: F.exists(tags, lambda t: t.startswith(prefix))
    return F.when(has("fire:none"), "no event feed").when(has("fire:persisted"), "event feed persisted").when(has("fire:warm"), "events of another season").when(~has("weather:"), "weather not refreshed").otherwise("complete")


def region_areas(areas: DataFrame) -> DataFrame:
    """Areas by probability, greatest first, over all days."""
    return areas.withColumn("place", F.rank().over(Window.partitionBy("day").orderBy(F.desc("p_any"))))


def daily_outputs(scored: DataFrame, features: list[str], issue: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(inference, feature_stats) of an issue date: one row a region and regime, one a feature."""
    day = F.lit(issue).cast("date").alias("issue_date")
    inference = A.risk_summary(scored.where("region > 0 and regime > 0"), threshold).select(day, F.date_add(day, 1).alias("target_date"), "*")
    return inference, A.drift(scored, features).select(F.lit(issue).cast("date").alias("date"), "*")
