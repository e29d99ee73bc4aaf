"""Aggregations: days from hours, summaries by region, drift and agreement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def spread_of(x: str) -> list[Column]:
    """Mean, minimum, maximum and range of a variable."""
    return [F.avg(x).alias(f"{x}_mean"), F.min(x).alias(f"{x}_min"), F.max(x).alias(f"{x}_max"), (F.max(x) - F.min(x)).alias(f"{x}_range")]


def at_maximum(value: str, by: str, ts: str) -> Column:
    """The value where ``by`` is greatest, of ties the earliest."""
    return F.max_by(value, F.when(F.col(by).isNotNull(), F.struct(F.col(by), (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("o"))))


def daily(hours: DataFrame, need: int | None = None, keys: tuple[str, ...] = ("src_id",)) -> DataFrame:
    """Days of station hours (ts, t2m, rh, pressure, speed_kmh, direction, soil_moisture, soil_temperature, precipitation).

    Wind becomes components before it is averaged, and the components at the
    hour of the greatest speed are kept; precipitation is the day's sum over 24.
    With ``need``, days with another number of hours are left out.
    """
    speed = S.kmh_to_ms(F.col("speed_kmh"))
    hourly = hours.withColumns({"day": F.to_date("ts"), "speed": speed, "u": S.wind_u(speed, F.col("direction")), "v": S.wind_v(speed, F.col("direction"))})
    out = hourly.groupBy("day", *keys).agg(
        F.count("*").alias("hours"),
        *spread_of("t2m"),
        *spread_of("rh"),
        *spread_of("pressure"),
        F.avg("speed").alias("wind_speed_mean"),
        F.max("speed").alias("wind_speed_max"),
        F.avg("u").alias("wind_u_mean"),
        F.avg("v").alias("wind_v_mean"),
        at_maximum("u", "speed", "ts").alias("wind_u_atmaxspeed"),
        at_maximum("v", "speed", "ts").alias("wind_v_atmaxspeed"),
        F.avg("soil_moisture").alias("soil_moisture_mean"),
        F.avg("soil_temperature").alias("soil_temperature_mean"),
        (F.sum("precipitation") / 24).alias("total_precipitation_mean"),
    )
    return out.where(F.col("hours") == need) if need else out


def risk_summary(scored: DataFrame, threshold: float, keys: tuple[str, ...] = ("region", "regime"), p: str = "p") -> DataFrame:
    """By region and regime: cells, mean and greatest probability, expected events, cells at or above the alert threshold."""
    return scored.groupBy(*keys).agg(F.count("*").alias("n_cells"), F.avg(p).alias("mean_prob"), F.max(p).alias("max_prob"), F.sum(p).alias("expected_count"), F.count_if(F.col(p) >= threshold).alias("n_alert"))


def any_event(p: Column) -> Column:
    """Probability of at least one event among rows."""
    return 1 - F.product(1 - F.least(F.greatest(p, F.lit(0.0)), F.lit(0.99)))


def drift(df: DataFrame, features: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, feature, mean, std, min, max, nan_frac), one row a feature; missing values are skipped."""
    # One wide aggregation; rows are not multiplied by the features.
    of = lambda f: F.struct(F.lit(f).alias("feature"), F.avg(f).alias("mean"), F.stddev_pop(f).alias("std"), F.min(F.col(f).cast("double")).alias("min"), F.max(F.col(f).cast("double")).alias("max"), F.avg(F.col(f).isNull().cast("double")).alias("nan_frac"))
    wide = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.array(*[of(f) for f in features]).alias("_e")).where("_n > 0")
    return wide.select(*keys, F.explode("_e").alias("_e")).select(*keys, "_e.*")


def norm_stats(df: DataFrame, features: list[str], floor: float = 1e-6) -> DataFrame:
    """(feature, mean, std): what features are standardised by."""
    return drift(df, features).select("feature", "mean", F.greatest("std", F.lit(floor)).alias("std"))


def overlap(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("day", "cell")) -> DataFrame:
    """One row: sizes, Jaccard index, recalls both ways and gain of two sets of keys."""
    left, right = a.select(*keys).distinct().withColumn("_a", F.lit(1)), b.select(*keys).distinct().withColumn("_b", F.lit(1))
    in_a, in_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    out = left.join(right, list(keys), "full").agg(F.count_if(in_a & in_b).alias("both"), F.count_if(in_a & ~in_b).alias("only_a"), F.count_if(in_b & ~in_a).alias("only_b"), F.count("*").alias("either"))
    both = F.col("both")
    share = lambda n: F.when(n > 0, both / n)
    return out.withColumns({"jaccard": share(F.col("either")), "recall_of_a": share(both + F.col("only_a")), "recall_of_b": share(both + F.col("only_b")), "gain": F.when(both + F.col("only_a") > 0, F.col("either") / (both + F.col("only_a")))})


def regime_priors(df: DataFrame, label: str, regime: str = "regime", eps: float = 1e-8) -> DataFrame:
    """(regime, n, n_pos, log_odds): what a regime adds to a score's log odds."""
    share = (F.col("n_pos") + eps) / (F.col("n") - F.col("n_pos") + eps)
    return df.groupBy(regime).agg(F.count("*").alias("n"), F.sum(label).cast("long").alias("n_pos")).withColumn("log_odds", F.ln(share))


def climatology(df: DataFrame, label: str, train: Column, keys: tuple[str, ...] = ("cell", "doy")) -> DataFrame:
    """df with the rate of the label over its key's training rows; 0 where there are none, or a part of the key is missing.

    A window, so that rows that a cell's tasks hold are neither read twice nor dealt out again to be joined.
    """
    rate = F.avg(F.when(train, F.col(label).cast("double"))).over(Window.partitionBy(*keys))
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.withColumn("rate", F.coalesce(F.when(named, rate), F.lit(0.0)))


def expect(df: DataFrame, **columns: str) -> DataFrame:
    """df, failing when read if a named column has no value at all (name: what to say)."""
    ok = F.lit(True)
    for c, said in columns.items():
        ok = ok & F.when(F.count(c) > 0, True).otherwise(F.raise_error(F.lit(said)).cast("boolean"))
    # A filter, since a column that nobody reads would not be evaluated.
    return df.join(F.broadcast(df.agg(ok.alias("_ok")))).where("_ok").drop("_ok")
