"""Deterministic sampling: rows are ordered by a hash of their key instead of a random number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_of(*keys: str) -> Column:
    """A stable pseudo-random order: md5 of the keys as text."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary"))


def matched(df: DataFrame, label: str, ratio: int, tie: str) -> DataFrame:
    """All positives and at most ``ratio`` times as many negatives.

    Negatives are chosen by the hash's leading digits, whose counts tell where
    the cut falls; only the cut's own bucket is ordered.
    """
    marked = df.withColumn("_h", order_of(tie)).withColumn("_b", F.substring("_h", 1, 3))
    want = df.agg((F.sum(F.col(label).cast("long")) * ratio).alias("_want"))
    sizes = marked.where(F.col(label) == 0).groupBy("_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = sizes.select("_b", "_n", before.alias("_before")).join(F.broadcast(want)).select("_b", "_n", (F.col("_want") - F.col("_before")).alias("_room"))
    negative = marked.where(F.col(label) == 0).join(F.broadcast(room), "_b").where("_room > 0")
    edge = negative.where("_room < _n").withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h"))).where("_r <= _room").drop("_r")
    kept = negative.where("_room >= _n").unionByName(edge).select(*df.columns)
    return kept.unionByName(df.where(F.col(label) == 1))


def negatives_per_day(df: DataFrame, label: str, tie: str, ratio: int = 30, day: str = "day") -> DataFrame:
    """All positives of each day and at most ``ratio`` negatives for each (of a day without any, for one)."""
    w = Window.partitionBy(day)
    rank = F.row_number().over(Window.partitionBy(day, label).orderBy(order_of(tie, day)))
    ranked = df.withColumns({"_pos": F.sum(F.col(label).cast("long")).over(w), "_r": rank})
    return ranked.where((F.col(label) == 1) | (F.col("_r") <= ratio * F.greatest("_pos", F.lit(1)))).drop("_pos", "_r")


def chronological(df: DataFrame, day: str = "day", share: float = 0.8) -> DataFrame:
    """df with ``part`` train or val: the first share of the days and the rest."""
    bounds = df.agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    cut = F.floor((F.datediff("_b", "_a") + 1) * share)
    return df.join(F.broadcast(bounds)).withColumn("part", F.when(F.datediff(day, "_a") < cut, "train").otherwise("val")).drop("_a", "_b")


def every(df: DataFrame, stride: int, day: str = "day") -> DataFrame:
    """Every stride-th day from the first."""
    first = df.agg(F.min(day).alias("_a"))
    return df.join(F.broadcast(first)).where(F.pmod(F.datediff(day, "_a"), F.lit(stride)) == 0).drop("_a")


def balanced_days(df: DataFrame, event: str, ratio: float = 1.0, mode: str = "balanced_days", day: str = "day") -> DataFrame:
    """Days to learn from: all, those with an event, or those and ratio times as many others (by hash)."""
    days = df.groupBy(day).agg(F.max(F.coalesce(F.col(event).cast("int"), F.lit(0))).alias("_e"))
    if mode == "all":
        return df
    chosen = days.where("_e = 1")
    if mode == "balanced_days":
        want = chosen.agg(F.floor(F.count("*") * ratio).alias("_want"))
        # One row a day: an order of all of them is small.
        others = days.where("_e = 0").withColumn("_r", F.row_number().over(Window.orderBy(order_of(day)))).join(F.broadcast(want)).where("_r <= _want")
        chosen = chosen.select(day).unionByName(others.select(day))
    return df.join(F.broadcast(chosen.select(day)), day, "left_semi")


def weighted_days(df: DataFrame, event: str, weight: int = 10, day: str = "day") -> DataFrame:
    """df with how often a row is drawn: days with an event weigh more."""
    return df.withColumn("weight", F.when(F.max(F.coalesce(F.col(event).cast("int"), F.lit(0))).over(Window.partitionBy(day)) == 1, weight).otherwise(1))


def drawn_days(df: DataFrame, event: str, n: int, weight: int = 10, seed: int = 0, day: str = "day") -> DataFrame:
    """(draw, day): n days drawn with replacement, each as likely as its weight; the same for the same seed.

    A day owns as many slots as it weighs; a draw's hash names a slot.
    """
    days = df.groupBy(day).agg(F.when(F.max(F.coalesce(F.col(event).cast("int"), F.lit(0))) == 1, weight).otherwise(1).alias("_w"))
    # One row a day: an order of all of them is small.
    ends = days.withColumn("_end", F.sum("_w").over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)))
    slots = ends.select(day, F.explode(F.sequence(F.col("_end") - F.col("_w"), F.col("_end") - 1)).alias("_slot"))
    total = ends.agg(F.max("_end").alias("_total"))
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw")).withColumn("_s", F.lit(seed))
    number = F.conv(F.substring(order_of("_s", "draw"), 1, 15), 16, 10).cast("long")
    return draws.join(F.broadcast(total)).withColumn("_slot", F.pmod(number, F.col("_total"))).join(slots, "_slot").select("draw", day)


def alert_set(df: DataFrame, p: str, share: float = 0.003, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """Rows whose score reaches the k-th greatest of their key, k being the share of rows, one at least; ties stay."""
    size = F.count("*").over(Window.partitionBy(*keys))
    k = F.greatest(F.lit(1), F.floor(size * share))
    return df.withColumns({"_k": k, "_r": F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(p)))}).where("_r <= _k").drop("_k", "_r")


def top(df: DataFrame, n: int, by: Column, tie: str, keys: tuple[str, ...]) -> DataFrame:
    """The n greatest rows of each key, with their rank; ties by ``tie``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(by.desc(), tie))).where(F.col("rank") <= n)
