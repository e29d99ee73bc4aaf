"""Exact ranking and calibration metrics as DataFrame operations.

Ranks over all rows need an order of all rows.  Rows are first counted by
distinct score (which also settles ties), the counts are ordered in ranges of
scores, and running totals are taken within a range and across ranges, so no
task holds more than its range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def ranked(df: DataFrame, score: str, label: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, score, n, pos, n_above, pos_above): per distinct score its rows and positives, and those of greater scores."""
    by = df.groupBy(*keys, F.col(score).alias("score")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    # Ranges of about as many distinct scores each; those of equal width would put crowded scores into one.
    cuts = by.groupBy(*keys).agg(F.percentile_approx("score", [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("cuts"))
    cut = by.join(F.broadcast(cuts), list(keys)) if keys else by.join(F.broadcast(cuts))
    part = cut.withColumn("part", F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("score"))), F.lit(-1))).drop("cuts")
    over = Window.partitionBy(*keys).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = part.groupBy(*keys, "part").agg(F.sum("n").alias("pn"), F.sum("pos").alias("pp"))
    ranges = ranges.select(*keys, "part", F.coalesce(F.sum("pn").over(over), F.lit(0)).alias("bn"), F.coalesce(F.sum("pp").over(over), F.lit(0)).alias("bp"))
    inside = Window.partitionBy(*keys, "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    joined = part.join(F.broadcast(ranges), [*keys, "part"])
    return joined.select(*keys, "score", "n", "pos", (F.coalesce(F.sum("n").over(inside), F.lit(0)) + F.col("bn")).alias("n_above"), (F.coalesce(F.sum("pos").over(inside), F.lit(0)) + F.col("bp")).alias("pos_above"))


def roc_auc(df: DataFrame, score: str, label: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, auc, n_pos, n_neg); ties count half; missing without both kinds."""
    r = ranked(df, score, label, keys)
    negative = F.col("n") - F.col("pos")
    out = r.groupBy(*keys).agg(F.sum(negative * F.col("pos_above") + 0.5 * negative * F.col("pos")).alias("won"), F.sum("pos").alias("n_pos"), F.sum(negative).alias("n_neg"))
    return out.select(*keys, F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("won") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"), "n_pos", "n_neg")


def average_precision(df: DataFrame, score: str, label: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, ap): recall steps times the precision at each distinct score."""
    r = ranked(df, score, label, keys)
    precision = (F.col("pos_above") + F.col("pos")) / (F.col("n_above") + F.col("n"))
    return r.groupBy(*keys).agg((F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), F.lit(0))).alias("ap"))


def r_precision(df: DataFrame, score: str, label: str, tie: str) -> DataFrame:
    """(precision, k): share of positives among the k highest scores, k being the number of positives; ties by ``tie``."""
    total = df.agg(F.sum(F.col(label).cast("long")).alias("k"))
    r = ranked(df, score, label)
    whole = r.join(F.broadcast(total)).where("n_above < k")
    # Scores that fit whole, and the one that the k-th row cuts.
    full = whole.where("n_above + n <= k").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("hits"))
    edge = whole.where("n_above + n > k").select(F.col("score").alias("edge"), (F.col("k") - F.col("n_above")).alias("room"))
    cut = df.join(F.broadcast(edge), df[score] == F.col("edge")).withColumn("r", F.row_number().over(Window.partitionBy("edge").orderBy(tie))).where("r <= room")
    more = cut.agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("more"))
    return total.join(F.broadcast(full)).join(F.broadcast(more)).select(((F.col("hits") + F.col("more")) / F.nullif(F.col("k"), F.lit(0))).alias("precision"), "k")


def edges(bins: int = 12, low: float = 1e-4) -> list[float]:
    """0 and ``bins`` logarithmic steps from low to 1."""
    return [0.0, *(low * (1 / low) ** (i / (bins - 1)) for i in range(bins - 1)), 1.0]


def reliability(df: DataFrame, p: str, label: str, bins: int = 12) -> DataFrame:
    """(bin, n, mean_p, mean_y) of logarithmic bins; the last one holds 1."""
    found = edges(bins)
    at = sum((F.when(F.col(p) >= e, 1).otherwise(0) for e in found[1:-1]), F.lit(0))
    return df.withColumn("bin", at).groupBy("bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(label).cast("double")).alias("mean_y"))


def calibration(df: DataFrame, p: str, label: str, bins: int = 12) -> DataFrame:
    """(ece, brier)."""
    total = reliability(df, p, label, bins).agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("mean_y"))) / F.sum("n")).alias("ece"))
    brier = df.agg(F.avg((F.col(p) - F.col(label)) * (F.col(p) - F.col(label))).alias("brier"))
    return total.join(F.broadcast(brier))


def regime_metrics(df: DataFrame, p: str, label: str, regime: str, tie: str, ratio: int = 15) -> DataFrame:
    """One row: ROC area, average precision at ratio:1 negatives (all, new events, spread), R-precision, positives; regimes above 0 only."""
    from .sampling import matched

    land = df.where(F.col(regime) > 0)
    out = roc_auc(land, p, label).select(F.col("auc").alias("roc"), "n_pos")
    for name, kind in (("overall_ap", None), ("new_ap", 1), ("spread_ap", 2)):
        kept = land if kind is None else land.where((F.col(label) == 0) | (F.col(regime) == kind))
        out = out.join(F.broadcast(average_precision(matched(kept, label, ratio, tie), p, label).withColumnRenamed("ap", name)))
    return out.join(F.broadcast(r_precision(land, p, label, tie).select(F.col("precision").alias("prec_at_k"))))


def log_loss(p: float, y: int) -> float:
    return -math.log(p if y else 1 - p)
