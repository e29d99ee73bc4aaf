"""Rank correlation of features and clusters of those that say the same."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def ranks(df: DataFrame, features: list[str], ranges: int = RANGES) -> DataFrame:
    """(row, r0, r1, ...): the mean rank of each feature's value among the rows that have it, lowest first; missing where it is.

    All features go as one long table (row, feature, value).  Cuts at percentiles
    deal a feature's values into ranges, which are ranked by windows of their own
    and placed by counts; a value that fills a range or more has one rank and takes
    no part in that, so that no task holds it.  One shuffle by range and one back to
    rows, whatever the number of features; values are never joined.
    """
    number = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double") + 0.0) for f in features]
    wide = df.select(F.monotonically_increasing_id().alias("row"), *[x.alias(f"v{i}") for i, x in enumerate(number)])
    # Cuts need not be exact: they only deal values out, and ranks are counted.
    share = [i / ranges for i in range(1, ranges)]
    found = wide.agg(*[F.percentile_approx(f"v{i}", share, 20 * ranges).alias(f"v{i}") for i in range(len(features))]).first()
    cuts = [sorted(set(found[f"v{i}"] or [])) for i in range(len(features))]
    heavy = [sorted({a for a, b in zip(q, q[1:], strict=False) if a == b}) for q in (found[f"v{i}"] or [] for i in range(len(features)))]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (q, much) in enumerate(zip(cuts, heavy, strict=True)):
                v = batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float)
                there = np.flatnonzero(~np.isnan(v))
                v = v[there]
                at = np.searchsorted(q, v, "left") * 2
                # A heavy value is a range of its own, beyond those that lie below it.
                at[np.isin(v, much)] += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(there)), pa.array(np.full(len(v), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(v)], ["row", "feature", "part", "value"])

    long = wide.mapInArrow(dealt, "row long, feature int, part int, value double")
    counts = long.groupBy("feature", "part").agg(F.count("*").alias("n"))
    below = F.coalesce(F.sum("n").over(Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = F.broadcast(counts.select("feature", "part", "n", below.alias("below")))  # at most 2 * ranges rows a feature
    known = long.join(placed, ["feature", "part"])
    # Rows of a heavy value need no order; the salt spreads them.
    known = known.withColumn("salt", F.when(F.col("part") % 2 == 1, F.pmod("row", F.lit(1024))).otherwise(0))
    by = Window.partitionBy("feature", "part", "salt")
    same = F.count("*").over(Window.partitionBy("feature", "part", "salt", "value"))
    light = F.rank().over(by.orderBy("value")) + (same - 1) / 2
    placed = known.select("row", "feature", (F.col("below") + F.when(F.col("part") % 2 == 0, light).otherwise((F.col("n") + 1) / 2)).alias("rank"))
    each = [F.max(F.when(F.col("feature") == i, F.col("rank"))).alias(f"r{i}") for i in range(len(features))]
    return placed.groupBy("row").agg(*each)


def spearman_pairs(df: DataFrame, features: list[str]) -> DataFrame:
    """(x, y, rho) of all pairs of features, each over the rows that have both; ranks are among the rows that have the feature.

    Tasks multiply blocks of rows as matrices; what is added up are numbers by pair.
    """
    k = len(features)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, k, k))
        for batch in batches:
            r = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)], 1)
            there = ~np.isnan(r)
            x, m = np.where(there, r, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.triu_indices(k, 1)
        n, a, aa, ab = (t[i, j] for t in total)
        columns = [n, a, total[1][j, i], aa, total[2][j, i], ab]
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, columns)], ["i", "j", "n", "a", "b", "aa", "bb", "ab"])

    # Centred before they are multiplied: ranks of a feature lie around half of its rows.
    ranked = ranks(df, features)
    middle = ranked.agg(*[F.avg(f"r{i}").alias(f"m{i}") for i in range(k)])
    centred = ranked.join(F.broadcast(middle)).select(*[(F.col(f"r{i}") - F.col(f"m{i}")).alias(f"r{i}") for i in range(k)])
    s = centred.mapInArrow(products, "i int, j int, n double, a double, b double, aa double, bb double, ab double").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    n = F.col("n")
    spread = (n * F.col("aa") - F.col("a") * F.col("a")) * (n * F.col("bb") - F.col("b") * F.col("b"))
    rho = F.when(spread > 0, (n * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(spread))
    names = F.array(*map(F.lit, features))
    return s.select(names[F.col("i")].alias("x"), names[F.col("j")].alias("y"), rho.alias("rho"))


def clusters(features: list[str], rho: dict[tuple[str, str], float], cut: float = 0.30) -> list[list[str]]:
    """Average-linkage clusters of features by 1 - |rho|, merged while the nearest two are below the cut."""
    far = lambda a, b: 0.0 if a == b else 1 - abs(rho.get((a, b), rho.get((b, a), 0.0)))
    groups = [[f] for f in features]
    while len(groups) > 1:
        d, i, j = min((float(np.mean([far(a, b) for a in x for b in y])), i, j) for i, x in enumerate(groups) for j, y in enumerate(groups) if i < j)
        if d > cut:
            break
        groups[i] += groups.pop(j)
    return groups
