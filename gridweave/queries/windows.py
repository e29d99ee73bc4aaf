"""Windows along days: sums, run lengths, departures, the drought recursion, horizons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import recursive
from ..operators import windows as W
from .base import ECUBE, LCUBE, ecube, lcube, query, r, rounded

_W = "PARTITION BY cell ORDER BY day"


def _trailing(n: int):
    def run(spark, sf):
        return lcube(spark, sf).select("cell", "day", W.trailing_sum(F.col("rain"), n, W.along()).alias("total"))

    run.__name__ = f"trail_sum_{n}"
    query(f"WITH {LCUBE} SELECT cell, day, sum(rain) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS total FROM lcube")(run)


for _n in (7, 30, 90, 180, 365):
    _trailing(_n)


@query(f"WITH {LCUBE} SELECT cell, day, CASE WHEN row_number() OVER ({_W}) >= 365 THEN sum(rain) OVER ({_W} ROWS BETWEEN 364 PRECEDING AND CURRENT ROW) END AS strict, CASE WHEN count(rain) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 THEN sum(rain) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS complete, CASE WHEN row_number() OVER ({_W}) >= 3 AND count(rain) OVER ({_W}) = row_number() OVER ({_W}) THEN sum(rain) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS poisoned FROM lcube")
def strict_roll_365(spark, sf):
    c = W.rolled(lcube(spark, sf), F.col("rain"), W.along(), strict=(365, "strict"), complete=(3, "complete"), poisoned=(3, "poisoned"))
    return c.select("cell", "day", "strict", "complete", "poisoned")


_ISLANDS = "row_number() OVER (PARTITION BY cell ORDER BY day)"


@query(f"WITH {LCUBE}, n AS (SELECT *, {_ISLANDS} AS k FROM lcube) SELECT cell, day, CAST(k - coalesce(max(CASE WHEN NOT coalesce(rain < 20, false) THEN k END) OVER ({_W}), 0) AS INTEGER) AS dry, CAST(k - coalesce(max(CASE WHEN rain > 0 THEN k END) OVER ({_W}), 0) AS INTEGER) AS rainless FROM n")
def dry_run_length(spark, sf):
    """A missing day ends a run of low rain; the second run counts days without any."""
    c = lcube(spark, sf)
    return W.run_lengths(c, W.along(), dry=F.col("rain") < 20, rainless=F.coalesce("rain", F.lit(0.0)) <= 0).select("cell", "day", "dry", "rainless")


@query(f"WITH {ECUBE}, n AS (SELECT *, {_ISLANDS} AS k, max(CASE WHEN is_fire = 1 THEN day END) OVER ({_W}) AS last FROM ecube) SELECT cell, day, CAST(coalesce(day - last, k) AS INTEGER) AS since, CAST(day - last AS INTEGER) AS since_or_null FROM n")
def time_since_event(spark, sf):
    w = W.along()
    out = W.days_since(ecube(spark, sf), w, F.col("is_fire") == 1, "since")
    return W.days_since(out, w, F.col("is_fire") == 1, "since_or_null", before_first="null").select("cell", "day", "since", "since_or_null")


@query(f"WITH {ECUBE}, n AS (SELECT *, {_ISLANDS} AS k FROM ecube) SELECT cell, day, CAST(coalesce(k - max(CASE WHEN is_fire = 1 THEN k END) OVER ({_W}), k + cell % 9) AS INTEGER) AS since FROM n")
def seeded_counter(spark, sf):
    """Counts go on from a stored one; the seed stands for days before the band."""
    return W.counter(ecube(spark, sf), W.along(), F.col("is_fire") == 1, F.pmod("cell", F.lit(9)), "since").select("cell", "day", "since")


@query(f"WITH {ECUBE} SELECT cell, day, CASE WHEN row_number() OVER ({_W}) >= 10 THEN CAST(sum(is_fire) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT) END AS n FROM ecube")
def event_frequency(spark, sf):
    return ecube(spark, sf).select("cell", "day", W.strict_sum(F.col("is_fire"), 10, W.along(), whole=True).alias("n"))


@query(f"WITH {LCUBE}, z AS (SELECT *, dayofyear(day) AS doy FROM lcube) SELECT cell, day, CASE WHEN rain IS NOT NULL THEN round(least(greatest((rain - avg(rain) OVER w) / (stddev_pop(rain) OVER w + 1e-6), -10), 10), 6) + 0.0 END AS z FROM z WINDOW w AS (PARTITION BY cell, doy)")
def zscore_all_years(spark, sf):
    c = lcube(spark, sf).withColumn("doy", F.dayofyear("day"))
    return c.select("cell", "day", r(W.zscore(F.col("rain"), ["cell", "doy"])).alias("z"))


@query(f"WITH {LCUBE}, s AS (SELECT *, dayofyear(day) AS doy FROM lcube), z AS (SELECT cell, day, rain, count(rain) OVER w AS n, sum(rain) OVER w AS a, sum(rain * rain) OVER w AS b FROM s WINDOW w AS (PARTITION BY cell, doy ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT cell, day, CASE WHEN n >= 2 AND rain IS NOT NULL THEN round(least(greatest((rain - a / n) / (sqrt(greatest(b / n - (a / n) * (a / n), 0)) + 1e-6), -10), 10), 6) + 0.0 END AS z FROM z")
def zscore_causal(spark, sf):
    c = lcube(spark, sf).withColumn("doy", F.dayofyear("day"))
    return c.select("cell", "day", r(W.causal_zscore(F.col("rain"), ["cell", "doy"], "day")).alias("z"))


DRY = "WITH RECURSIVE " + LCUBE + """, y AS (SELECT cell, sum(rain) / ((max(day) - min(day) + 1) / 365.25) AS annual FROM lcube GROUP BY cell),
s AS (SELECT l.cell, l.day, row_number() OVER (PARTITION BY l.cell ORDER BY l.day) AS k, coalesce(l.rain, 0) / 10 AS rain, l.tmax, y.annual FROM lcube l JOIN y ON y.cell = l.cell),
walk AS (SELECT cell, CAST(0 AS BIGINT) AS k, 0.0::DOUBLE AS q, 0.0::DOUBLE AS wet FROM y
UNION ALL
SELECT s.cell, s.k, least(g.g + greatest((203.2 - g.g) * (0.968 * exp(0.0875 * s.tmax + 1.5552) - 8.30) / (1 + 10.88 * exp(-0.001736 * s.annual)) * 1e-3, 0), 203.2), g.spell
FROM walk w JOIN s ON s.cell = w.cell AND s.k = w.k + 1,
LATERAL (SELECT CASE WHEN s.rain > 0 THEN w.wet + s.rain ELSE 0 END AS spell, greatest(w.q - CASE WHEN s.rain > 0 THEN greatest(w.wet + s.rain - 5.08, 0) - greatest(w.wet - 5.08, 0) ELSE 0 END, 0) AS g) g)
SELECT CAST(s.cell AS BIGINT) AS cell, s.day, round(w.q, 4) + 0.0 AS q, round(w.wet, 4) + 0.0 AS wet FROM walk w JOIN s ON s.cell = w.cell AND s.k = w.k"""


def _annual(cube):
    years = (F.datediff(F.max("day"), F.min("day")) + 1) / 365.25
    return cube.join(cube.groupBy("cell").agg((F.sum("rain") / years).alias("annual")), "cell").withColumn("rain", F.coalesce("rain", F.lit(0.0)) / 10)


@query(DRY)
def drought_index(spark, sf):
    return rounded(recursive.drought(_annual(lcube(spark, sf))), 4)


@query(f"WITH {LCUBE}, n AS (SELECT *, sum(rain) OVER ({_W}) AS total, max(rain) OVER ({_W}) AS top, lag(rain) OVER ({_W}) AS before FROM lcube) SELECT cell, day, total, top, before FROM n")
def running_sum_max_lag(spark, sf):
    w = W.along()
    total, top = W.running(F.col("rain"), w)
    return lcube(spark, sf).select("cell", "day", total.alias("total"), top.alias("top"), F.lag("rain").over(w).alias("before"))


def _horizon(h: int):
    def run(spark, sf):
        return ecube(spark, sf).select("cell", "day", W.within_horizon(F.col("is_fire") == 1, h, W.along()).alias("y"))

    run.__name__ = f"horizon_{h}"
    query(f"WITH {ECUBE} SELECT cell, day, CASE WHEN count(*) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) = {h} THEN CAST(max(is_fire) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS INTEGER) END AS y FROM ecube")(run)


for _h in (1, 3, 7):
    _horizon(_h)


@query(f"WITH {LCUBE}, e AS (SELECT *, greatest(18 + rain / 10, 0) AS x FROM lcube) SELECT cell, day, round(lead(tmax, 2) OVER ({_W}), 6) + 0.0 AS substitute, round(tmax, 6) + 0.0 AS own, lead(rain, 2) OVER ({_W}) AS complement FROM e")
def lead_substitute_complement(spark, sf):
    from ..plans.model import with_lead

    w = W.along()
    both = with_lead(lcube(spark, sf), ["rain"], 2, True, w).withColumn("own", F.col("tmax"))
    out = with_lead(both, ["tmax"], 2, False, w)
    return out.select("cell", "day", r("tmax").alias("substitute"), r("own").alias("own"), F.col("rain_lead2").alias("complement"))


@query(f"WITH {LCUBE} SELECT cell, day, round(greatest(0.6108 * exp(17.625 * tmax / (tmax + 243.04)) * (1 - least(coalesce(rain, 0), 100) / 100), 0), 6) + 0.0 AS vpd_mean, CAST(row_number() OVER ({_W}) AS INTEGER) AS k FROM lcube")
def legacy_columns(spark, sf):
    """Columns of the retired set: mean vapour deficit; days are numbered for its rain counter."""
    rh = F.least(F.coalesce("rain", F.lit(0.0)), F.lit(100.0))
    return lcube(spark, sf).select("cell", "day", r(S.vapour_deficit(F.col("tmax"), rh)).alias("vpd_mean"), F.row_number().over(W.along()).alias("k"))
