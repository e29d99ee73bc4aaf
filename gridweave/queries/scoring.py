"""Metrics, sampling, models and what is served."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics, sampling
from ..plans import boosting, model, serving
from ..schema import CAUSES
from .aggregates import _SCORED, scored
from .base import ECUBE, SCORES, ecube, query, r, rounded, scores, table


@query(f"WITH {SCORES} SELECT round((SELECT sum(CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) FROM scores a, scores b WHERE a.y = 1 AND b.y = 0) / (sum(y) * (count(*) - sum(y))), 6) + 0.0 AS auc, CAST(sum(y) AS BIGINT) AS n_pos, CAST(count(*) - sum(y) AS BIGINT) AS n_neg FROM scores")
def auc_rank(spark, sf):
    return rounded(metrics.roc_auc(scores(spark, sf), "p", "y"))


@query(f"WITH {SCORES}, g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM scores GROUP BY p), c AS (SELECT pos, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER (ORDER BY p DESC) AS cp FROM g) SELECT round(sum(pos * (cp / cn::DOUBLE)) / sum(pos), 6) + 0.0 AS ap FROM c")
def ap_cumulative(spark, sf):
    return rounded(metrics.average_precision(scores(spark, sf), "p", "y"))


@query(f"WITH {SCORES}, k AS (SELECT y, row_number() OVER (ORDER BY p DESC, doc_id) AS k, sum(y) OVER () AS n FROM scores) SELECT round(sum(y) FILTER (k <= n) / any_value(n)::DOUBLE, 6) + 0.0 AS precision, CAST(any_value(n) AS BIGINT) AS k FROM k")
def r_precision(spark, sf):
    return rounded(metrics.r_precision(scores(spark, sf), "p", "y", "doc_id"))


_BINS = " + ".join(f"CAST(p >= {e!r} AS INTEGER)" for e in metrics.edges()[1:-1])


@query(f"WITH {SCORES}, b AS (SELECT *, {_BINS} AS bin FROM scores) SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) + 0.0 AS mean_p, round(avg(y::DOUBLE), 6) + 0.0 AS mean_y FROM b GROUP BY bin")
def reliability(spark, sf):
    return rounded(metrics.reliability(scores(spark, sf), "p", "y"))


@query(f"WITH {SCORES}, b AS (SELECT *, {_BINS} AS bin FROM scores), g AS (SELECT bin, count(*) AS n, avg(p) AS mp, avg(y::DOUBLE) AS my FROM b GROUP BY bin) SELECT round((SELECT sum(n * abs(mp - my)) / sum(n) FROM g), 6) + 0.0 AS ece, round(avg((p - y) * (p - y)), 6) + 0.0 AS brier FROM scores")
def brier_ece(spark, sf):
    return rounded(metrics.calibration(scores(spark, sf), "p", "y"))


@query(f"WITH {SCORES}, m AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR))) AS k, sum(y) OVER () AS n FROM scores) SELECT doc_id, y FROM m WHERE y = 1 OR k <= n * 2")
def matched_negatives(spark, sf):
    return sampling.matched(scores(spark, sf), "y", 2, "doc_id").select("doc_id", "y")


def _matched_ap(where: str) -> str:
    return f"(WITH l AS (SELECT * FROM land WHERE y = 0 OR {where}), m AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR))) AS k, sum(y) OVER () AS n FROM l), s AS (SELECT * FROM m WHERE y = 1 OR k <= n * 2), g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM s GROUP BY p), c AS (SELECT pos, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER (ORDER BY p DESC) AS cp FROM g) SELECT round(sum(pos * (cp / cn::DOUBLE)) / sum(pos), 6) + 0.0 FROM c)"


@query(f"WITH {SCORES}, land AS (SELECT * FROM scores WHERE regime > 0), r AS (SELECT y, row_number() OVER (ORDER BY p DESC, doc_id) AS k, sum(y) OVER () AS n FROM land) SELECT round((SELECT sum(CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) FROM land a, land b WHERE a.y = 1 AND b.y = 0) / (SELECT sum(y) * (count(*) - sum(y)) FROM land), 6) + 0.0 AS roc, (SELECT CAST(sum(y) AS BIGINT) FROM land) AS n_pos, {_matched_ap('true')} AS overall_ap, {_matched_ap('regime = 1')} AS new_ap, {_matched_ap('regime = 2')} AS spread_ap, (SELECT round(sum(y) FILTER (k <= n) / any_value(n)::DOUBLE, 6) + 0.0 FROM r) AS prec_at_k")
def regime_metrics(spark, sf):
    return rounded(metrics.regime_metrics(scores(spark, sf), "p", "y", "regime", "doc_id", ratio=2))


@query(f"WITH {ECUBE}, e AS (SELECT *, CASE WHEN is_fire = 1 AND cell % 25 = 0 THEN 1 ELSE 0 END AS y FROM ecube), k AS (SELECT *, row_number() OVER (PARTITION BY day, y ORDER BY md5(concat_ws('|', CAST(cell AS VARCHAR), CAST(day AS VARCHAR)))) AS k, sum(y) OVER (PARTITION BY day) AS pos FROM e) SELECT day, cell, CAST(y AS INTEGER) AS y FROM k WHERE y = 1 OR k <= 5 * greatest(pos, 1)")
def neg_sample_deterministic(spark, sf):
    c = ecube(spark, sf).withColumn("y", F.when((F.col("is_fire") == 1) & (F.col("cell") % 25 == 0), 1).otherwise(0))
    return sampling.negatives_per_day(c, "y", "cell", 5).select("day", "cell", "y")


@query(f"WITH {ECUBE}, b AS (SELECT min(day) AS a, max(day) AS b FROM ecube) SELECT day, cell, CASE WHEN day - a < floor((b - a + 1) * 0.8) THEN 'train' ELSE 'val' END AS part FROM ecube, b")
def chrono_split(spark, sf):
    return sampling.chronological(ecube(spark, sf)).select("day", "cell", "part")


@query(f"WITH {ECUBE} SELECT day, cell, CAST(CASE WHEN max(CASE WHEN cell < 2 THEN is_fire ELSE 0 END) OVER (PARTITION BY day) = 1 THEN 10 ELSE 1 END AS INTEGER) AS weight FROM ecube")
def weighted_days(spark, sf):
    c = ecube(spark, sf).withColumn("e", F.when(F.col("cell") < 2, F.col("is_fire")).otherwise(0))
    return sampling.weighted_days(c, "e").select("day", "cell", "weight")


_PHRASES = "[" + ", ".join(f"CASE WHEN list_has_any(f, {list(names)!r}) THEN '{phrase}' END" for names, phrase in CAUSES) + "]"


@query(f"WITH b AS (SELECT p_partkey, list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'kbdi' END, CASE WHEN p_partkey % 3 = 0 THEN 't2m_max' END, CASE WHEN p_partkey % 5 = 0 THEN 'fvc' END, CASE WHEN p_partkey % 7 = 0 THEN 'dist_to_fire' END], lambda x: x IS NOT NULL) AS f FROM part) SELECT p_partkey, array_to_string(list_slice(list_filter({_PHRASES}, lambda x: x IS NOT NULL), 1, 2), '; ') AS causes FROM b")
def causes(spark, sf):
    k = F.col("p_partkey")
    features = F.filter(F.array(*[F.when(k % n == 0, F.lit(f)) for n, f in ((2, "kbdi"), (3, "t2m_max"), (5, "fvc"), (7, "dist_to_fire"))]), lambda x: x.isNotNull())
    return table(spark, sf, "part").select("p_partkey", F.array_join(serving.causes(features), "; ").alias("causes"))


def _learning(spark, sf):
    """(day, cell, x1..x3, y): features of a day, the event of the next; cached, since fitting reads the rows many times and they come out of windows."""
    w = Window.partitionBy("cell").orderBy("day")
    c = ecube(spark, sf).withColumns({"y": F.lead("is_fire").over(w), "x1": F.col("mean"), "x2": F.col("n").cast("double"), "x3": F.sum("n").over(w.rowsBetween(-6, 0)).cast("double")})
    return sampling.chronological(c.where("y is not null").persist()).withColumn("regime", F.when(F.col("n") > 2, 2).otherwise(1))


_X = ["x1", "x2", "x3"]


@query()
def gbt_predict(spark, sf):
    """Boosted trees on the first three fifths of the days, calibrated on the fourth, scores of the last."""
    data = _learning(spark, sf)
    fit = sampling.chronological(data.where("part = 'train'").drop("part"), share=0.75)
    m = model.boosted(fit.where("part = 'train'"), _X, trees=5, depth=3)
    held = model.isotonic(model.scored(m, fit.where("part = 'val'"), _X))
    return model.calibrated(held, model.scored(m, data.where("part = 'val'"), _X)).select("day", "cell", "y", r("p").alias("p"))


@query()
def histogram_boosting(spark, sf):
    """Boosted trees over histograms, missing values with a side of their own, stopped by held-out rows of the training days."""
    data = _learning(spark, sf)
    m = boosting.fit(data.where("part = 'train'"), _X, rounds=10, depth=3, rate=0.2)
    return boosting.scored(m, data.where("part = 'val'")).select("day", "cell", "y", r("p").alias("p"))


@query()
def logistic_floor(spark, sf):
    data = _learning(spark, sf)
    return model.scored(model.logistic(data.where("part = 'train'"), _X), data.where("part = 'val'"), _X).select("day", "cell", "y", r("p").alias("p"))


@query()
def drivers(spark, sf):
    """What the riskiest cells' scores owe to each feature."""
    data = _learning(spark, sf)
    m = model.logistic(data.where("part = 'train'"), _X)
    found = serving.drivers(data.where("part = 'val'").select("cell", "regime", *_X), _X, lambda d: model.scored(m, d, _X))
    return found.select("regime", "feature", r("drop").alias("drop"), "rank")


def _logistic(train, names):
    """What adds p, fitted on train."""
    m = model.logistic(train, names)
    return lambda df: model.scored(m, df, names)


@query()
def label_definitions(spark, sf):
    """Metrics of models that are fitted and judged by different definitions of an event."""
    c = ecube(spark, sf)
    w = Window.partitionBy("cell").orderBy("day")
    derive = lambda d: d.select("day", "cell", F.concat_ws("|", "day", "cell").alias("id"), F.lead("is_fire").over(w).alias("y"), F.col("mean").alias("x1"), F.col("n").cast("double").alias("x2"))
    labels = {"any": F.col("is_fire"), "busy": F.col("is_fire") * (F.col("n") > 1).cast("int"), "high": (F.coalesce("mean", F.lit(0.0)) > 60).cast("int")}
    found = model.by_definition(c, labels, derive, ["x1", "x2"], _logistic)
    return rounded(spark.createDataFrame([tuple(r.values()) for r in found], "label string, ap double, auc double, precision_at_k double, n_pos long, n_neg long"))


@query()
def forecast_gain(spark, sf):
    """Precision without a forecast, with one in place of the day's weather, and with both."""
    data = _learning(spark, sf).drop("part")
    found = model.forecast_gain(data, _X, ["x1", "x2"], _logistic)
    return rounded(spark.createDataFrame(list(found.items()), "features string, ap double"))


@query()
def group_ablation(spark, sf):
    """Precision without each group of features."""
    data = _learning(spark, sf).withColumnsRenamed({"x1": "t2m_mean", "x2": "popdens", "x3": "kbdi"})
    rows = model.without_groups(data.where("part = 'train'"), data.where("part = 'val'"), ["t2m_mean", "popdens", "kbdi"])
    return spark.createDataFrame(rows, "without string, ap double")


@query()
def feature_importance(spark, sf):
    data = _learning(spark, sf)
    m = model.logistic(data.where("part = 'train'"), _X)
    val = data.where("part = 'val'").withColumn("id", F.concat_ws("|", "day", "cell"))
    return spark.createDataFrame(model.importance(m, val, _X, "y", "id", repeats=1), "feature string, drop double")


@query(f"WITH {ECUBE}, b AS (SELECT cell, day, is_fire AS y, -coalesce(day - max(CASE WHEN is_fire = 1 THEN day END) OVER (PARTITION BY cell ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 99)::DOUBLE AS persistence FROM ecube), g AS (SELECT persistence AS p, count(*) AS n, sum(y) AS pos FROM b GROUP BY 1), c AS (SELECT pos, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER (ORDER BY p DESC) AS cp FROM g) SELECT round(sum(pos * (cp / cn::DOUBLE)) / sum(pos), 6) + 0.0 AS ap FROM c")
def persistence_baseline(spark, sf):
    before = Window.partitionBy("cell").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("is_fire") == 1, F.col("day"))).over(before)
    b = ecube(spark, sf).withColumn("p", -F.coalesce(F.datediff("day", last), F.lit(99)).cast("double"))
    return rounded(metrics.average_precision(b, "p", "is_fire"))


@query(f"{_SCORED}, d AS (SELECT * FROM scored WHERE day = DATE '2024-01-15') SELECT 'inference' AS kind, region || '/' || regime AS key, round(avg(p), 6) + 0.0 AS value FROM d WHERE region > 0 AND regime > 0 GROUP BY region, regime UNION ALL SELECT 'stats', 'p', round(avg(p), 6) + 0.0 FROM d UNION ALL SELECT 'stats', 'n', 1.0::DOUBLE FROM d HAVING count(*) > 0")
def serving_outputs(spark, sf):
    """The two tables of an issue date, one under the other in a long form."""
    s = scored(spark, sf).where("day = date'2024-01-15'").withColumn("n", F.lit(1.0))
    inference, stats = serving.daily_outputs(s, ["p", "n"], "2024-01-15", 0.2)
    a = inference.select(F.lit("inference").alias("kind"), F.concat_ws("/", "region", "regime").alias("key"), r("mean_prob").alias("value"))
    return a.unionByName(stats.select(F.lit("stats").alias("kind"), F.col("feature").alias("key"), r("mean").alias("value")))
