"""Aggregations: days, blocks, regions, drift, agreement."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import sampling, spatial
from ..plans import serving
from .base import ECUBE, LCUBE, PLOT, SCORES, WIDE, ecube, events, lcube, query, r, rounded, scores, table


@query("SELECT CAST(ts AS DATE) AS day, CAST(user_id AS INTEGER) AS cell, count(*) AS n, round(avg(value), 4) + 0.0 AS mean, min(value) AS low, max(value) AS high, round(max(value) - min(value), 6) + 0.0 AS range FROM events GROUP BY 1, 2")
def daily_stats(spark, sf):
    e = events(spark, sf).groupBy("day", "cell").agg(F.count("*").alias("n"), *A.spread_of("value"))
    return e.select("day", "cell", "n", r("value_mean", 4).alias("mean"), F.col("value_min").alias("low"), F.col("value_max").alias("high"), r("value_range").alias("range"))


_STATION = "s AS (SELECT ts, CAST(ts AS DATE) AS day, CAST(user_id % 5 AS INTEGER) AS src_id, value AS t2m, 100 - value AS rh, 1000 - value AS pressure, value * 3.6 / 3.6 AS speed, sin(radians((event_id % 360)::DOUBLE)) AS si, cos(radians((event_id % 360)::DOUBLE)) AS co FROM events)"


def _station(spark, sf):
    e = table(spark, sf, "events")
    v = F.col("value")
    return e.select("ts", F.pmod("user_id", F.lit(5)).cast("int").alias("src_id"), v.alias("t2m"), (100 - v).alias("rh"), (1000 - v).alias("pressure"), (v * 3.6).alias("speed_kmh"), F.pmod("event_id", F.lit(360)).cast("double").alias("direction"), (v / 100).alias("soil_moisture"), (v / 2).alias("soil_temperature"), v.alias("precipitation"))


@query(f"WITH {_STATION} SELECT day, src_id, count(*) AS hours, round(avg(t2m), 8) + 0.0 AS t2m_mean, round(max(t2m) - min(t2m), 8) + 0.0 AS t2m_range, round(min(rh), 8) + 0.0 AS rh_min, round(max(speed), 8) + 0.0 AS wind_speed_max, round(avg(-speed * si), 8) + 0.0 AS wind_u_mean, round(avg(-speed * co), 8) + 0.0 AS wind_v_mean, round(sum(t2m) / 24, 8) + 0.0 AS total_precipitation_mean FROM s GROUP BY 1, 2")
def daily_weather(spark, sf):
    """The whole family of daily variables from hours, of which some are shown."""
    out = A.daily(_station(spark, sf)).select("day", "src_id", "hours", "t2m_mean", "t2m_range", "rh_min", "wind_speed_max", "wind_u_mean", "wind_v_mean", "total_precipitation_mean")
    return rounded(out, 8)


@query(f"WITH {_STATION}, k AS (SELECT *, row_number() OVER (PARTITION BY day, src_id ORDER BY t2m DESC, ts) AS k FROM s) SELECT day, src_id, round(-speed * si, 4) + 0.0 AS u, round(-speed * co, 4) + 0.0 AS v FROM k WHERE k = 1")
def argmax_companion(spark, sf):
    return A.daily(_station(spark, sf)).select("day", "src_id", r("wind_u_atmaxspeed", 4).alias("u"), r("wind_v_atmaxspeed", 4).alias("v"))


@query("WITH h AS (SELECT CAST(ts AS DATE) AS day, user_id % 5 AS s, count(DISTINCT hour(ts)) AS hours FROM events GROUP BY 1, 2) SELECT day, CAST(s AS INTEGER) AS src_id FROM h WHERE hours = 24")
def complete_days(spark, sf):
    hours = _station(spark, sf).groupBy(F.date_trunc("hour", "ts").alias("ts"), "src_id").agg(*[F.avg(c).alias(c) for c in ("t2m", "rh", "pressure", "speed_kmh", "direction", "soil_moisture", "soil_temperature", "precipitation")])
    return A.daily(hours, need=24).select("day", "src_id")


_BLOCK = "CAST((cell // 10) // 2 * 5 + (cell % 10) // 2 AS INTEGER)"


@query(f"WITH {ECUBE} SELECT day, {_BLOCK} AS cell, max(is_fire) AS is_fire, max(mean) AS t2m_max, min(mean) AS rh_min, round(avg(mean), 8) + 0.0 AS t2m_mean, mode_min AS code FROM (SELECT *, 0 AS mode_min FROM ecube) GROUP BY day, {_BLOCK}, mode_min")
def block_pool(spark, sf):
    c = ecube(spark, sf).select("day", "cell", "is_fire", F.col("mean").alias("t2m_max"), F.col("mean").alias("rh_min"), F.col("mean").alias("t2m_mean"), F.lit(0).alias("code"))
    return rounded(spatial.block_pool(c, WIDE, 2, ["is_fire", "t2m_max", "rh_min", "t2m_mean"], codes=("code",)), 8, "t2m_max", "rh_min")


@query(f"WITH {ECUBE}, m AS (SELECT {_BLOCK} AS block, ev.event_type AS code, count(*) AS n FROM ev GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY n DESC, code) AS k FROM m) SELECT block AS cell, code FROM k WHERE k = 1")
def mode_pool(spark, sf):
    return spatial.block_pool(events(spark, sf).withColumn("code", F.col("event_type")), WIDE, 2, [], keys=(), codes=("code",))


@query("SELECT CAST((x // 2) * 20 + y AS INTEGER) AS cell, count(*) AS n, CAST(1 AS INTEGER) AS is_fire FROM (SELECT CAST(c_custkey % 40 AS INTEGER) AS x, CAST(c_custkey % 20 AS INTEGER) AS y FROM customer) GROUP BY 1")
def rasterize(spark, sf):
    """Points to cells by nearest index, as presence and count."""
    from ..functions.scalars import grid_index

    x, y = F.pmod("c_custkey", F.lit(40)), F.pmod("c_custkey", F.lit(20))
    c = table(spark, sf, "customer").select((grid_index((x - F.pmod(x, F.lit(2))).cast("double"), 0.0, 2.0) * 20 + grid_index(y.cast("double"), 0.0, 1.0)).cast("int").alias("cell"))
    return c.groupBy("cell").agg(F.count("*").alias("n"), F.lit(1).alias("is_fire"))


@query(f"WITH {ECUBE} SELECT DISTINCT day, cell FROM ev WHERE event_type IN ('error', 'click', 'view')")
def union_sources(spark, sf):
    """A cell is burning if any of three sources says so."""
    e = events(spark, sf)
    parts = [e.where(F.col("event_type") == t).select("day", "cell") for t in ("error", "click", "view")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


_SCORED = f"""WITH {ECUBE}, s AS (SELECT day, cell, is_fire, max(CASE WHEN is_fire = 1 THEN day END) OVER (PARTITION BY cell ORDER BY day) AS last, row_number() OVER (PARTITION BY cell ORDER BY day) AS k, coalesce(mean, 0) / 100 AS p FROM ecube),
scored AS (SELECT s.day, s.cell, s.p, CASE WHEN coalesce(s.day - s.last, s.k) <= 6 THEN 2 ELSE 1 END AS regime, n.n_regionkey AS region, g.r_name AS name FROM s JOIN customer c ON c.c_custkey = s.cell JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region g ON g.r_regionkey = n.n_regionkey)"""


def scored(spark, sf):
    """Cells and days with a score, the regime by days since the last event, and the region of the cell's customer."""
    from ..operators import windows as W

    c = W.days_since(ecube(spark, sf), W.along(), F.col("is_fire") == 1, "since").withColumn("p", F.coalesce("mean", F.lit(0.0)) / 100)
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    place = table(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("int").alias("cell"), F.col("n_regionkey").alias("region"), F.col("r_name").alias("name"))
    return c.join(place, "cell").select("day", "cell", "p", serving.regime(F.col("since")).alias("regime"), "region", "name")


@query(f"{_SCORED} SELECT region, name, CASE WHEN regime = 2 THEN 'spread' ELSE 'ignition' END AS regime, count(*) AS n_cells, round(avg(p), 6) + 0.0 AS mean_prob, max(p) AS max_prob, round(sum(p), 4) + 0.0 AS expected_count, count(*) FILTER (p >= 0.2) AS n_alert FROM scored GROUP BY ALL")
def region_regime_summary(spark, sf):
    """Flagship: the risk summary by region and regime."""
    s = A.risk_summary(scored(spark, sf), 0.2, ("region", "name", "regime"))
    return s.select("region", "name", F.when(F.col("regime") == 2, "spread").otherwise("ignition").alias("regime"), "n_cells", r("mean_prob").alias("mean_prob"), "max_prob", r("expected_count", 4).alias("expected_count"), "n_alert")


@query(f"WITH {LCUBE} SELECT cell, round(sum(24 * rain) / ((SELECT (max(day) - min(day) + 1) / 365.25 FROM lcube)), 4) + 0.0 AS annual FROM lcube GROUP BY cell")
def annual_rain(spark, sf):
    from ..plans.features import annual_rain as of

    return rounded(of(lcube(spark, sf).withColumnRenamed("rain", "total_precipitation_mean")), 4)


@query(f"WITH {LCUBE}, u AS (SELECT 'rain' AS feature, rain AS v FROM lcube UNION ALL SELECT 'tmax', tmax FROM lcube) SELECT feature, round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v), 6) + 0.0 AS std, round(min(v), 6) + 0.0 AS min, round(max(v), 6) + 0.0 AS max, round(avg(CASE WHEN v IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS nan_frac FROM u GROUP BY feature")
def feature_stats(spark, sf):
    return rounded(A.drift(lcube(spark, sf), ["rain", "tmax"]))


@query("WITH u AS (SELECT 'flat' AS feature, 1.0::DOUBLE AS v FROM part UNION ALL SELECT 'size', p_size FROM part) SELECT feature, round(avg(v), 6) + 0.0 AS mean, round(greatest(stddev_pop(v), 1e-6), 6) + 0.0 AS std FROM u GROUP BY feature")
def norm_stats(spark, sf):
    p = table(spark, sf, "part").select(F.lit(1.0).alias("flat"), F.col("p_size").cast("double").alias("size"))
    return rounded(A.norm_stats(p, ["flat", "size"]))


@query(f"WITH {ECUBE} SELECT count(*) AS n, CAST(sum(is_fire) AS BIGINT) AS pos, CAST(count(*) - sum(is_fire) AS BIGINT) AS neg, round(sum(is_fire) / count(*)::DOUBLE, 6) + 0.0 AS share FROM ecube")
def class_stats(spark, sf):
    pos, n = F.sum("is_fire"), F.count("*")
    return ecube(spark, sf).agg(n.alias("n"), pos.alias("pos"), (n - pos).alias("neg"), r(pos / n).alias("share"))


@query(f"WITH {ECUBE} SELECT day, CAST(sum(is_fire) AS BIGINT) AS n, sum(is_fire) > 0 AS any FROM ecube GROUP BY day")
def event_day_index(spark, sf):
    n = F.sum("is_fire")
    return ecube(spark, sf).groupBy("day").agg(n.alias("n"), (n > 0).alias("any"))


@query(f"WITH {LCUBE}, y AS (SELECT cell, day, dayofyear(day) AS doy, CASE WHEN rain > 25 THEN 1 ELSE 0 END AS e FROM lcube), t AS (SELECT cell, doy, avg(e::DOUBLE) AS rate FROM y WHERE year(day) < 2000 GROUP BY 1, 2) SELECT y.cell, y.day, round(coalesce(t.rate, 0), 6) + 0.0 AS rate FROM y LEFT JOIN t ON t.cell = y.cell AND t.doy = y.doy WHERE year(y.day) >= 2000")
def climatology_score(spark, sf):
    c = lcube(spark, sf).withColumns({"doy": F.dayofyear("day"), "e": F.when(F.col("rain") > 25, 1).otherwise(0)})
    return A.climatology(c, "e", F.year("day") < 2000).where(F.year("day") >= 2000).select("cell", "day", r("rate").alias("rate"))


@query(f"WITH {SCORES} SELECT regime, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, round(ln((sum(y) + 1e-8) / (count(*) - sum(y) + 1e-8)), 6) + 0.0 AS log_odds FROM scores GROUP BY regime")
def regime_priors(spark, sf):
    return rounded(A.regime_priors(scores(spark, sf), "y"))


@query(f"WITH {ECUBE}, a AS (SELECT DISTINCT day, cell FROM ev WHERE event_type = 'error'), b AS (SELECT DISTINCT day, cell FROM ev WHERE event_type = 'click'), j AS (SELECT a.day AS x, b.day AS y FROM a FULL JOIN b ON a.day = b.day AND a.cell = b.cell), k AS (SELECT count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS \"both\", count(*) FILTER (y IS NULL) AS only_a, count(*) FILTER (x IS NULL) AS only_b, count(*) AS either FROM j) SELECT \"both\", only_a, only_b, either, round(\"both\" / either::DOUBLE, 6) + 0.0 AS jaccard, round(\"both\" / (\"both\" + only_a)::DOUBLE, 6) + 0.0 AS recall_of_a, round(\"both\" / (\"both\" + only_b)::DOUBLE, 6) + 0.0 AS recall_of_b, round(either / (\"both\" + only_a)::DOUBLE, 6) + 0.0 AS gain FROM k")
def set_overlap(spark, sf):
    e = events(spark, sf)
    return rounded(A.overlap(e.where("event_type = 'error'"), e.where("event_type = 'click'")))


@query(f"WITH {ECUBE}, d AS (SELECT day, count(*) FILTER (event_type = 'error') AS a, count(*) FILTER (event_type = 'click') AS b FROM ev GROUP BY day) SELECT round(corr(a, b), 6) + 0.0 AS r, count(*) AS days FROM d")
def count_corr(spark, sf):
    d = events(spark, sf).groupBy("day").agg(F.count_if(F.col("event_type") == "error").cast("double").alias("a"), F.count_if(F.col("event_type") == "click").cast("double").alias("b"))
    return d.agg(r(F.corr("a", "b")).alias("r"), F.count("*").alias("days"))


@query("WITH b AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey, CAST(l_shipdate AS DATE) AS day, l_returnflag = 'R' AS more FROM lineitem), c AS (SELECT year, l_suppkey, day, min(more) AS only_more FROM b GROUP BY ALL) SELECT year, count(*) AS cell_days, count(*) FILTER (only_more) AS gained FROM c GROUP BY ROLLUP (year)")
def rollup_density(spark, sf):
    """Cell-days by year and in all, and those that only the further source has."""
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), "l_suppkey", F.to_date("l_shipdate").alias("day"), (F.col("l_returnflag") == "R").alias("more"))
    c = li.groupBy("year", "l_suppkey", "day").agg(F.bool_and("more").alias("only"))
    return c.rollup("year").agg(F.count("*").alias("cell_days"), F.count_if("only").alias("gained"))


@query(f"WITH {ECUBE} SELECT max(day) AS last_day, count(DISTINCT day) FILTER (is_fire > 0) AS event_days, round(avg(CASE WHEN mean IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS mean_finite FROM ecube")
def verify_window(spark, sf):
    from ..plans.maintain import verified

    return rounded(verified(ecube(spark, sf), "is_fire", ["mean"]))


@query(f"{_SCORED} SELECT day, region, round(1 - product(1 - least(greatest(p, 0), 0.99)), 6) + 0.0 AS p_any FROM scored GROUP BY day, region")
def pagg_region(spark, sf):
    return scored(spark, sf).groupBy("day", "region").agg(r(A.any_event(F.col("p"))).alias("p_any"))


@query(f"{_SCORED}, m AS (SELECT name, max(p) AS top FROM scored GROUP BY name), k AS (SELECT *, row_number() OVER (ORDER BY top DESC, name) AS rank FROM m WHERE top >= 0.2) SELECT name, top, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 4")
def region_top(spark, sf):
    m = scored(spark, sf).groupBy("name").agg(F.max("p").alias("top")).where("top >= 0.2").withColumn("all", F.lit(1))
    return sampling.top(m, 4, F.col("top"), "name", ("all",)).select("name", "top", "rank")


@query(f"{_SCORED}, m AS (SELECT day, region, count(*) AS n FROM scored WHERE p > 0 GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, region) AS k FROM m) SELECT day, region FROM k WHERE k = 1")
def dominant_region(spark, sf):
    return scored(spark, sf).where("p > 0").groupBy("day").agg(F.mode("region", True).alias("region"))


@query(f"{_SCORED} SELECT round(quantile_cont(p, 0.99), 6) + 0.0 AS p99 FROM scored WHERE p > 0")
def p99_stretch(spark, sf):
    return rounded(serving.stretch(scored(spark, sf)))


@query("SELECT DISTINCT n_regionkey AS region FROM nation")
def distinct_regions(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_regionkey").alias("region")).distinct()


@query(f"WITH {LCUBE}, v AS (SELECT rain, avg(rain) OVER (PARTITION BY cell) AS other FROM lcube WHERE rain IS NOT NULL) SELECT round(avg(abs(rain - other)), 4) + 0.0 AS mae, round(corr(rain, other), 6) + 0.0 AS corr FROM v")
def grid_validation(spark, sf):
    v = lcube(spark, sf).where("rain is not null").withColumn("other", F.avg("rain").over(Window.partitionBy("cell")))
    return v.agg(r(F.avg(F.abs(F.col("rain") - F.col("other"))), 4).alias("mae"), r(F.corr("rain", "other")).alias("corr"))


@query("WITH x AS (SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b, (p_partkey % 13)::DOUBLE AS c FROM part), k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0::DOUBLE AS b, rank() OVER (ORDER BY c) + (count(*) OVER (PARTITION BY c) - 1) / 2.0::DOUBLE AS c FROM x) SELECT 'a' AS x, 'b' AS y, round(corr(a, b), 6) + 0.0 AS rho FROM k UNION ALL SELECT 'a', 'c', round(corr(a, c), 6) + 0.0 FROM k UNION ALL SELECT 'b', 'c', round(corr(b, c), 6) + 0.0 FROM k")
def spearman(spark, sf):
    """Rank correlations of feature pairs, of which clusters are cut."""
    from ..operators.correlation import spearman_pairs

    p = table(spark, sf, "part").select(F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"), F.pmod("p_partkey", F.lit(13)).cast("double").alias("c"))
    return rounded(spearman_pairs(p, ["a", "b", "c"]))


@query(f"WITH {SCORES}, l AS (SELECT regime, CASE WHEN y = 1 THEN pow(1 - q, 2) * -ln(q) ELSE pow(q, 2) * -ln(1 - q) END AS loss, CASE WHEN y = 1 THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM (SELECT *, least(greatest(p, 1e-6), 1 - 1e-6) AS q FROM scores)) SELECT regime, round(sum(w * loss) / sum(w), 6) + 0.0 AS loss FROM l GROUP BY regime")
def focal_loss(spark, sf):
    from ..functions.nulls import clip

    q = clip(F.col("p"), 1e-6, 1 - 1e-6)
    s = scores(spark, sf).select("regime", F.when(F.col("y") == 1, (1 - q) * (1 - q) * -F.ln(q)).otherwise(q * q * -F.ln(1 - q)).alias("loss"), F.when(F.col("y") == 1, 4.0).otherwise(1.0).alias("w"))
    return s.groupBy("regime").agg(r(F.sum(F.col("w") * F.col("loss")) / F.sum("w")).alias("loss"))


@query(f"{_SCORED} SELECT round(sum(p) * 400, 2) + 0.0 AS area_ha, count(*) FILTER (p > 1e-4) AS n_cells FROM scored")
def expected_area(spark, sf):
    return rounded(serving.expected_area(scored(spark, sf), 400.0), 2)


@query(f"{_SCORED}, m AS (SELECT name, CASE WHEN max(p) >= 0.1276 THEN 'High' WHEN max(p) >= 0.035728 THEN 'Elevated' WHEN max(p) >= 0.008932 THEN 'Moderate' ELSE 'Low' END AS tier FROM scored GROUP BY name) SELECT tier, string_agg(name, ', ' ORDER BY name) AS regions, count(*) AS n FROM m GROUP BY tier")
def tier_groups(spark, sf):
    return serving.tiers(scored(spark, sf), region="name")


@query(f"WITH {SCORES} SELECT count(*) FILTER (p >= 0.5) AS predicted, round(avg(y::DOUBLE), 6) + 0.0 AS actual FROM scores")
def predicted_and_actual(spark, sf):
    return scores(spark, sf).agg(F.count_if(F.col("p") >= 0.5).alias("predicted"), r(F.avg(F.col("y").cast("double"))).alias("actual"))


@query("WITH s AS (SELECT CAST(s_suppkey AS INTEGER) AS cell FROM supplier) SELECT CAST((cell // 10) // 2 * 5 + (cell % 10) // 2 AS INTEGER) AS block, avg(2000.0::DOUBLE * (cell % 10)) AS x_m, avg(-2000.0::DOUBLE * (cell // 10)) AS y_m FROM s GROUP BY 1")
def coarse_centres(spark, sf):
    """A block's centre is the mean of its cells' centres."""
    c = F.col("cell")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("cell"))
    return s.select(PLOT.block(c, 2).alias("block"), PLOT.easting(c).alias("x"), PLOT.northing(c).alias("y")).groupBy("block").agg(F.avg("x").alias("x_m"), F.avg("y").alias("y_m"))
