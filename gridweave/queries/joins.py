"""Alignment and joins in time and space; projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.calendar import holidays
from ..operators import sampling
from ..operators import temporal_join as J
from ..plans import maintain, serving
from ..sources import readers
from .base import ECUBE, LCUBE, SCORES, ecube, events, lcube, query, r, scores, table


@query(f"WITH {ECUBE}, a AS (SELECT day, cell, n FROM ecube), b AS (SELECT day, cell, is_fire FROM ecube WHERE day > DATE '2024-01-05') SELECT a.day, a.cell, a.n, b.is_fire, s.s_nationkey AS static FROM a JOIN b ON a.day = b.day AND a.cell = b.cell JOIN supplier s ON s.s_suppkey = a.cell")
def align_and_static(spark, sf):
    """Variables meet on (day, cell); static layers on the cell."""
    c = ecube(spark, sf)
    a, b = c.select("day", "cell", "n"), c.where("day > date'2024-01-05'").select("day", "cell", "is_fire")
    static = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("cell"), F.col("s_nationkey").alias("static"))
    return a.join(b, ["day", "cell"]).join(static, "cell").select("day", "cell", "n", "is_fire", "static")


@query("SELECT o.o_orderkey, isodow(o.o_orderdate) >= 6 AS weekend, CAST(month(o.o_orderdate) AS INTEGER) AS month FROM orders o")
def calendar_broadcast(spark, sf):
    """Values of a day sent to all of its rows: the calendar is one row a day."""
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    bounds = o.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = bounds.select(F.explode(F.sequence("a", "b")).alias("day")).select("day", (F.weekday("day") >= 5).alias("weekend"), F.month("day").alias("month"))
    return o.join(F.broadcast(calendar), "day").select("o_orderkey", "weekend", "month")


@query(f"WITH {ECUBE}, y AS (SELECT *, lead(is_fire) OVER (PARTITION BY cell ORDER BY day) AS y FROM ecube) SELECT cell, day, n, y FROM y WHERE y IS NOT NULL")
def label_lead(spark, sf):
    """Features of a day with the event of the next."""
    w = Window.partitionBy("cell").orderBy("day")
    return ecube(spark, sf).withColumn("y", F.lead("is_fire").over(w)).where("y is not null").select("cell", "day", "n", "y")


_PLACES = "src AS (SELECT CAST(s_suppkey AS INTEGER) AS src_id, (s_suppkey % 17 * 6)::DOUBLE AS px, (s_suppkey % 13 * 8)::DOUBLE AS py, s_acctbal AS value FROM supplier), tgt AS (SELECT CAST(c_custkey AS INTEGER) AS cell, (c_custkey % 101)::DOUBLE + 0.3 AS tx, (c_custkey % 97)::DOUBLE + 0.1 AS ty FROM customer)"


def _sources(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(k.cast("int").alias("src_id"), (F.pmod(k, F.lit(17)) * 6).cast("double").alias("px"), (F.pmod(k, F.lit(13)) * 8).cast("double").alias("py"), F.col("s_acctbal").alias("value"))


def _targets(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.cast("int").alias("cell"), (F.pmod(k, F.lit(101)) + 0.3).alias("tx"), (F.pmod(k, F.lit(97)) + 0.1).alias("ty"))


@query(f"WITH {_PLACES}, d AS (SELECT cell, src_id, value, greatest(sqrt((tx - px) * (tx - px) + (ty - py) * (ty - py)), 1) AS d FROM tgt CROSS JOIN src), k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(d, 9), src_id) AS k FROM d) SELECT cell, round(value, 4) + 0.0 AS value FROM k WHERE k = 1")
def nearest_point(spark, sf):
    from ..operators.spatial import interpolated

    s = _sources(spark, sf)
    return interpolated(s, _targets(spark, sf), k=1).select("cell", r("value", 4).alias("value"))


@query(f"WITH {_PLACES}, d AS (SELECT cell, src_id, value, greatest(sqrt((tx - px) * (tx - px) + (ty - py) * (ty - py)), 1) AS d FROM tgt CROSS JOIN src), k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY d, src_id) AS k FROM d) SELECT cell, round(sum(value / (d * d)) / sum(1 / (d * d)), 4) + 0.0 AS value FROM k WHERE k <= 12 GROUP BY cell")
def idw_k(spark, sf):
    from ..operators.spatial import interpolated

    return interpolated(_sources(spark, sf), _targets(spark, sf), k=12).select("cell", r("value", 4).alias("value"))


_EDITIONS = "ed AS (SELECT CAST(p_partkey % 50 AS INTEGER) AS cell, DATE '1995-02-01' + CAST((p_partkey // 50) * 61 % 2200 AS INTEGER) AS edition, max(p_retailprice) AS value FROM part GROUP BY 1, 2), dy AS (SELECT DISTINCT CAST(l_suppkey % 50 AS INTEGER) AS cell, CAST(l_shipdate AS DATE) AS day FROM lineitem)"


def _editions(spark, sf):
    k = F.col("p_partkey")
    ed = table(spark, sf, "part").select(F.pmod(k, F.lit(50)).cast("int").alias("cell"), F.date_add(F.lit("1995-02-01").cast("date"), F.pmod(F.floor(k / 50) * 61, F.lit(2200)).cast("int")).alias("edition"), F.col("p_retailprice").alias("value")).groupBy("cell", "edition").agg(F.max("value").alias("value"))
    days = table(spark, sf, "lineitem").select(F.pmod("l_suppkey", F.lit(50)).cast("int").alias("cell"), F.to_date("l_shipdate").alias("day")).distinct()
    return days, ed


@query(f"WITH {_EDITIONS}, s AS (SELECT dy.cell, dy.day, a.edition AS ae, a.value AS av, b.edition AS be, b.value AS bv FROM dy ASOF LEFT JOIN ed a ON a.cell = dy.cell AND dy.day >= a.edition ASOF LEFT JOIN ed b ON b.cell = dy.cell AND dy.day <= b.edition) SELECT cell, day, round(CASE WHEN ae IS NULL THEN bv WHEN be IS NULL OR ae = be THEN av ELSE av + (bv - av) * ((day - ae)::DOUBLE / (be - ae)) END, 6) + 0.0 AS value FROM s")
def bracket_interp(spark, sf):
    return J.interpolated(*_editions(spark, sf)).select("cell", "day", r("value").alias("value"))


@query(f"WITH {_EDITIONS} SELECT dy.cell, dy.day, a.edition, a.value FROM dy ASOF LEFT JOIN ed a ON a.cell = dy.cell AND dy.day >= a.edition")
def asof_edition(spark, sf):
    return J.as_of(*_editions(spark, sf))


@query(f"WITH {_EDITIONS}, s AS (SELECT dy.cell, dy.day, a.edition AS ae, a.value AS av, b.edition AS be, b.value AS bv FROM dy ASOF LEFT JOIN ed a ON a.cell = dy.cell AND dy.day >= a.edition ASOF LEFT JOIN ed b ON b.cell = dy.cell AND dy.day <= b.edition) SELECT cell, day, CASE WHEN be IS NULL OR (ae IS NOT NULL AND day - ae <= be - day) THEN ae ELSE be END AS edition, CASE WHEN be IS NULL OR (ae IS NOT NULL AND day - ae <= be - day) THEN av ELSE bv END AS value FROM s")
def nearest_edition(spark, sf):
    return J.nearest(*_editions(spark, sf))


@query("SELECT o_orderkey, CAST(CASE WHEN year(o_orderdate) + 14 <= 2011 THEN 2006 WHEN year(o_orderdate) + 14 <= 2017 THEN 2012 ELSE 2018 END AS INTEGER) AS edition FROM orders")
def year_buckets(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", J.edition_year(F.year("o_orderdate") + 14).alias("edition"))


@query(f"WITH {LCUBE} SELECT cell, day, last_value(rain IGNORE NULLS) OVER (PARTITION BY cell ORDER BY day) AS value FROM lcube")
def locf(spark, sf):
    return lcube(spark, sf).select("cell", "day", J.carried_forward(F.col("rain")).alias("value"))


@query(f"WITH {LCUBE}, t AS (SELECT cell, day FROM lcube WHERE day BETWEEN DATE '2001-06-01' AND DATE '2001-06-10'), h AS (SELECT cell, day AS source_day, rain AS value FROM lcube WHERE rain IS NOT NULL), k AS (SELECT t.cell, t.day, h.source_day, h.value, row_number() OVER (PARTITION BY t.cell, t.day ORDER BY least(abs(dayofyear(t.day) - dayofyear(h.source_day)), 366 - abs(dayofyear(t.day) - dayofyear(h.source_day))), h.source_day DESC) AS k FROM t JOIN h ON h.cell = t.cell AND year(h.source_day) <> year(t.day)) SELECT cell, day, source_day, value FROM k WHERE k = 1")
def warm_start(spark, sf):
    c = lcube(spark, sf)
    return J.warm_start(c.where("day between date'2001-06-01' and date'2001-06-10'"), c.where("rain is not null").withColumnRenamed("rain", "value"))


@query(f"WITH {ECUBE}, w AS (SELECT day, cell FROM ecube WHERE is_fire = 1 UNION ALL SELECT DATE '2030-01-01', 1) SELECT w.day, w.cell, e.n FROM w JOIN ecube e ON e.day = w.day AND e.cell = w.cell")
def point_extract(spark, sf):
    """Values at listed (day, cell) places; days that the axis lacks are skipped."""
    c = ecube(spark, sf)
    wanted = c.where("is_fire = 1").select("day", "cell").unionByName(spark.sql("select date'2030-01-01' as day, 1 as cell"))
    return wanted.join(c, ["day", "cell"]).select("day", "cell", "n")


@query(f"WITH {LCUBE}, h AS (SELECT cell, day, rain, tmax FROM lcube WHERE day <= DATE '2001-10-20' UNION ALL SELECT cell, day, NULL, tmax FROM lcube WHERE day > DATE '2001-10-20') SELECT cell, day, last_value(rain IGNORE NULLS) OVER (PARTITION BY cell ORDER BY day) AS rain FROM h QUALIFY day > DATE '2001-10-15'")
def concat_history(spark, sf):
    """History and new rows that lack a slow feed as one axis; the feed is carried on."""
    c = lcube(spark, sf)
    return maintain.virtual(c.where("day <= date'2001-10-20'"), c.where("day > date'2001-10-20'").drop("rain"), ["rain"]).where("day > date'2001-10-15'").select("cell", "day", "rain")


@query("WITH i AS (SELECT p_partkey AS pixel, CAST(CASE WHEN p_partkey % 9 = 0 THEN -1 ELSE p_partkey % 120 END AS INTEGER) AS cell FROM part) SELECT i.pixel, s.s_acctbal AS value FROM i LEFT JOIN supplier s ON s.s_suppkey = i.cell")
def gather_map(spark, sf):
    from ..operators.spatial import gathered

    k = F.col("p_partkey")
    index = table(spark, sf, "part").select(k.alias("pixel"), F.when(k % 9 == 0, -1).otherwise(F.pmod(k, F.lit(120))).cast("int").alias("cell"))
    return gathered(table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("cell"), F.col("s_acctbal").alias("value")), index)


@query("SELECT split_part(p_brand, '#', 2) AS composite, count(*) AS tiles, min(p_partkey) AS first FROM part GROUP BY 1")
def composite_group(spark, sf):
    return table(spark, sf, "part").groupBy(F.split("p_brand", "#")[1].alias("composite")).agg(F.count("*").alias("tiles"), F.min("p_partkey").alias("first"))


@query("WITH c AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS live, CASE WHEN o_custkey % 2 = 0 THEN o_custkey::DOUBLE END AS cached FROM orders) SELECT o_orderkey, coalesce(live, cached, 0.0::DOUBLE) AS value, CASE WHEN live IS NOT NULL THEN 'live' WHEN cached IS NOT NULL THEN 'persisted' ELSE 'none' END AS source FROM c")
def recency_cascade(spark, sf):
    o = table(spark, sf, "orders")
    value, source = J.recent_or(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("double")), F.lit(0.0))
    return o.select("o_orderkey", value.alias("value"), source.alias("source"))


@query(f"WITH {ECUBE} SELECT day, cell, mean FROM ecube WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND cell IN (SELECT c_custkey FROM customer WHERE c_nationkey > 5)")
def project_slice(spark, sf):
    """Columns, an inclusive range of days, and the land mask as a semi-join."""
    land = table(spark, sf, "customer").where("c_nationkey > 5").select(F.col("c_custkey").cast("int").alias("cell"))
    return ecube(spark, sf).where("day between date'2024-01-10' and date'2024-01-12'").join(land, "cell", "left_semi").select("day", "cell", "mean")


@query("SELECT event_id FROM events WHERE lower(trim(event_type)) IN ('click', 'view') AND CAST(ts AS DATE) = DATE '2024-01-03'")
def confidence_filter(spark, sf):
    e = events(spark, sf).withColumn("confidence", F.concat(F.lit(" "), F.initcap("event_type")))
    return readers.confident(e, levels=("click", "view")).where("day = date'2024-01-03'").select("event_id")


@query("WITH b AS (SELECT c_custkey, c_custkey % 360 AS lon0, 30 + c_custkey % 17 AS lat FROM customer), w AS (SELECT c_custkey, (lon0 + 180) % 360 - 180 AS lon, lat FROM b) SELECT c_custkey, lon::DOUBLE AS lon, lat::DOUBLE AS lat FROM w WHERE lon BETWEEN -10 AND 5 AND lat BETWEEN 35 AND 44")
def bbox(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select("c_custkey", F.pmod(k, F.lit(360)).cast("double").alias("lon"), (30 + F.pmod(k, F.lit(17))).cast("double").alias("lat"))
    return readers.boxed(c, -10, 35, 5, 44)


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 40 THEN round(p_size * 0.02::DOUBLE, 6) + 0.0 END AS scaled, least(greatest(p_retailprice, 950), 1000) AS clipped, CASE WHEN p_size - 10 >= 0 THEN p_size - 10 END AS nodata, CASE WHEN p_size < 5 THEN p_retailprice END AS kept FROM part")
def valid_range_clip_nodata(spark, sf):
    from ..functions.nulls import clip

    size = F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", r(readers.scaled(size, 5, 40, 0.02)).alias("scaled"), clip(F.col("p_retailprice"), 950, 1000).alias("clipped"), F.when(size - 10 >= 0, size - 10).alias("nodata"), F.when(size < 5, F.col("p_retailprice")).alias("kept"))


@query("WITH d AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size / 4.0::DOUBLE END AS d FROM part) SELECT p_partkey, CAST(CASE WHEN d <= 6 THEN 2 ELSE 1 END AS INTEGER) AS regime FROM d")
def regime_of(spark, sf):
    return table(spark, sf, "part").select("p_partkey", serving.regime(F.when(F.col("p_partkey") % 10 != 0, F.col("p_size") / 4.0)).alias("regime"))


@query(f"WITH {ECUBE} SELECT day, cell, n FROM ecube WHERE (day - (SELECT min(day) FROM ecube)) % 4 = 0")
def stride_days(spark, sf):
    return sampling.every(ecube(spark, sf), 4).select("day", "cell", "n")


@query("WITH w AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS day), h AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') SELECT day FROM w WHERE day NOT IN (SELECT day FROM h)")
def antijoin_missing(spark, sf):
    want = spark.sql("select explode(sequence(date'1998-01-01', date'1998-12-31')) as day")
    have = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'O'").select(F.to_date("o_orderdate").alias("day"))
    return maintain.missing_days(want, have)


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'R'")
def both_feeds(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.to_date("o_orderdate").alias("day"))
    li = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.to_date("l_shipdate").alias("day"))
    return maintain.both_feeds(o, li)


@query("WITH a AS (SELECT l_orderkey AS k FROM lineitem WHERE l_tax > 0.05), b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT 'intersect' AS op, count(*) AS n FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'union', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'symmetric', count(*) FROM ((SELECT k FROM a EXCEPT SELECT k FROM b) UNION (SELECT k FROM b EXCEPT SELECT k FROM a)) UNION ALL SELECT 'member', count(*) FROM b WHERE k IN (SELECT k FROM a)")
def set_operations(spark, sf):
    a = table(spark, sf, "lineitem").where("l_tax > 0.05").select(F.col("l_orderkey").alias("k"))
    b = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    found = {"intersect": a.intersect(b), "except": a.subtract(b), "union": a.union(b).distinct(), "symmetric": a.subtract(b).union(b.subtract(a)), "member": b.join(a.distinct(), "k", "left_semi")}
    out = None
    for name, df in found.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {ECUBE}, d AS (SELECT day, max(CASE WHEN is_fire = 1 AND cell < 3 THEN 1 ELSE 0 END) AS e FROM ecube GROUP BY day), o AS (SELECT day, row_number() OVER (ORDER BY md5(CAST(day AS VARCHAR))) AS k FROM d WHERE e = 0) SELECT day FROM d WHERE e = 1 UNION ALL SELECT day FROM o WHERE k <= (SELECT count(*) FROM d WHERE e = 1)")
def balanced_days(spark, sf):
    c = ecube(spark, sf).withColumn("e", F.when((F.col("is_fire") == 1) & (F.col("cell") < 3), 1).otherwise(0))
    return sampling.balanced_days(c, "e").select("day").distinct()


@query("WITH k AS (SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY abs(s_acctbal - 5000), s_suppkey) AS k FROM supplier) SELECT s_suppkey, s_acctbal FROM k WHERE k = 1")
def nearest_coordinate(spark, sf):
    return table(spark, sf, "supplier").orderBy(F.abs(F.col("s_acctbal") - 5000), "s_suppkey").limit(1).select("s_suppkey", "s_acctbal")


@query(f"WITH {ECUBE}, s AS (SELECT day, cell, coalesce(mean, 0) AS p, count(*) OVER (PARTITION BY day) AS n FROM ecube), k AS (SELECT *, rank() OVER (PARTITION BY day ORDER BY p DESC) AS r FROM s) SELECT day, cell, p FROM k WHERE r <= greatest(1, floor(n * 0.03))")
def alert_set(spark, sf):
    c = ecube(spark, sf).select("day", "cell", F.coalesce("mean", F.lit(0.0)).alias("p"))
    return sampling.alert_set(c, "p", 0.03)


@query(f"WITH {ECUBE}, d AS (SELECT day, count(mean) FILTER (cell < 1) AS n FROM ecube GROUP BY day) SELECT day, n FROM d WHERE n > 0")
def tail_trim(spark, sf):
    """Days that have a value; fewer than seven of them would be an error."""
    d = ecube(spark, sf).groupBy("day").agg(F.count(F.when(F.col("cell") < 1, F.col("mean"))).alias("n")).where("n > 0")
    enough = d.agg(F.assert_true(F.count("*") >= 7, F.lit("fewer than seven valid days")).alias("ok"))
    return d.join(F.broadcast(enough)).select("day", "n")


@query(f"WITH {ECUBE}, u AS (SELECT day, cell, 'mean' AS f, mean AS v FROM ecube UNION ALL SELECT day, cell, 'n', n FROM ecube UNION ALL SELECT day, cell, 'is_fire', is_fire FROM ecube), m AS (SELECT f, bool_or(v IS NULL) AS missing FROM u GROUP BY f), c AS (SELECT a.f, avg(abs(a.v - b.v)) AS change FROM u a JOIN u b ON a.cell = b.cell AND a.f = b.f WHERE a.day = DATE '2024-01-05' AND b.day = DATE '2024-01-06' GROUP BY a.f) SELECT m.f AS feature, m.missing, round(c.change, 6) + 0.0 AS change FROM m JOIN c ON c.f = m.f")
def changed_columns(spark, sf):
    """Columns with missing values, and how much each changes between two days."""
    c = ecube(spark, sf).select("day", "cell", "mean", F.col("n").cast("double").alias("n"), F.col("is_fire").cast("double").alias("is_fire")).unpivot(["day", "cell"], ["mean", "n", "is_fire"], "feature", "v")
    missing = c.groupBy("feature").agg(F.bool_or(F.col("v").isNull()).alias("missing"))
    pair = c.where("day between date'2024-01-05' and date'2024-01-06'").groupBy("feature", "cell").agg(F.sum(F.when(F.col("day") == F.lit("2024-01-05").cast("date"), F.col("v"))).alias("a"), F.sum(F.when(F.col("day") == F.lit("2024-01-06").cast("date"), F.col("v"))).alias("b"))
    return missing.join(pair.groupBy("feature").agg(r(F.avg(F.abs(F.col("a") - F.col("b")))).alias("change")), "feature")


@query(f"WITH {SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY regime ORDER BY p DESC, doc_id) AS rank FROM scores) SELECT regime, doc_id, p, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 20")
def top_cells(spark, sf):
    return sampling.top(scores(spark, sf), 20, F.col("p"), "doc_id", ("regime",)).select("regime", "doc_id", "p", "rank")


@query(f"WITH {_EDITIONS}, e AS (SELECT DISTINCT edition FROM ed WHERE cell = 0), d AS (SELECT DISTINCT day FROM dy) SELECT d.day, (SELECT count(*) FROM e WHERE e.edition < d.day) AS place FROM d")
def search_sorted(spark, sf):
    """Where each day falls among the editions, by a running count along one axis."""
    days, ed = _editions(spark, sf)
    both = days.select("day").distinct().withColumn("e", F.lit(0)).unionByName(ed.where("cell = 0").select(F.col("edition").alias("day")).distinct().withColumn("e", F.lit(1)))
    year = both.withColumn("y", F.year("day"))
    before = year.groupBy("y").agg(F.sum("e").alias("s")).withColumn("base", F.coalesce(F.sum("s").over(Window.orderBy("y").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("y").orderBy("day", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    same = F.max("e").over(Window.partitionBy("y", "day"))
    place = F.coalesce(F.sum("e").over(w), F.lit(0)) - same
    return year.withColumn("in_year", place).where("e = 0").join(F.broadcast(before), "y").select("day", (F.col("in_year") + F.col("base")).alias("place"))


@query("WITH h AS (SELECT DATE '1998-01-01' AS day) SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT day FROM h)")
def days_in_set(spark, sf):
    days = holidays(spark, 1998, 1998).where("region is null and month(day) = 1 and day(day) = 1").select("day")
    return table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")).join(F.broadcast(days), "day", "left_semi").select("o_orderkey")
