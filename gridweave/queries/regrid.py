"""Scattered and raster sources on the grid, draws of days, label definitions, granules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import projection as P
from ..operators import regrid, sampling
from ..operators import windows as W
from ..plans import model, serving
from ..sources import readers
from .aggregates import _SCORED, scored
from .base import ECUBE, PLOT, ecube, query, r, table
from .scalars import _FAR, _K

_TRIANGLES = """s AS (SELECT k, n_nationkey AS id, CAST((n_nationkey * 37 + n_nationkey * n_nationkey * 3) % 101 AS BIGINT) AS x, CAST((n_nationkey * 53 + n_nationkey * n_nationkey * 7) % 97 AS BIGINT) AS y, (n_nationkey * 10 + k)::DOUBLE AS v FROM nation, range(3) t(k) WHERE NOT (k = 1 AND n_nationkey % 4 = 1)),
abc AS (SELECT a.k, a.id AS a, b.id AS b, c.id AS c, a.x AS ax, a.y AS ay, a.v AS av, b.x AS bx, b.y AS by_, b.v AS bv, c.x AS cx, c.y AS cy, c.v AS cv, (b.x - a.x) * (c.y - a.y) - (c.x - a.x) * (b.y - a.y) AS whole FROM s a JOIN s b ON b.k = a.k AND b.id > a.id JOIN s c ON c.k = a.k AND c.id > b.id),
tri AS (SELECT * FROM abc t WHERE whole <> 0 AND NOT EXISTS (SELECT 1 FROM s d WHERE d.k = t.k AND d.id NOT IN (t.a, t.b, t.c) AND whole * (((ax - d.x) * (ax - d.x) + (ay - d.y) * (ay - d.y)) * ((bx - d.x) * (cy - d.y) - (cx - d.x) * (by_ - d.y)) - ((bx - d.x) * (bx - d.x) + (by_ - d.y) * (by_ - d.y)) * ((ax - d.x) * (cy - d.y) - (cx - d.x) * (ay - d.y)) + ((cx - d.x) * (cx - d.x) + (cy - d.y) * (cy - d.y)) * ((ax - d.x) * (by_ - d.y) - (bx - d.x) * (ay - d.y))) > 0))"""


@query(f"""WITH {_TRIANGLES},
t AS (SELECT CAST(c_custkey AS INTEGER) AS cell, (c_custkey * 7 % 131)::DOUBLE - 15.37 AS px, (c_custkey * 11 % 127)::DOUBLE - 14.61 AS py FROM customer),
w AS (SELECT t.cell, tri.*, ((px - ax) * (cy - ay) - (cx - ax) * (py - ay)) / whole AS wb, ((bx - ax) * (py - ay) - (px - ax) * (by_ - ay)) / whole AS wc FROM t, tri),
i AS (SELECT k, cell, arg_min((1 - wb - wc) * av + wb * bv + wc * cv, a * 10000 + b * 100 + c) AS value FROM w WHERE least(1 - wb - wc, wb, wc) >= -1e-9::DOUBLE GROUP BY k, cell),
n AS (SELECT s.k, t.cell, s.v, row_number() OVER (PARTITION BY s.k, t.cell ORDER BY (px - x) * (px - x) + (py - y) * (py - y), id) AS place FROM t, s)
SELECT CAST(n.k AS INTEGER) AS k, n.cell, round(coalesce(i.value, n.v), 6) + 0.0 AS value FROM n LEFT JOIN i ON i.k = n.k AND i.cell = n.cell WHERE n.place = 1""")
def scattered_regrid(spark, sf):
    """Fields on scattered points, one of them with points missing: linear in triangles, beyond them the nearest point."""
    n, c = F.col("n_nationkey"), F.col("c_custkey")
    points = table(spark, sf, "nation").select(F.explode(F.array(*map(F.lit, range(3)))).alias("k"), "n_nationkey")
    there = ~((F.col("k") == 1) & (n % 4 == 1))
    field = points.select("k", n.alias("src_id"), ((n * 37 + n * n * 3) % 101).cast("double").alias("px"), ((n * 53 + n * n * 7) % 97).cast("double").alias("py"), F.when(there, (n * 10 + F.col("k")).cast("double")).alias("value"))
    targets = table(spark, sf, "customer").select(c.cast("int").alias("cell"), ((c * 7 % 131).cast("double") - 15.37).alias("px"), ((c * 11 % 127).cast("double") - 14.61).alias("py"))
    return regrid.regridded_scattered(field, targets, keys=("k",)).select("k", "cell", r("value").alias("value"))


@query("WITH m AS (SELECT o_custkey % 40 AS row, o_orderkey % 50 AS col, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus <> 'P') AS value FROM orders GROUP BY 1, 2), t AS (SELECT CAST(c_custkey AS INTEGER) AS cell, CAST(floor((c_custkey % 61) - 1.5) AS BIGINT) AS col, CAST(floor((40 - ((c_custkey % 47) - 0.25)) ) AS BIGINT) AS row FROM customer) SELECT t.cell, m.value FROM t LEFT JOIN m ON m.row = t.row AND m.col = t.col")
def mosaic_match(spark, sf):
    """Tiles laid over each other, the first with data on top, read at other places."""
    o, c = table(spark, sf, "orders"), F.col("c_custkey")
    tiles = o.select((F.col("o_custkey") % 40).alias("row"), (F.col("o_orderkey") % 50).alias("col"), "o_orderkey", "o_totalprice", "o_orderstatus")
    raster = regrid.mosaicked(tiles, "o_orderkey", "o_totalprice", F.col("o_orderstatus") == "P").withColumnRenamed("o_totalprice", "value")
    targets = table(spark, sf, "customer").select(c.cast("int").alias("cell"), ((c % 61) - 1.5).alias("x"), ((c % 47) - 0.25).alias("y"))
    return regrid.matched(raster, targets, 0.0, 40.0, 1.0, -1.0)


@query("WITH m AS (SELECT CAST(s_suppkey * 13 % 110 AS INTEGER) AS cell, (s_suppkey * 13 % 110 % 10) * 2000.0::DOUBLE + CASE WHEN s_suppkey % 7 = 3 THEN 5 ELSE 0 END AS x, (s_suppkey * 13 % 110 // 10) * -2000.0::DOUBLE AS y FROM supplier), g AS (SELECT cell, count(*) AS n, max(greatest(abs(x - cell % 10 * 2000), abs(y + cell // 10 * 2000))) AS off FROM m GROUP BY cell), o AS (SELECT CAST(range AS INTEGER) AS cell FROM range(100)), f AS (SELECT coalesce(o.cell, g.cell) AS cell, CASE WHEN o.cell IS NULL THEN 'outside' WHEN g.n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' WHEN off > 1e-6 THEN 'moved' END AS fault FROM o FULL JOIN g ON g.cell = o.cell) SELECT * FROM f WHERE fault IS NOT NULL")
def mask_alignment(spark, sf):
    cell = F.col("s_suppkey") * 13 % 110
    s = table(spark, sf, "supplier").select(cell.cast("int").alias("cell"), F.when(F.col("s_suppkey") % 7 == 3, 5.0).otherwise(0.0).alias("off"))
    return regrid.misaligned(s.select("cell", (PLOT.easting(F.col("cell")) + F.col("off")).alias("x_m"), PLOT.northing(F.col("cell")).alias("y_m")), PLOT)


@query(f"WITH {ECUBE}, d AS (SELECT day, CASE WHEN max(CASE WHEN is_fire = 1 AND cell % 40 = 1 THEN 1 ELSE 0 END) = 1 THEN 10 ELSE 1 END AS w FROM ecube GROUP BY day), e AS (SELECT day, w, sum(w) OVER (ORDER BY day) AS hi FROM d), p AS (SELECT range AS draw, CAST('0x' || substr(md5('7|' || range), 1, 15) AS BIGINT) % (SELECT max(hi) FROM e) AS slot FROM range(5000)) SELECT p.draw, e.day FROM p JOIN e ON p.slot < e.hi AND p.slot >= e.hi - e.w")
def drawn_days(spark, sf):
    """5,000 days drawn with replacement, those with an event ten times as likely."""
    rare = ecube(spark, sf).withColumn("e", F.when(F.col("cell") % 40 == 1, F.col("is_fire")).otherwise(0))
    return sampling.drawn_days(rare, "e", 5000, seed=7)


@query(f"{_SCORED}, m AS (SELECT name, max(p) AS risk FROM scored GROUP BY name), o AS (SELECT *, row_number() OVER (ORDER BY risk DESC, name) AS place FROM m) SELECT CAST(place AS INTEGER) AS place, name AS region, round(risk, 6) + 0.0 AS risk, CASE WHEN risk >= 0.1276 THEN 'High' WHEN risk >= 0.035728 THEN 'Elevated' WHEN risk >= 0.008932 THEN 'Moderate' ELSE 'Low' END AS tier FROM o WHERE place <= 5")
def top_regions(spark, sf):
    return serving.riskiest(scored(spark, sf), region="name").withColumn("risk", r("risk"))


@query(f"WITH b AS (SELECT p_partkey, p_partkey % 5 AS kind, ((p_partkey % 300)::DOUBLE - 150) / 1000 AS sx, ((p_partkey % 280)::DOUBLE - 140) / 1000 AS sy FROM part), g AS (SELECT *, cos(sy) * cos(sy) + {_K!r} * sin(sy) * sin(sy) AS flat, {_FAR!r} * cos(sx) * cos(sy) AS ahead FROM b WHERE kind IN (1, 2, 3)), i AS (SELECT *, ahead * ahead - flat * {_FAR**2 - 6378137.0**2!r} AS inside FROM g), n AS (SELECT *, (ahead - sqrt(greatest(inside, 0))) / flat AS n FROM i), s AS (SELECT *, {_FAR!r} - n * cos(sx) * cos(sy) AS s1, n * sin(sx) * cos(sy) AS s2, n * sin(sy) AS s3 FROM n WHERE inside >= 0) SELECT p_partkey, round(degrees(atan2(s2, s1)), 5) + 0.0 AS longitude, round(degrees(atan({_K!r} * s3 / sqrt(s1 * s1 + s2 * s2))), 5) + 0.0 AS latitude FROM s")
def granule_fires(spark, sf):
    k = F.col("p_partkey")
    pixels = table(spark, sf, "part").select("p_partkey", (k % 5).alias("fire_result"), ((k % 300 - 150).cast("double") / 1000).alias("x"), ((k % 280 - 140).cast("double") / 1000).alias("y"))
    return readers.granule_fires(pixels).select("p_partkey", r("longitude", 5).alias("longitude"), r("latitude", 5).alias("latitude"))


_KINDS = {"errors": "is_fire = 1", "busy": "n >= 2", "either": "is_fire = 1 OR n >= 2"}


@query(f"WITH {ECUBE}, l AS (" + " UNION ALL ".join(f"SELECT '{name}' AS label, day, cell, CASE WHEN {rule} THEN 1 ELSE 0 END AS e FROM ecube" for name, rule in _KINDS.items()) + "), w AS (SELECT label, day, cell, e, count(*) OVER f AS follow, max(e) OVER f AS y, date_diff('day', max(CASE WHEN e = 1 THEN day END) OVER b, day) AS since FROM l WINDOW f AS (PARTITION BY label, cell ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), b AS (PARTITION BY label, cell ORDER BY day)) SELECT label, day, cell, CAST(since AS INTEGER) AS since, CASE WHEN follow = 2 THEN y END AS y FROM w")
def label_matrix(spark, sf):
    """Three definitions of an event, each with its own label and time since the last one."""

    def derive(df):
        w = W.along()
        last = F.max(F.when(F.col("is_fire") == 1, F.col("day"))).over(w)
        return df.select("day", "cell", F.date_diff("day", last).alias("since"), W.within_horizon(F.col("is_fire") == 1, 2, w).alias("y"))

    return model.label_matrix(ecube(spark, sf), {k: F.expr(rule).cast("int") for k, rule in _KINDS.items()}, derive)


@query()
def horizon_ablation(spark, sf):
    """A model for each of three horizons: events ahead and precision."""
    cube = ecube(spark, sf).withColumn("load", F.col("n").cast("double")).withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    found = model.over_horizons(cube, ["load", "mean"], ["load"], [1, 2, 3], W.along())
    return spark.createDataFrame(found, "horizon int, events long, ap double").withColumn("ap", r("ap"))
