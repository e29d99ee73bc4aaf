"""Operators over cells: nearest events, neighbourhoods, regridding, polygons, areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..grid import Grid
from ..operators import spatial as G
from ..operators import watershed
from ..plans import serving
from .aggregates import _SCORED, scored
from .base import ECUBE, WIDE, ecube, events, plot, query, r, table

_NEAR = f"""WITH {ECUBE}, c AS (SELECT day, cell, is_fire * CASE WHEN cell % 3 = 0 AND CAST(day AS DATE) <> DATE '2024-01-07' THEN 1 ELSE 0 END AS e, coalesce(mean, 0) / 10 AS u, -n::DOUBLE AS v FROM ecube),
ny AS (SELECT greatest(16, max(cell) // 10 + 1) AS ny FROM ecube),
d AS (SELECT c.day, c.cell, c.u, c.v, o.cell AS near, ((c.cell % 10 - o.cell % 10) * (c.cell % 10 - o.cell % 10) + (c.cell // 10 - o.cell // 10) * (c.cell // 10 - o.cell // 10)) AS d2 FROM c LEFT JOIN (SELECT day, cell FROM c WHERE e = 1) o ON o.day = c.day),
k AS (SELECT *, row_number() OVER (PARTITION BY day, cell ORDER BY d2, near) AS k FROM d)"""


def _suppliers(spark, sf):
    """(cell, s_acctbal) of all suppliers, and the grid that they stand on."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("cell"), "s_acctbal")
    return s, plot(s)


def _wide(spark, sf):
    """The grid that all users stand on."""
    return plot(events(spark, sf), WIDE)


def _burning(spark, sf):
    """A third of the cells' events, none at all on one day, with a wind of its own."""
    some = (F.col("cell") % 3 == 0) & (F.col("day") != F.lit("2024-01-07").cast("date"))
    return ecube(spark, sf).select("day", "cell", (F.col("is_fire") * F.when(some, 1).otherwise(0)).alias("is_fire"), (F.coalesce("mean", F.lit(0.0)) / 10).alias("wind_u"), (-F.col("n")).cast("double").alias("wind_v"))


@query(f"{_NEAR} SELECT day, cell, round(coalesce(sqrt(d2) * 2, sqrt(10 * 10 + (SELECT ny * ny FROM ny)) * 2), 6) + 0.0 AS dist_km, CAST(near AS INTEGER) AS nearest FROM k WHERE k = 1")
def nearest_event(spark, sf):
    return G.nearest_events(_burning(spark, sf), _wide(spark, sf)).select("day", "cell", r("dist_km").alias("dist_km"), "nearest")


@query(f"{_NEAR} SELECT day, cell, round(CASE WHEN near IS NULL OR d2 = 0 THEN 0 ELSE (u * (cell % 10 - near % 10) * 2000 - v * (cell // 10 - near // 10) * 2000) / (d2 * 4000000.0::DOUBLE) END, 12) + 0.0 AS exposure FROM k WHERE k = 1")
def exposure(spark, sf):
    return G.nearest_events(_burning(spark, sf), _wide(spark, sf)).select("day", "cell", r("exposure", 12).alias("exposure"))


@query(f"{_NEAR} SELECT day, cell, round(coalesce(sqrt(d2) * 2, 1000.0::DOUBLE), 6) + 0.0 AS dist_km FROM k WHERE k = 1")
def distance_without_events(spark, sf):
    """The same with another value for days without events."""
    return G.nearest_events(_burning(spark, sf), _wide(spark, sf), none_km=1000.0).select("day", "cell", r("dist_km").alias("dist_km"))


@query("WITH b AS (SELECT CAST(s_suppkey AS INTEGER) AS cell, s_acctbal / 10000 > 0.5 AS built FROM supplier) SELECT b.cell, round(min(sqrt((b.cell % 10 - o.cell % 10) * (b.cell % 10 - o.cell % 10) + (b.cell // 10 - o.cell // 10) * (b.cell // 10 - o.cell // 10)) * 2), 6) + 0.0 AS dist_to_urban FROM b, b o WHERE o.built GROUP BY b.cell")
def dist_to_urban(spark, sf):
    s, grid = _suppliers(spark, sf)
    b = s.select("cell", (F.col("s_acctbal") / 10000 > 0.5).cast("int").alias("is_fire"), F.lit(0.0).alias("wind_u"), F.lit(0.0).alias("wind_v"))
    return G.nearest_events(b, grid, keys=()).select("cell", r("dist_km").alias("dist_to_urban"))


_RELIEF = "h AS (SELECT CAST(s_suppkey AS INTEGER) AS cell, CASE WHEN s_suppkey % 11 = 3 THEN NULL ELSE s_acctbal END AS e FROM supplier), last AS (SELECT greatest(9, max(cell) // 10) AS last FROM h)"


def _relief(spark, sf):
    s, grid = _suppliers(spark, sf)
    return s.select("cell", F.when(F.col("cell") % 11 != 3, F.col("s_acctbal")).alias("e")), grid


def _near(radius: int) -> str:
    return f"o AS (SELECT a.i AS dy, b.i AS dx FROM range(-{radius}, {radius + 1}) a(i), range(-{radius}, {radius + 1}) b(i)), m AS (SELECT h.cell, avg(n.e) AS mean FROM h CROSS JOIN o JOIN h n ON n.cell = least(greatest(h.cell // 10 + dy, 0), (SELECT last FROM last)) * 10 + least(greatest(h.cell % 10 + dx, 0), 9) GROUP BY h.cell)"


@query(f"WITH {_RELIEF}, {_near(2)} SELECT h.cell, round(h.e - m.mean, 6) + 0.0 AS tpi FROM h JOIN m ON m.cell = h.cell")
def tpi5(spark, sf):
    return G.position_index(*_relief(spark, sf), "e").select("cell", r("tpi").alias("tpi"))


@query(f"WITH {_RELIEF}, o(dy, dx) AS (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)), m AS (SELECT h.cell, sum(coalesce(n.e, 0)) AS s FROM h CROSS JOIN o JOIN h n ON n.cell = least(greatest(h.cell // 10 + dy, 0), (SELECT last FROM last)) * 10 + least(greatest(h.cell % 10 + dx, 0), 9) GROUP BY h.cell) SELECT h.cell, round(s - 4 * coalesce(h.e, 0), 4) + 0.0 AS curvature FROM h JOIN m ON m.cell = h.cell")
def laplacian(spark, sf):
    return G.curvature(*_relief(spark, sf), "e").select("cell", r("curvature", 4).alias("curvature"))


@query(f"WITH {_RELIEF}, {_near(1)} SELECT cell, round(mean, 6) + 0.0 AS mean FROM m")
def neigh_mean(spark, sf):
    return G.neighbourhood_mean(*_relief(spark, sf), "e", 3).select("cell", r("mean").alias("mean"))


@query("WITH f AS (SELECT CAST(s_suppkey AS INTEGER) AS src, s_acctbal AS v FROM supplier), t AS (SELECT c_custkey AS cell, (c_custkey % 90)::DOUBLE / 10 + 0.03 AS gx, (c_custkey % 83)::DOUBLE / 10 + 0.01 AS gy FROM customer), w AS (SELECT *, CAST(floor(gx) AS INTEGER) AS i, CAST(floor(gy) AS INTEGER) AS j FROM t), a AS (SELECT *, gx - i AS a, gy - j AS b FROM w), x AS (SELECT a.cell, a.a, a.b, p.v AS v00, q.v AS v01, r.v AS v10, s.v AS v11 FROM a JOIN f p ON p.src = j * 10 + i JOIN f q ON q.src = j * 10 + i + 1 JOIN f r ON r.src = (j + 1) * 10 + i JOIN f s ON s.src = (j + 1) * 10 + i + 1) SELECT CAST(cell AS INTEGER) AS cell, round(CASE WHEN a >= b THEN (1 - a) * v00 + (a - b) * v01 + b * v11 ELSE (1 - b) * v00 + (b - a) * v10 + a * v11 END, 4) + 0.0 AS value FROM x")
def regrid_weights_apply(spark, sf):
    """A field on a regular mesh to scattered places, by weights that are made once."""
    k = F.col("c_custkey")
    targets = table(spark, sf, "customer").select(k.cast("int").alias("cell"), (F.pmod(k, F.lit(90)) / 10.0 + 0.03).alias("px"), (F.pmod(k, F.lit(83)) / 10.0 + 0.01).alias("py"))
    s, grid = _suppliers(spark, sf)
    weights = G.regrid_weights(spark, [float(i) for i in range(grid.nx)], [float(i) for i in range(grid.ny)], targets)
    field = s.select(F.col("cell").alias("src_id"), F.col("s_acctbal").alias("value"))
    return G.regridded(field, weights, keys=()).select("cell", r("value", 4).alias("value"))


@query("WITH s AS (SELECT CAST(s_suppkey AS INTEGER) AS cell, s_acctbal AS v FROM supplier), k AS (SELECT CAST(range AS INTEGER) AS k FROM range(4)) SELECT CAST(((cell // 10) * 2 + k // 2) * 20 + (cell % 10) * 2 + k % 2 AS INTEGER) AS cell, v FROM s, k")
def refine(spark, sf):
    s, grid = _suppliers(spark, sf)
    return G.refine(s.withColumnRenamed("s_acctbal", "v"), grid, 2)


@query("WITH p AS (SELECT n_nationkey AS id, (n_nationkey % 7)::DOUBLE + 0.25 AS x, (n_nationkey % 6)::DOUBLE + 0.25 AS y FROM nation), g AS (SELECT CAST(a.range AS INTEGER) AS i, CAST(b.range AS INTEGER) AS j FROM range(10) a, range(10) b) SELECT p.id, CAST(j * 10 + i AS INTEGER) AS cell FROM p, g WHERE i > x AND i < x + 3 AND j > y AND j < y + 2")
def polygon_cells(spark, sf):
    """Cells with their centre in a ring."""
    grid = Grid(0.0, 0.0, 1.0, 1.0, 10, 10)
    x, y = F.pmod("n_nationkey", F.lit(7)) + 0.25, F.pmod("n_nationkey", F.lit(6)) + 0.25
    ring = F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in ((0, 0), (3, 0), (3, 2), (0, 2), (0, 0))])
    p = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), ring.alias("ring"))
    return G.polygon_cells(p, grid).select("id", "cell")


@query("WITH p AS (SELECT s_suppkey AS id, (s_suppkey % 23)::DOUBLE + 0.25 AS x, (s_suppkey % 19)::DOUBLE + 0.25 AS y FROM supplier), g AS (SELECT CAST(a.range AS INTEGER) AS i, CAST(b.range AS INTEGER) AS j FROM range(30) a, range(30) b) SELECT p.id, CAST(j * 30 + i AS INTEGER) AS cell FROM p, g WHERE (i > x AND i < x + 6 AND j > y AND j < y + 5 AND NOT (i > x + 2 AND i < x + 4 AND j > y + 1 AND j < y + 3)) OR (i > x + 7 AND j > y AND (i - x - 7) + (j - y) < 3)")
def polygon_holes(spark, sf):
    """Cells of polygons of two parts, a rectangle with a hole and a triangle."""
    grid = Grid(0.0, 0.0, 1.0, 1.0, 30, 30)
    x, y = F.pmod("s_suppkey", F.lit(23)) + 0.25, F.pmod("s_suppkey", F.lit(19)) + 0.25
    ring = lambda *corners: F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in corners])
    parts = F.array(F.array(ring((0, 0), (6, 0), (6, 5), (0, 5)), ring((2, 1), (2, 3), (4, 3), (4, 1), (2, 1))), F.array(ring((7, 0), (10, 0), (7, 3))))
    return G.scanned_cells(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), parts.alias("parts")), grid)


@query(f"""{_NEAR}, al AS (SELECT day, cell FROM c WHERE u > 9),
q AS (SELECT day, cell, sqrt(d2) * 2 AS d FROM k WHERE k = 1), ev2 AS (SELECT day, cell FROM c WHERE e = 1),
b AS (SELECT e.day, e.cell, min((e.cell % 10 - a.cell % 10) * (e.cell % 10 - a.cell % 10) + (e.cell // 10 - a.cell // 10) * (e.cell // 10 - a.cell // 10)) AS d2 FROM ev2 e LEFT JOIN al a ON a.day = e.day GROUP BY 1, 2)
SELECT (SELECT round(avg(CASE WHEN coalesce(q.d, 1e9) <= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 FROM q JOIN al ON al.day = q.day AND al.cell = q.cell) AS alerts_near, (SELECT round(avg(CASE WHEN coalesce(sqrt(d2) * 2, 1e9) <= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 FROM b) AS events_near""")
def localization(spark, sf):
    """Share of alerts with an event within 4 km, and of events with an alert."""
    c, grid = _burning(spark, sf), _wide(spark, sf)
    alerts = c.where("wind_u > 9").select("day", "cell")
    near_event = G.nearest_events(c, grid, none_km=1e9).join(alerts, ["day", "cell"]).agg(r(F.avg((F.col("dist_km") <= 4).cast("double"))).alias("alerts_near"))
    as_event = c.withColumn("own", F.col("is_fire")).withColumn("is_fire", (F.col("wind_u") > 9).cast("int"))
    near_alert = G.nearest_events(as_event, grid, none_km=1e9).join(c.where("is_fire = 1").select("day", "cell"), ["day", "cell"]).agg(r(F.avg((F.col("dist_km") <= 4).cast("double"))).alias("events_near"))
    return near_event.join(F.broadcast(near_alert))


@query()
def danger_areas(spark, sf):
    """Watershed areas of the risk surface; tests hold them against small rasters."""
    return serving.region_areas(watershed.danger_areas(scored(spark, sf), _wide(spark, sf))).select("day", "area", r("p_any").alias("p_any"), "peak_cell", "radius_m", "n_cells", "regime", "region", "place")


@query(f"{_SCORED}, a AS (SELECT DISTINCT cell FROM scored UNION SELECT CAST(c_custkey AS INTEGER) FROM customer), d AS (SELECT cell, p, regime FROM scored WHERE day = DATE '2024-01-15') SELECT a.cell, coalesce(d.p, 0.0::DOUBLE) AS p, CAST(coalesce(d.regime, 0) AS INTEGER) AS regime FROM a LEFT JOIN d ON d.cell = a.cell")
def scatter_back(spark, sf):
    """Scores of land cells back on the whole grid."""
    s = scored(spark, sf)
    cells = s.select("cell").union(table(spark, sf, "customer").select(F.col("c_custkey").cast("int"))).distinct()
    return serving.scattered(cells, s.where("day = date'2024-01-15'"))


@query("SELECT CAST(s_suppkey AS INTEGER) AS cell, CAST(s_suppkey // 10 AS INTEGER) AS y, CAST(s_suppkey % 10 AS INTEGER) AS x, 2000.0::DOUBLE * (s_suppkey % 10) AS x_m, -2000.0::DOUBLE * (s_suppkey // 10) + 0.0 AS y_m FROM supplier")
def grid_cells(spark, sf):
    s, grid = _suppliers(spark, sf)
    return grid.cells(spark).join(s, "cell", "left_semi").withColumn("y_m", F.col("y_m") + 0.0)
