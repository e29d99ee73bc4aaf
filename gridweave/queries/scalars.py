"""Scalar kernels over columns of lineitem, part, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import projection as P
from ..functions import scalars as S
from ..functions.nulls import filled
from .base import query, r, table

_KEYS = "l_orderkey, l_linenumber"
_BASE = "WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity - 10 AS t, l_discount * 1000 AS rh, l_tax * 200 AS w, (l_partkey % 360)::DOUBLE AS deg FROM lineitem)"


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """Temperatures -9..40, humidities 0..100, winds 0..16, directions 0..359."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 10).alias("t"), (F.col("l_discount") * 1000).alias("rh"), (F.col("l_tax") * 200).alias("w"), F.pmod("l_partkey", F.lit(360)).cast("double").alias("deg"))


def _out(df: DataFrame, **columns) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", *[r(c).alias(n) for n, c in columns.items()])


@query(f"{_BASE} SELECT {_KEYS}, round(-w * sin(radians(deg)), 6) + 0.0 AS u, round(-w * cos(radians(deg)), 6) + 0.0 AS v FROM b")
def wind_uv(spark, sf):
    return _out(_base(spark, sf), u=S.wind_u(F.col("w"), F.col("deg")), v=S.wind_v(F.col("w"), F.col("deg")))


@query(f"{_BASE}, c AS (SELECT *, degrees(atan2(-sin(radians(deg + 0.5)), -cos(radians(deg + 0.5)))) - 180 AS d FROM b) SELECT {_KEYS}, round(d - 360 * floor(d / 360), 4) + 0.0 AS back, round(sqrt(t * t + w * w), 6) + 0.0 AS speed, round(w / 3.6, 6) + 0.0 AS ms FROM c")
def uv_dir(spark, sf):
    b = _base(spark, sf)
    away = F.col("deg") + 0.5
    back = S.wind_direction(S.wind_u(F.lit(1.0), away), S.wind_v(F.lit(1.0), away))
    return b.select("l_orderkey", "l_linenumber", r(back, 4).alias("back"), r(S.wind_speed(F.col("t"), F.col("w"))).alias("speed"), r(S.kmh_to_ms(F.col("w"))).alias("ms"))


@query(f"{_BASE} SELECT {_KEYS}, round(0.6108 * exp(17.625 * t / (t + 243.04)), 6) + 0.0 AS kpa, round(6.112 * exp(17.67 * t / (t + 243.5)), 6) + 0.0 AS hpa FROM b")
def vapour_pressures(spark, sf):
    return _out(_base(spark, sf), kpa=S.vapour_pressure(F.col("t")), hpa=S.vapour_pressure(F.col("t"), S.MAGNUS_HPA))


@query(f"{_BASE} SELECT {_KEYS}, round(greatest(0.6108 * exp(17.625 * t / (t + 243.04)) * (1 - (rh + 5) / 100), 0), 6) + 0.0 AS vpd FROM b")
def vpd(spark, sf):
    return _out(_base(spark, sf), vpd=S.vapour_deficit(F.col("t"), F.col("rh") + 5))


_EMC = "greatest(CASE WHEN rh < 10 THEN 0.03229 + 0.281073 * rh - 0.000578 * rh * f WHEN rh <= 50 THEN 2.22749 + 0.160107 * rh - 0.014784 * f ELSE 21.0606 + 0.005565 * rh * rh - 0.00035 * rh * f - 0.483199 * rh END, 0)"
_EMCS = f"{_BASE}, f AS (SELECT *, t * 9 / 5 + 32 AS f FROM b), e AS (SELECT *, {_EMC} AS emc FROM f)"


@query(f"{_EMCS} SELECT {_KEYS}, round(emc, 6) + 0.0 AS emc FROM e")
def emc(spark, sf):
    return _out(_base(spark, sf), emc=S.moisture_content(F.col("t"), F.col("rh")))


@query(f"{_EMCS}, m AS (SELECT *, least(emc, 30) / 30 AS m FROM e) SELECT {_KEYS}, round((1 - 2 * m + 1.5 * m * m - 0.5 * m * m * m) * sqrt(1 + (2.236936 * w) * (2.236936 * w)) / 0.3002, 6) + 0.0 AS ffwi FROM m")
def ffwi(spark, sf):
    return _out(_base(spark, sf), ffwi=S.fire_weather(S.moisture_content(F.col("t"), F.col("rh")), F.col("w")))


@query("SELECT p_partkey, round(least(greatest(pow(((p_size / 50.0::DOUBLE) - 0.05) / (0.86 - 0.05), 2), 0), 1), 6) + 0.0 AS fvc FROM part")
def fvc(spark, sf):
    return table(spark, sf, "part").select("p_partkey", r(S.vegetation_cover(F.col("p_size") / 50.0)).alias("fvc"))


@query(f"{_BASE} SELECT {_KEYS}, round(greatest(0.6108 * exp(17.625 * t / (t + 243.04)) * (1 - rh / 100), 0) * w, 6) + 0.0 AS hdw FROM b")
def hdw(spark, sf):
    return _out(_base(spark, sf), hdw=S.hot_dry_windy(S.vapour_deficit(F.col("t"), F.col("rh")), F.col("w")))


@query("SELECT o_orderkey, round(sin(2 * pi() * (dayofyear(o_orderdate) - 1) / 365.25), 6) + 0.0 AS s, round(cos(2 * pi() * (dayofyear(o_orderdate) - 1) / 365.25), 6) + 0.0 AS c FROM orders")
def doy_sincos(spark, sf):
    s, c = S.year_cycle(F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", r(s).alias("s"), r(c).alias("c"))


@query("SELECT o_orderkey, round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) + 0.0 AS s, round(cos(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) + 0.0 AS c FROM orders")
def dow_sincos(spark, sf):
    s, c = S.week_cycle(F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", r(s).alias("s"), r(c).alias("c"))


@query("WITH b AS (SELECT p_partkey, radians(p_size::DOUBLE) AS s, radians((p_partkey % 360)::DOUBLE) AS a, (p_partkey % 360)::DOUBLE AS d, radians(36 + (p_partkey % 8)::DOUBLE) AS l FROM part), c AS (SELECT *, radians(abs(180 - abs(d - 225))) AS f FROM b) SELECT p_partkey, round(exp(-1.467 + 1.582 * cos(l) * cos(s) - 1.5 * cos(f) * sin(s) * sin(l) - 0.262 * sin(l) * sin(s) + 0.607 * sin(f) * sin(s)), 6) + 0.0 AS hli FROM c")
def hli(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", r(S.heat_load(F.col("p_size").cast("double"), F.pmod(k, F.lit(360)).cast("double"), 36 + F.pmod(k, F.lit(8)).cast("double"))).alias("hli"))


_SECTORS = ", ".join(f"CASE WHEN (p_partkey + {k}) % 11 = 0 THEN NULL ELSE ((p_partkey * {k + 3}) % 17) / 17.0::DOUBLE END AS f{k}" for k in range(8))
_EAST = " + ".join(f"coalesce(f{k}, 0) * sin(radians({22.5 + 45 * k}))" for k in range(8))
_NORTH = " + ".join(f"coalesce(f{k}, 0) * cos(radians({22.5 + 45 * k}))" for k in range(8))


@query(f"WITH b AS (SELECT p_partkey, {_SECTORS} FROM part), c AS (SELECT *, {_EAST} AS e, {_NORTH} AS n FROM b) SELECT p_partkey, CASE WHEN f0 IS NOT NULL THEN round(e, 6) + 0.0 END AS east, CASE WHEN f0 IS NOT NULL THEN round(-n, 6) + 0.0 END AS south FROM c")
def aspect(spark, sf):
    k = F.col("p_partkey")
    sectors = [F.when(F.pmod(k + i, F.lit(11)) != 0, F.pmod(k * (i + 3), F.lit(17)) / 17.0) for i in range(8)]
    east, south, _ = S.aspect_parts(sectors)
    return table(spark, sf, "part").select("p_partkey", r(east).alias("east"), r(south).alias("south"))


@query(f"{_BASE} SELECT {_KEYS}, round(least(greatest(100 * (6.112 * exp(17.67 * (t - w) / (t - w + 243.5))) / (6.112 * exp(17.67 * t / (t + 243.5))), 0), 100), 6) + 0.0 AS rh FROM b")
def rh_dew(spark, sf):
    return _out(_base(spark, sf), rh=S.humidity_from_dewpoint(F.col("t"), F.col("t") - F.col("w")))


@query(f"{_BASE}, q AS (SELECT *, rh / 10000 AS q FROM b) SELECT {_KEYS}, round(least(greatest(100 * (q * 950 / (0.622 + 0.378 * q)) / (6.112 * exp(17.67 * t / (t + 243.5))), 0), 100), 6) + 0.0 AS rh FROM q")
def rh_spfh(spark, sf):
    return _out(_base(spark, sf), rh=S.humidity_from_specific(F.col("rh") / 10000, F.lit(950.0), F.col("t")))


@query(f"{_BASE} SELECT {_KEYS}, round(t - 273.15, 4) + 0.0 AS celsius, round(rh / 100, 6) + 0.0 AS hpa, round(w * 1000, 4) + 0.0 AS mm FROM b")
def units(spark, sf):
    return _base(spark, sf).select("l_orderkey", "l_linenumber", r(S.kelvin_to_celsius(F.col("t")), 4).alias("celsius"), r(S.pascal_to_hectopascal(F.col("rh"))).alias("hpa"), r(S.metres_to_millimetres(F.col("w")), 4).alias("mm"))


@query("WITH b AS (SELECT o_orderkey, (o_custkey % 720 - 180)::DOUBLE + 180 AS x FROM orders) SELECT o_orderkey, round(x - 360 * floor(x / 360) - 180, 6) + 0.0 AS lon FROM b")
def lon_wrap(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", r(S.wrapped_longitude((F.pmod("o_custkey", F.lit(720)) - 180).cast("double"))).alias("lon"))


@query("WITH b AS (SELECT p_partkey, (p_partkey % 41) / 2.0::DOUBLE AS x FROM part) SELECT p_partkey, CAST(round_even(x, 0) AS INTEGER) AS i, round_even(x, 0) BETWEEN 0 AND 9 AS inside FROM b")
def grid_index(spark, sf):
    i = S.grid_index(F.pmod("p_partkey", F.lit(41)) / 2.0, 0.0, 1.0)
    return table(spark, sf, "part").select("p_partkey", i.alias("i"), i.between(0, 9).alias("inside"))


_LAEA = f"WITH b AS (SELECT p_partkey, -9 + (p_partkey % 120) / 10.0::DOUBLE AS lon, 36 + (p_partkey % 77) / 10.0::DOUBLE AS lat FROM part), s AS (SELECT *, sin(radians(lat)) AS s FROM b), q AS (SELECT *, {1 - P.E2!r} * (s / (1 - {P.E2!r} * s * s) - ln((1 - {P.E!r} * s) / (1 + {P.E!r} * s)) / (2 * {P.E!r})) / {P._POLE!r} AS sb FROM s), c AS (SELECT *, sqrt(greatest(1 - sb * sb, 0)) AS cb, radians(lon - 10) AS away FROM q), k AS (SELECT *, {P._RADIUS!r} * sqrt(2 / (1 + sin({P._BETA0!r}) * sb + cos({P._BETA0!r}) * cb * cos(away))) AS k FROM c)"


@query(f"{_LAEA} SELECT p_partkey, round(4321000 + k * {P._D!r} * cb * sin(away), 3) + 0.0 AS x, round(3210000 + k / {P._D!r} * (cos({P._BETA0!r}) * sb - sin({P._BETA0!r}) * cb * cos(away)), 3) + 0.0 AS y, true AS back FROM k")
def laea(spark, sf):
    lon, lat = -9 + F.pmod("p_partkey", F.lit(120)) / 10.0, 36 + F.pmod("p_partkey", F.lit(77)) / 10.0
    b = table(spark, sf, "part").select("p_partkey", lon.alias("lon"), lat.alias("lat"))
    x, y = P.equal_area(F.col("lon"), F.col("lat"))
    b = b.withColumns({"x": x, "y": y})
    back = P.equal_area_inverse(F.col("x"), F.col("y"))
    return b.select("p_partkey", r("x", 3).alias("x"), r("y", 3).alias("y"), ((F.abs(back[0] - F.col("lon")) < 1e-7) & (F.abs(back[1] - F.col("lat")) < 1e-7)).alias("back"))


_STEPS = "".join(f", t{k + 1} AS (SELECT *, CASE WHEN 2 + 2 * cos(2 * a{k}) < 1e-12 THEN a{k} ELSE a{k} - (2 * a{k} + sin(2 * a{k}) - pi() * sin(phi)) / (2 + 2 * cos(2 * a{k})) END AS a{k + 1} FROM t{k})" for k in range(8))
_FAR, _K = 35786400.0 + 6378137.0, (6378137.0 / 6356752.3) ** 2


@query(f"WITH b AS (SELECT p_partkey, (p_partkey % 360)::DOUBLE - 180 AS lon0, radians((p_partkey % 171)::DOUBLE - 85) AS phi, ((p_partkey % 300)::DOUBLE - 150) / 1000 AS sx, ((p_partkey % 280)::DOUBLE - 140) / 1000 AS sy FROM part), t0 AS (SELECT *, phi AS a0 FROM b){_STEPS}, g AS (SELECT *, cos(sy) * cos(sy) + {_K!r} * sin(sy) * sin(sy) AS flat, {_FAR!r} * cos(sx) * cos(sy) AS ahead FROM t8), i AS (SELECT *, ahead * ahead - flat * {_FAR**2 - 6378137.0**2!r} AS inside FROM g), n AS (SELECT *, (ahead - sqrt(greatest(inside, 0))) / flat AS n FROM i), s AS (SELECT *, {_FAR!r} - n * cos(sx) * cos(sy) AS s1, n * sin(sx) * cos(sy) AS s2, n * sin(sy) AS s3 FROM n) SELECT p_partkey, round({P.SEMI_MAJOR!r} * 2 * sqrt(2) / pi() * radians(lon0) * cos(a8), 2) + 0.0 AS x, round({P.SEMI_MAJOR!r} * sqrt(2) * sin(a8), 2) + 0.0 AS y, CASE WHEN inside >= 0 THEN round(degrees(atan2(s2, s1)), 5) + 0.0 END AS lon, CASE WHEN inside >= 0 THEN round(degrees(atan({_K!r} * s3 / sqrt(s1 * s1 + s2 * s2))), 5) + 0.0 END AS lat, round(ln(tan(pi() / 4 + phi / 2)), 6) + 0.0 AS mercator FROM s")
def mollweide_geostationary(spark, sf):
    """Mollweide, scan-angle and Mercator places."""
    lon, lat = F.pmod("p_partkey", F.lit(360)) - 180.0, F.pmod("p_partkey", F.lit(171)) - 85.0
    x, y = P.mollweide(lon, lat)
    glon, glat = P.geostationary_inverse((F.pmod("p_partkey", F.lit(300)) - 150) / 1000.0, (F.pmod("p_partkey", F.lit(280)) - 140) / 1000.0)
    return table(spark, sf, "part").select("p_partkey", r(x, 2).alias("x"), r(y, 2).alias("y"), r(glon, 5).alias("lon"), r(glat, 5).alias("lat"), r(P.mercator_y(lat)).alias("mercator"))


_P = "WITH b AS (SELECT l_orderkey, l_linenumber, l_discount * l_tax * 20 AS p FROM lineitem)"


@query(f"{_P} SELECT {_KEYS}, CASE WHEN p >= 0.1276 THEN 'High' WHEN p >= 0.035728 THEN 'Elevated' WHEN p >= 0.008932 THEN 'Moderate' ELSE 'Low' END AS band FROM b")
def risk_band(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.risk_band(F.col("l_discount") * F.col("l_tax") * 20).alias("band"))


@query(f"{_P}, z AS (SELECT *, least(greatest((ln(greatest(p, 1e-12)) - ln(1.276e-3)) / (ln(19 * 1.276e-3) - ln(1.276e-3)), 0), 1) AS a FROM b) SELECT {_KEYS}, round(a, 6) + 0.0 AS place, round(255 * a + 30 * (1 - a), 4) + 0.0 AS red FROM z")
def colour_ramp(spark, sf):
    b = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.ramp_position(F.col("l_discount") * F.col("l_tax") * 20).alias("a"))
    return b.select("l_orderkey", "l_linenumber", r("a").alias("place"), r(S.blended(F.lit(255), F.lit(30), F.col("a")), 4).alias("red"))


@query("SELECT o_orderkey, round(year(o_orderdate) + dayofyear(o_orderdate) / 365.25::DOUBLE, 6) + 0.0 AS y FROM orders")
def fractional_year(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", r(S.fractional_year(F.to_date("o_orderdate"))).alias("y"))


@query(f"{_BASE}, p AS (SELECT *, least(greatest(rh / 100, 1e-8), 1 - 1e-8) AS p FROM b) SELECT {_KEYS}, round(1 / (1 + exp(-(ln(p / (1 - p)) + (w - 8) / 4))), 6) + 0.0 AS p FROM p")
def logit_adjust(spark, sf):
    return _out(_base(spark, sf), p=S.adjusted(F.col("rh") / 100, (F.col("w") - 8) / 4))


def _uniform(seed: int) -> str:
    return f"((CAST('0x' || substr(md5('{seed}|' || l_orderkey || '|' || l_linenumber), 1, 13) AS BIGINT))::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE"


@query(f"{_BASE} SELECT {_KEYS}, round(t + sqrt(-2 * ln({_uniform(7)})) * cos(2 * pi() * ({_uniform(8)})) * 0.5, 6) + 0.0 AS t FROM b")
def noise_shift(spark, sf):
    """Normal noise that a row's key settles."""
    return _base(spark, sf).select("l_orderkey", "l_linenumber", r(S.noisy(F.col("t"), 0.5, 7, F.col("l_orderkey"), F.col("l_linenumber"))).alias("t"))


@query("WITH b AS (SELECT event_id, hour(ts) + minute(ts) / 60.0::DOUBLE AS h FROM events) SELECT event_id, NOT ((h >= 0 AND h < 2.5) OR (h >= 11.7 AND h < 14.5) OR (h >= 23.7 AND h < 24)) AS gap FROM b")
def gap_slot(spark, sf):
    return table(spark, sf, "events").select("event_id", S.outside_passes(F.col("ts")).alias("gap"))


@query("WITH b AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 'inf'::DOUBLE ELSE p_size::DOUBLE END AS x FROM part), m AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM b WHERE x IS NOT NULL AND isfinite(x)) SELECT p_partkey, round(CASE WHEN x IS NULL OR NOT isfinite(x) THEN m ELSE x END, 6) + 0.0 AS mean_filled, CASE WHEN x IS NULL OR NOT isfinite(x) THEN 0.0::DOUBLE ELSE x END AS zero_filled, round(((CASE WHEN x IS NULL OR NOT isfinite(x) THEN m ELSE x END) - m) / s, 6) + 0.0 AS z FROM b, m")
def fill_policy(spark, sf):
    size = F.col("p_size")
    b = table(spark, sf, "part").select("p_partkey", F.when(size % 5 == 0, None).when(size % 7 == 0, float("inf")).otherwise(size.cast("double")).alias("x"))
    m = b.where(F.col("x") < float("inf")).agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    b = b.join(F.broadcast(m)).withColumn("f", filled(F.col("x"), "mean", F.col("m")))
    return b.select("p_partkey", r("f").alias("mean_filled"), filled(F.col("x"), "zero").alias("zero_filled"), r((F.col("f") - F.col("m")) / F.col("s")).alias("z"))


@query("WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE floor(o_totalprice) END AS s FROM orders) SELECT o_orderkey, CASE WHEN s IS NULL THEN '—' WHEN s < 120 THEN 'just now' WHEN s < 5400 THEN CAST(CAST(floor(s / 60) AS BIGINT) AS VARCHAR) || 'm ago' WHEN s < 172800 THEN CAST(CAST(floor(s / 3600) AS BIGINT) AS VARCHAR) || 'h ago' ELSE CAST(CAST(floor(s / 86400) AS BIGINT) AS VARCHAR) || 'd ago' END AS age FROM b")
def age_text(spark, sf):
    s = F.when(F.col("o_orderkey") % 50 != 0, F.floor("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", S.age_text(s).alias("age"))


_HOLIDAY_VALUES = ", ".join(f"(DATE '{d}', {'NULL' if c is None else c}::INTEGER)" for d, c in C.holiday_rows(1995, 2001))
_HOL = f"WITH h(day, region) AS (VALUES {_HOLIDAY_VALUES})"


@query(f"{_HOL} SELECT o.o_orderkey, EXISTS (SELECT 1 FROM h WHERE h.day = CAST(o.o_orderdate AS DATE) AND h.region IS NULL) AS national, EXISTS (SELECT 1 FROM h WHERE h.day = CAST(o.o_orderdate AS DATE) + 1 AND h.region IS NULL) AS national_next FROM orders o")
def holiday_flags(spark, sf):
    national = C.holidays(spark, 1995, 2002).where("region is null").select("day").distinct()
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).withColumn("next", F.date_add("day", 1))
    o = o.join(F.broadcast(national.withColumn("a", F.lit(True))), "day", "left").join(F.broadcast(national.select(F.col("day").alias("next"), F.lit(True).alias("b"))), "next", "left")
    return o.select("o_orderkey", F.coalesce("a", F.lit(False)).alias("national"), F.coalesce("b", F.lit(False)).alias("national_next"))


@query(f"{_HOL}, x AS (SELECT DISTINCT day, region FROM h WHERE region IS NOT NULL AND day NOT IN (SELECT day FROM h WHERE region IS NULL)) SELECT o.o_orderkey, x.day IS NOT NULL AS regional FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN x ON x.day = CAST(o.o_orderdate AS DATE) AND x.region = c.c_nationkey")
def regional_minus_national(spark, sf):
    """Holidays of a region alone, for orders of customers whose nation stands for the region."""
    only = C.regional_only(C.holidays(spark, 1995, 2001)).withColumn("regional", F.lit(True))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("region"))
    return o.join(c, "o_custkey").join(F.broadcast(only), ["day", "region"], "left").select("o_orderkey", F.coalesce("regional", F.lit(False)).alias("regional"))


@query("SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) + (dayofyear(o_orderdate) - 1)::INTEGER AS day, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def composite_tag(spark, sf):
    o = table(spark, sf, "orders").withColumn("tag", F.concat(F.lit("A"), F.date_format("o_orderdate", "yyyyDDD")))
    return o.select("o_orderkey", C.composite_day(F.col("tag")).alias("day"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"))


@query("SELECT p_partkey, upper(trim(p_name)) AS u, starts_with(p_name, 'red') AS s, replace(p_name, ' ', '_') AS t, CAST(p_size / 10 >= 1 AS INTEGER) + CAST(p_size >= 20 AS INTEGER) + CAST(p_size >= 40 AS INTEGER) AS bin, sha1(p_name) AS h FROM part")
def primitives(spark, sf):
    """String, digitising and hash primitives."""
    size = F.col("p_size")
    bins = sum((F.when(size >= e, 1).otherwise(0) for e in (10, 20, 40)), F.lit(0))
    return table(spark, sf, "part").select("p_partkey", F.upper(F.trim("p_name")).alias("u"), F.startswith("p_name", F.lit("red")).alias("s"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("t"), bins.alias("bin"), F.sha1(F.col("p_name").cast("binary")).alias("h"))
