"""Operators against plain loops, and properties that hold for any input."""

import uuid
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.grid import KILOMETRE, Grid
from gridweave.operators import aggregates as A
from gridweave.operators import correlation, metrics, recursive, sampling, spatial, watershed
from gridweave.operators import temporal_join as J
from gridweave.operators import windows as W
from gridweave.plans import features, maintain, model, serving
from gridweave.queries import base
from gridweave.sources import readers, sinks
from gridweave.streaming import jobs

DAY = date(2000, 1, 1)


def series(spark, values, name="x", kind="double", cell=0):
    return spark.createDataFrame([(cell, DAY + timedelta(i), v) for i, v in enumerate(values)], f"cell int, day date, {name} {kind}")


def column(df, name):
    return [getattr(r, name) for r in df.orderBy("cell", "day").collect()]


def test_run_lengths(spark):
    w = W.along()
    df = series(spark, [1.0, 1.0, 9.0, 1.0])
    assert column(W.run_lengths(df, w, n=F.col("x") < 5), "n") == [1, 2, 0, 1]
    df = series(spark, [1.0, None, 1.0])
    assert column(W.run_lengths(df, w, n=F.col("x") < 5), "n") == [1, 0, 1]


def test_sums(spark):
    w = W.along()
    df = series(spark, [1.0, 2.0, 3.0, 4.0])
    assert column(df.withColumn("s", W.trailing_sum(F.col("x"), 3, w)), "s") == [1, 3, 6, 9]
    assert column(df.withColumn("s", W.strict_sum(F.col("x"), 3, w)), "s") == [None, None, 6, 9]
    gap = series(spark, [1.0, None, 3.0, 4.0, 5.0, 6.0])
    assert column(gap.withColumn("s", W.strict_sum(F.col("x"), 3, w, complete=True)), "s") == [None, None, None, None, 12, 15]
    assert column(gap.withColumn("s", W.poisoned_sum(F.col("x"), 2, w)), "s") == [None] * 6
    with pytest.raises(ValueError):
        W.trailing_sum(F.col("x"), 0, w)


@pytest.mark.parametrize(("prior", "x", "z"), [([1.0, 3.0], 5.0, 3 / (1 + 1e-6)), ([1.0], 5.0, None), ([2.0, 2.0], 3.0, 10.0)])
def test_causal_departure(spark, prior, x, z):
    df = series(spark, [*prior, x]).withColumn("k", F.lit(1))
    got = column(df.withColumn("z", W.causal_zscore(F.col("x"), ["cell", "k"], "day")), "z")[-1]
    assert got == (pytest.approx(z, abs=1e-6) if z is not None else None)


def test_counters(spark):
    df = series(spark, [0, 1, None, 0], "e", "int")
    assert column(W.counter(df, W.along(), F.col("e") == 1, F.lit(4), "n"), "n") == [5, 0, 1, 2]
    assert column(W.days_since(df, W.along(), F.col("e") == 1, "n"), "n") == [1, 0, 1, 2]
    assert column(W.days_since(df, W.along(), F.col("e") == 1, "n", before_first="null"), "n") == [None, 0, 1, 2]
    assert column(df.withColumn("y", W.within_horizon(F.col("e") == 1, 2, W.along())), "y") == [1, 0, None, None]


def loop_drought(days, q=0.0, wet=0.0):
    out = []
    for rain, heat, year in days:
        new = wet + rain if rain > 0 else 0.0
        net = max(new - 5.08, 0) - max(wet - 5.08, 0) if rain > 0 else 0.0
        q, wet = max(q - net, 0), new
        dq = (203.2 - q) * (0.968 * np.exp(0.0875 * heat + 1.5552) - 8.30) / (1 + 10.88 * np.exp(-0.001736 * year)) * 1e-3
        q = min(q + max(dq, 0), 203.2)
        out.append((q, wet))
    return out


def test_drought_against_a_loop_and_resumed(spark):
    rng = np.random.default_rng(1)
    rows = [(c, DAY + timedelta(i), float(rng.choice([0, 0, 3, 12])), float(rng.uniform(-5, 38)), 450.0 + c) for c in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, "cell int, day date, rain double, tmax double, annual double")
    got = {(r.cell, r.day): (r.q, r.wet) for r in recursive.drought(df).collect()}
    for c in range(3):
        own = [r for r in rows if r[0] == c]
        for r, expected in zip(own, loop_drought([r[2:] for r in own]), strict=True):
            assert got[c, r[1]] == pytest.approx(expected, abs=1e-9)
    cut = DAY + timedelta(31)
    state = spark.createDataFrame([(c, *got[c, cut]) for c in range(3)], "cell int, q0 double, wet0 double")
    rest = recursive.drought(df.where(F.col("day") > cut).join(state, "cell"), q0="q0", wet0="wet0").collect()
    assert len(rest) == 84 and all(got[r.cell, r.day] == (r.q, r.wet) for r in rest)
    assert list(recursive.fold([(0.0, -20.0, 400.0), (None, 1.0, 1.0), (1.0, float("nan"), 1.0)])) == [(0.0, 0.0), (None, 0.0), (None, 0.0)]
    missing = recursive.drought(series(spark, [1.0, None, 1.0], "rain").withColumns({"tmax": F.lit(30.0), "annual": F.lit(400.0)})).orderBy("day").collect()
    assert missing[1].q is None and missing[2].q is not None


def test_streamed_drought_equals_batch(spark, tmp_path):
    rows = [(0, DAY + timedelta(i), float(i % 4), 20.0 + i, 500.0) for i in range(6)]
    schema = "cell long, day date, rain double, tmax double, annual double"
    for k in (0, 3):
        spark.createDataFrame(rows[k : k + 3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.run_once(jobs.drought(jobs.read_new(spark, str(tmp_path / "in"), schema)), str(tmp_path / "state"), lambda b, n: b.write.mode("append").parquet(out))
    got = [(r.q, r.wet) for r in spark.read.parquet(out).orderBy("day").collect()]
    assert got == [pytest.approx(e) for e in loop_drought([r[2:] for r in rows])]


def test_nearest_events(spark):
    grid = Grid(0, 0, 2000, -2000, 5, 5)
    cells = grid.cells(spark).select("cell", F.lit(DAY).alias("day"), (F.col("cell") == 0).cast("int").alias("is_fire"), F.lit(1.0).alias("wind_u"), F.when(F.col("cell") != 7, 0.0).alias("wind_v"))
    got = {r.cell: r for r in spatial.nearest_events(cells, grid).collect()}
    assert got[3 * 5 + 4].dist_km == pytest.approx(10.0) and got[0].dist_km == 0 and got[0].exposure == 0
    assert got[1].exposure == pytest.approx(2000 / 2000**2) and got[7].exposure is None and got[24].nearest == 0
    none = spatial.nearest_events(cells.withColumn("is_fire", F.lit(0)), grid).collect()
    assert all(r.dist_km == pytest.approx(np.hypot(5, 5) * 2) and r.exposure == 0.0 for r in none)


def test_distances_move_with_the_grid(spark):
    rng = np.random.default_rng(4)
    fire = rng.random((7, 6)) < 0.15
    fire[3, 3] = True

    def distances(shift):
        grid = Grid(0, 0, 1000, -1000, 12, 12)
        rows = [((y + shift) * 12 + x + shift, int(fire[y, x])) for y in range(7) for x in range(6)]
        df = spark.createDataFrame(rows, "cell int, is_fire int").withColumns({"day": F.lit(DAY), "wind_u": F.lit(0.0), "wind_v": F.lit(0.0)})
        return {(r.cell // 12 - shift, r.cell % 12 - shift): r.dist_km for r in spatial.nearest_events(df, grid).collect()}

    a, b = distances(0), distances(4)
    assert a == b
    ys, xs = np.nonzero(fire)
    assert all(d == pytest.approx(np.sqrt((ys - y) ** 2 + (xs - x) ** 2).min()) for (y, x), d in a.items())


def test_pooling_and_refining(spark):
    assert [spatial.pooling(n) for n in ("is_fire", "t2m_max", "RH_min", "t2m_mean")] == ["max", "max", "min", "avg"]
    grid = Grid(0, 0, 1, -1, 4, 4)
    df = spark.createDataFrame([(DAY, c, float(c), c % 3) for c in range(16)], "day date, cell int, t_mean double, code int")
    coarse = spatial.block_pool(df, grid, 2, ["t_mean"], codes=("code",))
    assert [(r.cell, r.t_mean, r.code) for r in coarse.orderBy("cell").collect()] == [(0, 2.5, 1), (1, 4.5, 0), (2, 10.5, 0), (3, 12.5, 2)]
    fine = {r.cell: r.t_mean for r in spatial.refine(coarse, grid.coarse(2), 2).collect()}
    assert len(fine) == 16 and fine[0] == fine[5] == 2.5
    with pytest.raises(ValueError):
        Grid(0, 0, 1, 1, 5, 4).coarse(2)
    assert KILOMETRE.coarse(4).nx == 297 and KILOMETRE.bounds()[0] == KILOMETRE.x0 - 500


def test_terrain_against_numpy(spark):
    grid = Grid(0, 0, 1, 1, 6, 5)
    e = np.random.default_rng(2).uniform(0, 100, (5, 6))
    e[2, 2] = np.nan
    df = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(e.ravel())], "cell int, e double")
    padded = np.pad(e, 2, mode="edge")
    tpi = {r.cell: r.tpi for r in spatial.position_index(df, grid, "e").collect()}
    zero = np.pad(np.nan_to_num(e), 1, mode="edge")
    bend = {r.cell: r.curvature for r in spatial.curvature(df, grid, "e").collect()}
    for y in range(5):
        for x in range(6):
            around = padded[y : y + 5, x : x + 5]
            assert tpi[y * 6 + x] == (None if np.isnan(e[y, x]) else pytest.approx(e[y, x] - np.nanmean(around)))
            assert bend[y * 6 + x] == pytest.approx(zero[y, x + 1] + zero[y + 2, x + 1] + zero[y + 1, x] + zero[y + 1, x + 2] - 4 * zero[y + 1, x + 1])


def test_regridding_is_exact_on_planes(spark):
    xs, ys = [0.0, 1.0, 2.0], [0.0, 1.0, 2.0]
    targets = spark.createDataFrame([(0, 0.25, 0.75), (1, 1.5, 0.5), (2, 5.0, 5.0)], "cell int, px double, py double")
    field = spark.createDataFrame([(DAY, j * 3 + i, 2.0 * i + 3.0 * j) for i in range(3) for j in range(3)], "day date, src_id int, value double")
    weights = spatial.regrid_weights(spark, xs, ys, targets)
    got = {r.cell: r.value for r in spatial.regridded(field, weights).collect()}
    assert got == {0: pytest.approx(2.75), 1: pytest.approx(4.5), 2: pytest.approx(10.0)}
    holes = field.withColumn("value", F.when(F.col("src_id") != 3, F.col("value")))
    assert {r.cell: r.value for r in spatial.regridded(holes, weights).collect()}[0] is not None


def weighted_nearest(points, x, y, k, power=2.0):
    """Of (src_id, px, py, value) by a plain sort."""
    near = sorted((max(float(np.hypot(x - p[1], y - p[2])), 1.0), p[0], p[3]) for p in points)[:k]
    weights = [d**-power for d, _, _ in near]
    return sum(w * v for w, (_, _, v) in zip(weights, near, strict=True)) / sum(weights)


@pytest.mark.parametrize("step", [None, 5.0, 20.0])
def test_interpolation_equals_a_plain_sort(spark, step):
    rng = np.random.default_rng(2)
    # A dense cluster, copies of one place, a few far points, and targets far from all.
    places = np.vstack([rng.uniform(0, 10, (60, 2)), np.full((20, 2), 4.5), rng.uniform(500, 900, (6, 2))])
    rows = [(i % 2, i, float(x), float(y), None if i % 13 == 0 else float(i * i % 31)) for i, (x, y) in enumerate(places)]
    rows += [(2, 500, 1.0, 1.0, 7.0), (None, 501, 2.0, 2.0, 9.0), (1, 502, None, 2.0, 9.0)]
    points = spark.createDataFrame(rows, "run int, src_id int, px double, py double, value double")
    asked = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-40, 40, (25, 2)))] + [(90, 4.5, 4.5), (91, 700.0, 700.0), (92, -300.0, 0.0)]
    targets = spark.createDataFrame([*asked, (93, None, 1.0)], "cell int, tx double, ty double")
    known = [r for r in rows if r[2] is not None and r[4] is not None]
    got = {r.cell: r.value for r in spatial.interpolated(points, targets, k=5, step=step).collect()}
    assert got == {c: pytest.approx(weighted_nearest([r[1:] for r in known], x, y, 5)) for c, x, y in asked}
    got = {(r.run, r.cell): r.value for r in spatial.interpolated(points, targets, k=5, keys=("run",), step=step).collect()}
    assert got == {(run, c): pytest.approx(weighted_nearest([r[1:] for r in known if r[0] == run], x, y, 5)) for run in (0, 1, 2, None) for c, x, y in asked}


def test_interpolation_of_many_points(spark):
    n = 10_100
    points = spark.range(n).selectExpr("cast(id as int) as src_id", "cast(id % 101 as double) as px", "cast(id div 101 as double) as py", "cast(id as double) as value")
    targets = spark.createDataFrame([(0, 50.2, 50.1), (1, -300.0, 12.0)], "cell int, tx double, ty double")
    got = {r.cell: r.value for r in spatial.interpolated(points, targets, k=4).collect()}
    at = np.arange(n)
    for cell, x, y in ((0, 50.2, 50.1), (1, -300.0, 12.0)):
        d = np.maximum(np.hypot(at % 101 - x, at // 101 - y), 1)
        near = np.lexsort((at, d))[:4]
        assert got[cell] == pytest.approx((near / d[near] ** 2).sum() / (1 / d[near] ** 2).sum())


def test_regions_and_areas(spark):
    grid = Grid(0, 0, 2000, -2000, 30, 30)
    p = np.zeros((30, 30))
    p[3:5, 3:5], p[20:22, 20:22] = 0.3, 0.2
    rows = [(DAY, i, float(v), 1 + (i > 450), 1) for i, v in enumerate(p.ravel())]
    df = spark.createDataFrame(rows, "day date, cell int, p double, regime int, region int")
    got = watershed.danger_areas(df, grid).orderBy("area").collect()
    assert [round(r.p_any, 6) for r in got] == [round(1 - 0.7**4, 6), round(1 - 0.8**4, 6)]
    assert [(r.n_cells, r.regime) for r in got] == [(4, 1), (4, 2)]
    assert watershed.danger_areas(df.withColumn("p", F.lit(0.0)), grid).count() == 0


def test_joins_in_time(spark):
    days = spark.createDataFrame([(0, DAY + timedelta(i)) for i in (-3, 4, 20)], "cell int, day date")
    ed = spark.createDataFrame([(0, DAY, 10.0), (0, DAY + timedelta(16), 26.0)], "cell int, edition date, value double")
    assert column(J.interpolated(days, ed), "value") == [10, 14, 26]
    assert column(J.nearest(days, ed), "value") == [10, 10, 26]
    assert column(J.as_of(days, ed), "value") == [None, 10, 26]
    assert column(series(spark, [5.0, None, None]).withColumn("y", J.carried_forward(F.col("x"))), "y") == [5, 5, 5]


def test_aggregates(spark):
    df = spark.createDataFrame([(0.5,), (0.5,)], "p double")
    assert df.agg(A.any_event(F.col("p")).alias("a")).first().a == pytest.approx(0.75)
    hours = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-01 05:00:00", 7.2), ("2024-01-01 06:00:00", 7.2)], "ts string, s double")
    full = hours.select(F.to_timestamp("ts").alias("ts"), F.lit(1).alias("src_id"), *[F.lit(1.0).alias(c) for c in ("t2m", "rh", "pressure", "soil_moisture", "soil_temperature")], F.col("s").alias("speed_kmh"), F.when(F.hour("ts") == 5, 90.0).otherwise(270.0).alias("direction"), F.lit(12.0).alias("precipitation"))
    day = A.daily(full).first()
    assert day.wind_u_atmaxspeed == pytest.approx(-2.0) and day.total_precipitation_mean == pytest.approx(1.5)
    assert A.daily(full, need=24).count() == 0
    with pytest.raises(Exception, match="nothing here"):
        A.expect(spark.createDataFrame([(None,)], "a double"), a="nothing here").collect()


def test_metrics(spark):
    rng = np.random.default_rng(0)
    p, y = np.round(rng.random(300), 2), (rng.random(300) < 0.3).astype(int)
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(p, y, strict=True))], "id int, p double, y int")
    pos, neg = p[y == 1], p[y == 0]
    assert metrics.roc_auc(df, "p", "y").first().auc == pytest.approx(((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean())
    ap = sum((y[p == t].sum() / y.sum()) * y[p >= t].mean() for t in np.unique(p))
    assert metrics.average_precision(df, "p", "y").first().ap == pytest.approx(ap)
    assert metrics.roc_auc(df.where("y = 0"), "p", "y").first().auc is None
    top = metrics.reliability(spark.createDataFrame([(1.0, 1)], "p double, y int"), "p", "y").first()
    assert top.bin == len(metrics.edges()) - 2
    few = sampling.matched(df, "y", 1, "id")
    assert few.where("y = 0").count() == min((y == 0).sum(), y.sum()) and few.where("y = 1").count() == y.sum()


def test_correlation_clusters(spark):
    df = spark.createDataFrame([(float(i), float(i * i), float((i * 7) % 11)) for i in range(40)], "a double, b double, c double")
    rho = {(r.x, r.y): r.rho for r in correlation.spearman_pairs(df, ["a", "b", "c"]).collect()}
    assert rho["a", "b"] == pytest.approx(1.0)
    assert correlation.clusters(["a", "b", "c"], rho) == [["a", "b"], ["c"]]


def test_maintenance(spark, tmp_path):
    plan = maintain.plan(None, date(2024, 1, 10), date(2024, 1, 20))
    assert (plan["start"], plan["end"], plan["days"]) == (date(2024, 1, 11), date(2024, 1, 14), 4)
    assert maintain.plan(None, date(2024, 1, 14), date(2024, 1, 20))["current"]
    assert maintain.due(100, 60, None, gap=45) is False and maintain.due(200, 60, 150) is False and maintain.due(900, 60, 150)
    at = str(tmp_path / "t")
    one, two = series(spark, [1.0, 2.0]), series(spark, [9.0, 8.0, 7.0])
    sinks.append_new(one, at)
    sinks.append_new(two, at)
    sinks.append_new(two, at)
    assert sorted(r.x for r in spark.read.parquet(at).collect()) == [1.0, 2.0, 7.0]
    sinks.replace_days(two.where(F.col("day") == DAY), at)
    assert sorted(r.x for r in spark.read.parquet(at).collect()) == [2.0, 7.0, 9.0]
    sinks.publish(spark, str(tmp_path / "m"), {"issue": "2024-01-01"})
    assert sinks.manifest(spark, str(tmp_path / "m")) == {"issue": "2024-01-01"} and sinks.manifest(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="bad"):
        sinks.quality_gate(one.withColumn("bad", F.lit(None).cast("double")), ["x", "bad"])


def test_sources(spark, tmp_path):
    (tmp_path / "d.csv").write_text("latitude,longitude,acq_date,confidence\n40.0,-3.0,2024-01-01, H \n41.0,-3.0,2024-01-01,l\n")
    found = readers.detections(spark, str(tmp_path / "d.csv"))
    assert readers.confident(found).count() == 1 and readers.confident(found.drop("confidence")).count() == 2
    cells = spatial.rasterized(found.withColumnRenamed("acq_date", "day"), KILOMETRE)
    assert cells.count() == 2


def test_edge_equals_whole_chain(spark, tmp_path):
    # Two years and a month without gaps, so that there are earlier occurrences and windows reach to the tail's end.
    days = spark.sql("select explode(sequence(date'2022-01-01', date'2024-01-27')) as day").join(spark.range(4).select(F.col("id").cast("int").alias("cell")))
    u = lambda k: F.pmod(F.xxhash64("day", "cell", F.lit(k)), F.lit(1000)) / 1000.0
    raw = {"is_fire": (u(0) < 0.05).cast("int"), "total_precipitation_mean": F.when(u(1) > 0.1, u(1) / 50), "t2m_max": 15 + 20 * u(2), "RH_min": 60 * u(3), "wind_speed_max": 9 * u(4), "wind_u_mean": u(5) - 0.5, "wind_v_mean": u(6) - 0.5, "NDVI": u(7), "LAI": 3 * u(8)}
    cube = days.withColumns(raw).cache()
    annual = features.annual_rain(cube)
    layers = {"elevation_mean": 100.0 * F.col("cell"), "CLC_2018_artificial_proportion": (F.col("cell") == 2).cast("double"), "slope_mean": F.lit(3.0), "region": F.lit(13), **{f"aspect_{k}": F.lit(k / 36) for k in range(1, 9)}}
    land = features.terrain(spark.range(4).select(F.col("id").cast("int").alias("cell")).withColumns(layers), base.WIDE).cache()
    whole = features.engineered(cube, base.WIDE, annual, land).cache()
    # 546 days: two edges, of which the second goes on from what the first one leaves.
    cut, last = date(2022, 7, 30), date(2024, 1, 27)
    done = whole.where(F.col("day") <= F.lit(cut))
    with pytest.raises(ValueError, match="a year at a time"):
        features.edge(cube, base.WIDE, str(cut), annual, features.state(done, str(cut)), features.moments(done))

    def kept(df):
        at = str(tmp_path / uuid.uuid4().hex)
        df.write.parquet(at)
        return spark.read.parquet(at)

    steps = list(features.edges(cube, base.WIDE, cut, annual, features.state(done, str(cut)), features.moments(done), kept, land=land))
    assert [s[0] for s in steps] == [cut + timedelta(365), last]
    new = steps[0][1].unionByName(steps[1][1])
    names = sorted(set(whole.columns))
    assert sorted(new.columns) == names and {"hli", "dist_to_urban", "is_holiday_regional_tp1"} <= set(names)
    a = {(r.cell, r.day): r for r in whole.where(F.col("day") > F.lit(cut)).collect()}
    b = {(r.cell, r.day): r for r in new.collect()}
    assert a.keys() == b.keys() and len(a) == 4 * 546
    for at, row in a.items():
        for n in names:
            assert b[at][n] == (pytest.approx(row[n], abs=1e-8) if isinstance(row[n], float) else row[n]), n
    assert any(r.ndvi_anomaly is not None for r in b.values()) and {r.is_holiday_national for r in b.values()} == {0, 1}
    state = {r.cell: (r.q0, r.since0) for r in steps[1][2].collect()}
    for c, (q0, since) in state.items():  # a day without rain has no index and leaves the state
        index = a[c, last].kbdi
        assert (q0 > 0 if index is None else q0 == pytest.approx(index)) and since == a[c, last].time_since_last_fire


def test_state_of_a_cell_without_an_index_for_years(spark):
    rows = [(1, date(2020, 1, 1), 50.0, 3.0, 7), (1, date(2023, 1, 1), None, None, 9), (2, date(2023, 1, 1), 5.0, 1.0, 1)]
    built = spark.createDataFrame(rows, "cell int, day date, kbdi double, kbdi_wet double, time_since_last_fire int")
    assert {r.cell: (r.q0, r.wet0, r.since0) for r in features.state(built, "2023-01-01").collect()} == {1: (50.0, 3.0, 9), 2: (5.0, 1.0, 1)}
    new = spark.createDataFrame([(2, date(2024, 1, 1), 6.0, 0.0, 2), (3, date(2024, 1, 1), 7.0, 0.0, 0)], built.schema)
    after = features.state(new, "2024-01-01", features.state(built, "2023-01-01"))
    assert {r.cell: (r.q0, r.since0) for r in after.collect()} == {1: (50.0, 9), 2: (6.0, 2), 3: (7.0, 0)}


def test_departures_without_a_bound(spark):
    df = series(spark, [1.0, 1.0, 5.0]).withColumn("k", F.lit(1))
    cut, free = (column(df.withColumn("y", W.causal_zscore(F.col("x"), ["k"], "day", bound=b)), "y")[2] for b in (10.0, None))
    assert cut == 10.0 and free == pytest.approx(4e6)
    big = series(spark, [101325.0 + x for x in (0.01, 0.02, 0.03, 0.05)]).withColumn("k", F.lit(1))
    z = column(big.withColumn("y", W.causal_zscore(F.col("x"), ["k"], "day", eps=0.0)), "y")[3]
    assert z == pytest.approx(0.03 / np.std([0.01, 0.02, 0.03]), rel=1e-4)


def test_running_sums_equal_plain_ones(spark):
    values = [0.1, None, 0.25, -3.75, None, 1e6, 2.0, 0.0]
    df = series(spark, values)
    w = W.along()
    got = df.select("day", W.trailing_sum(F.col("x"), 3, w).alias("a"), W.strict_sum(F.col("x"), 3, w).alias("b"), W.strict_sum(F.col("x"), 2, w, complete=True).alias("c")).orderBy("day").collect()
    for i, r in enumerate(got):
        last = [v for v in values[max(0, i - 2) : i + 1] if v is not None]
        plain = pytest.approx(sum(last), abs=1e-8) if last else None
        assert r.a == plain and r.b == (plain if i >= 2 else None)
        two = values[max(0, i - 1) : i + 1]
        assert r.c == (pytest.approx(sum(two), abs=1e-8) if len(two) == 2 and None not in two else None)


def test_nearest_events_equal_all_pairs_on_sparse_grids(spark):
    rng, grid, rows = np.random.default_rng(1), Grid(0, 0, 2000, -2000, 9, 13), []
    for day in (None, 1, 2, 3, 4, 5, 6, 7, 8, 9):
        share = [0, 0.01, 0.1, 0.5, 0.9][(day or 0) % 5]
        rows += [(day, c, int(rng.random() < share), float(rng.normal()), None if rng.random() < 0.1 else 1.0) for c in range(117) if rng.random() < 0.9]
    got = {(r.day, r.cell): r for r in spatial.nearest_events(spark.createDataFrame(rows, "day int, cell int, is_fire int, wind_u double, wind_v double"), grid).collect()}
    assert len(got) == len(rows)
    for day, c, _, u, v in rows:
        r, y, x = got[day, c], c // 9, c % 9
        near = min((((y - e // 9) ** 2 + (x - e % 9) ** 2, e) for d, e, fire, _, _ in rows if d == day and fire), default=None)
        if near is None:
            assert (r.nearest, r.dist_km, r.exposure) == (None, grid.diagonal_km(), 0.0)
            continue
        square, e = near
        assert r.nearest == e and r.dist_km == pytest.approx(2 * square**0.5)
        want = 0.0 if not square else None if v is None else (u * (x - e % 9) * 2000 - v * (y - e // 9) * 2000) / (square * 4e6)
        assert r.exposure == (pytest.approx(want) if want is not None else None)


def test_ranks_of_many_ties_and_gaps(spark):
    rng = np.random.default_rng(6)
    n = 3000
    v = np.stack([np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n)), rng.integers(0, 40, n).astype(float), rng.normal(size=n), np.full(n, 7.0)], 1)
    v[rng.random(n) < 0.2, 2] = np.nan
    v[:, 1] += v[:, 0]
    names = ["zeros", "whole", "gaps", "same", "none"]
    df = spark.createDataFrame([(i, *[None if np.isnan(x) else float(x) for x in r], None) for i, r in enumerate(v)], "id int, zeros double, whole double, gaps double, same double, none double").repartition(5)
    rank = lambda x: np.array([(x < a).sum() + ((x == a).sum() + 1) / 2 for a in x])
    want = {}
    for i, a in enumerate(names[:3]):
        for j, b in enumerate(names[:3]):
            if i < j:
                r = [np.full(n, np.nan), np.full(n, np.nan)]
                for k, c in enumerate((i, j)):
                    r[k][~np.isnan(v[:, c])] = rank(v[~np.isnan(v[:, c]), c])
                both = ~np.isnan(r[0] + r[1])
                want[a, b] = np.corrcoef(r[0][both], r[1][both])[0, 1]
    got = {(r.x, r.y): r.rho for r in correlation.spearman_pairs(df, names).collect()}
    assert len(got) == 10 and all(got[k] == pytest.approx(x) for k, x in want.items())
    assert all(rho is None for (a, b), rho in got.items() if {"same", "none"} & {a, b})
    parts = correlation.ranks(df, names, 16)
    assert parts.count() == n and sorted(r.r0 for r in parts.select("r0").collect()) == sorted(rank(v[:, 0]))


def test_percentile_of_scores_by_ranges(spark):
    for values in ([0.5], [0.1, 0.2, 0.2, 0.9], [float(x) for x in np.random.default_rng(2).integers(1, 50, 777) / 50]):
        df = spark.createDataFrame([(x,) for x in [*values, 0.0, -1.0]], "p double")
        assert serving.stretch(df).first().p99 == pytest.approx(np.percentile(values, 99))
    assert serving.stretch(df.where("p < 0")).first().p99 is None


def test_running_sums_of_any_size(spark):
    w, nan, inf = W.along(), float("nan"), float("inf")
    total = lambda values, n=365: column(series(spark, values).withColumn("y", W.trailing_sum(F.col("x"), n, w)), "y")
    assert total([1e-10, 2e-10, 3e-10]) == pytest.approx([1e-10, 3e-10, 6e-10], rel=1e-12)
    assert total([1.0, nan, inf, -2.5], 2) == [1.0, 1.0, None, -2.5]
    assert total([1e25, 1e-5, -7e-5, 4e-5], 2) == pytest.approx([1e25, 1e25, -6e-5, -3e-5])
    long = spark.range(12000).select(F.lit(1).alias("cell"), F.col("id").alias("day"), F.lit(9e5).alias("x"))
    assert long.select(W.trailing_sum(F.col("x"), 365, w).alias("y")).agg(F.max("y")).first()[0] == 365 * 9e5


def test_streams(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{small}/events.parquet*")
    out = str(tmp_path / "days")
    done = jobs.daily(stream, ["event_type"], "value").select("day", "event_type", "n")
    for _ in range(2):
        jobs.run_once(done, str(tmp_path / "c"), jobs.upsert_into(out))
    batch = spark.read.parquet(f"{small}/events.parquet").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    got = spark.read.parquet(out).select("day", "event_type", "n")
    assert got.count() and got.subtract(batch).count() == 0


def test_models(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b) if i % 9 else None, int(c), 1 + i % 2) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))], "cell int, t2m_mean double, kbdi double, y int, regime int")
    m = model.logistic(df, ["t2m_mean", "kbdi"])
    s = model.scored(m, df, ["t2m_mean", "kbdi"])
    assert metrics.roc_auc(s, "p", "y").first().auc > 0.9
    q = model.calibrated(model.isotonic(s), s)
    assert q.agg(F.min("p"), F.max("p")).first()[1] <= 1.0
    top = serving.drivers(df.drop("y"), ["t2m_mean", "kbdi"], lambda d: model.scored(m, d, ["t2m_mean", "kbdi"]), cells=50)
    assert {r.feature for r in top.where("rank = 1").collect()} == {"t2m_mean"}
    assert [r.drivers for r in serving.drivers_json(top).collect()][0].startswith('[{"feature":"t2m_mean"')
    assert model.early_stopped([(0.1, 0.1), (0.3, 0.3), (0.2, 0.2), (0.2, 0.1), (0.1, 0.1), (0.9, 0.9)], patience=3) == 1
