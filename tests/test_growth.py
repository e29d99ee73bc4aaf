"""Steps that grew faster than their tables, or whose figures did."""

import re
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridweave.functions import calendar
from gridweave.grid import Grid
from gridweave.operators import aggregates, recursive, spatial, windows
from gridweave.plans import features, model
from gridweave.queries import upkeep
from gridweave.sources import sinks
from gridweave.streaming import jobs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_gap_free_table_is_not_joined_with_all_days(spark, small, monkeypatch):
    monkeypatch.setattr(calendar, "ROWS", 1000)
    for name in ("grid_validation", "trail_sum_30"):
        plan = plan_of(entry.queries()[name](spark, small))
        assert "Join" not in plan and plan.count("hashpartitioning(cell") == 1, name


def test_a_climatology_deals_its_cube_out_once(spark, small, monkeypatch):
    monkeypatch.setattr(calendar, "ROWS", 1000)
    plan = plan_of(entry.queries()["climatology_score"](spark, small))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_climatology_of_odd_rows(spark):
    rows = [(1, 5, 1990, 1), (1, 5, 1991, 0), (1, 5, 2001, 1), (1, 5, 2002, None), (1, 6, 2001, 1), (2, 5, 1990, None), (2, 5, 2001, 1), (None, 5, 1990, 1), (None, 5, 2001, 0)]
    df = spark.createDataFrame(rows, "cell int, doy int, year int, e int")
    got = aggregates.climatology(df, "e", F.col("year") < 2000).where("year >= 2000").collect()
    assert sorted(((r.cell or 0, r.doy, r.year, r.rate) for r in got)) == [(0, 5, 2001, 0.0), (1, 5, 2001, 0.5), (1, 5, 2002, 0.5), (1, 6, 2001, 0.0), (2, 5, 2001, 0.0)]


def test_several_sums_take_their_running_sums_once(spark, small, monkeypatch):
    monkeypatch.setattr(calendar, "ROWS", 1000)
    plan = entry.queries()["strict_roll_365"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(") == len(windows.UNITS) + 1  # and the cube's own


def test_several_sums_are_those_taken_one_by_one(spark):
    rng = np.random.default_rng(8)
    odd = [None, float("nan"), float("inf"), -float("inf"), 1e30, -1e30, 1e-20, 0.0, -0.0]
    rows = [(c, k, odd[rng.integers(9)] if rng.random() < (0, 0.2, 0.9)[c] else float(rng.normal())) for c in range(3) for k in range(60)] + [(None, k, float(k)) for k in range(5)] + [(7, 0, None), (8, 0, 2.0)]
    df, x, w = spark.createDataFrame(rows, "cell int, day int, x double"), F.col("x"), windows.along()
    sums = {f"{rule}_{n}": (n, rule) for n in (1, 3, 20, 100) for rule in windows.RULES}
    one = {"any": windows.trailing_sum, "strict": windows.strict_sum, "complete": lambda *a: windows.strict_sum(*a, complete=True), "poisoned": windows.poisoned_sum}
    by_one = df.withColumns({name: one[rule](x, n, w) for name, (n, rule) in sums.items()})
    got = windows.rolled(df, x, w, **sums)
    assert got.columns == by_one.columns and sorted(map(str, got.collect())) == sorted(map(str, by_one.collect()))


def test_gap_free_of_odd_rows(spark):
    d = lambda k: date(2024, 1, k)
    rows = [(1, d(3), 1.0), (1, d(3), 2.0), (1, d(6), None), (2, None, 5.0), (2, d(2), 7.0), (3, None, 9.0), (None, d(4), 8.0), (4, d(8), 4.0)]
    df = spark.createDataFrame(rows, "cell int, day date, x double")
    got = calendar.gap_free(df, "day", "cell", F.sum("x").alias("x"), F.count("*").alias("n")).collect()
    found = {(1, d(3)): (3.0, 2), (1, d(6)): (None, 1), (2, d(2)): (7.0, 1), (4, d(8)): (4.0, 1)}
    assert sorted(((r.cell or 0, r.day, r.x, r.n) for r in got), key=lambda r: r[:2]) == [(c, d(2) + timedelta(k), *found.get((c, d(2) + timedelta(k)), (None, None))) for c in (0, 1, 2, 3, 4) for k in range(7)]
    assert calendar.gap_free(df.limit(0), "day", "cell", F.sum("x").alias("x")).count() == 0


def test_a_bucket_is_as_large_as_a_task(spark, small, monkeypatch):
    seen, write = [], sinks.bucketed
    monkeypatch.setattr(upkeep, "ROWS", 100)
    monkeypatch.setattr(sinks, "bucketed", lambda df, table, path, buckets, by, sort: seen.append(buckets) or write(df, table, path, buckets, by, sort))
    rows = spark.read.parquet(f"{small}/lineitem.parquet").count()
    entry.queries()["bucketed_layout"](spark, small)
    assert seen == [-(-rows // 100)] * 2


def test_targets_are_dealt_out_by_their_pairs(spark, monkeypatch):
    points = spark.range(40).select(F.col("id").alias("src_id"), (F.col("id") % 7).cast("double").alias("px"), (F.col("id") % 5).cast("double").alias("py"), F.col("id").cast("double").alias("value"))
    targets = spark.range(60).select(F.col("id").cast("int").alias("cell"), (F.col("id") % 9).cast("double").alias("tx"), (F.col("id") % 4).cast("double").alias("ty"))
    whole = {r.cell: round(r.value, 9) for r in spatial.interpolated(points, targets, k=3).collect()}
    monkeypatch.setattr(spatial, "PAIRS", 9 * 3 * 60 // 17)
    out = spatial.interpolated(points, targets, k=3)
    assert "hashpartitioning(cell" in plan_of(out) and {r.cell: round(r.value, 9) for r in out.collect()} == whole and len(whole) == 60


def test_models_read_their_rows_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        runs.add(1)
        yield from batches

    df = spark.range(200).select((F.col("id") % 20).cast("int").alias("cell"), F.expr("date_add(date'2024-01-01', cast(id div 20 as int))").alias("day"), (F.col("id") % 3 == 0).cast("int").alias("is_fire"), (F.col("id") % 11).cast("double").alias("x"), F.col("id").cast("string").alias("id")).coalesce(1)
    df = df.mapInArrow(seen, df.schema)
    fit = lambda train, names: (train.count(), lambda d: d.withColumn("p", F.col(names[0]) / 11))[1]
    found = model.by_definition(df, {"any": F.col("is_fire")}, lambda d: d.withColumnRenamed("is_fire", "y"), ["x"], fit)
    assert runs.value == 1 and found[0]["n_pos"] + found[0]["n_neg"] == 40
    assert set(model.forecast_gain(df.withColumnRenamed("is_fire", "y"), ["x"], ["x"], fit)) == {"without", "instead", "with"} and runs.value == 2


class Held:
    """A value or list of state."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update


class Handle:
    def getValueState(self, name, schema):  # noqa: N802
        return Held()

    getListState = getValueState


def test_a_cell_has_one_value_of_all_days_of_the_year():
    rng = np.random.default_rng(5)
    days = [date(2019, 12, 1) + timedelta(k) for k in range(1600)]
    rain = np.where(rng.random(1600) < 0.1, np.nan, rng.uniform(0, 1, 1600))
    table = pd.DataFrame({"cell": 1, "day": days, "rain": 24 * rain, "tmax": 20.0, "annual": 500.0, "rain_mean": rain, "is_fire": (rng.random(1600) < 0.02).astype(int), "NDVI": np.where(rng.random(1600) < 0.05, np.nan, rng.uniform(0, 1, 1600)), "LAI": rng.uniform(1, 2, 1600)})
    cell = jobs.CellFeatures()
    cell.init(Handle())
    got = pd.concat([f for part in (table[:700], table[700:]) for f in cell.handleInputRows((1,), iter([part]), None)]).reset_index(drop=True)
    for k in range(1600):
        for n in (7, 365):
            window = rain[max(0, k - n + 1) : k + 1]
            assert pd.isna(got[f"precip_sum_{n}d"][k]) if np.isnan(window).all() else abs(got[f"precip_sum_{n}d"][k] - np.nansum(window)) < 1e-9
        doy = days[k].timetuple().tm_yday
        for name, x in (("ndvi_anomaly", "NDVI"), ("spi_90d", None)):
            values = table[x].to_numpy() if x else got["precip_sum_90d"].astype(float).to_numpy()
            before = [values[j] for j in range(k) if days[j].timetuple().tm_yday == doy and not np.isnan(values[j])]
            if len(before) < 2 or np.isnan(values[k]):
                assert pd.isna(got[name][k])
            else:
                z = (values[k] - np.mean(before)) / (np.std(before) + 1e-6)
                assert abs(got[name][k] - min(max(z, -10), 10)) < 1e-6


def test_halves_are_written_by_all_tasks(spark, monkeypatch):
    at = []
    make = upkeep._work
    monkeypatch.setattr(upkeep, "_work", lambda s, name: at.append(make(s, name)) or at[-1])
    rows = spark.range(400).select("id", F.expr("date_add(date'2024-01-01', cast(id % 10 as int))").alias("day")).repartition(4, "id")
    got = upkeep._in_halves(spark, rows, F.lit("2024-01-04").cast("date"), lambda days: days.select("id"), "ids")
    assert sorted(r.id for r in got.collect()) == list(range(400))
    assert all(len(spark.read.parquet(f"{at[0]}/{k}").inputFiles()) == 4 for k in (0, 1))


def test_rows_of_cells_and_days_are_merged(spark):
    cube = spark.range(60).select((F.col("id") % 3).cast("int").alias("cell"), F.expr("date_add(date'2024-01-01', cast(id div 3 as int))").alias("day"), F.lit(0.1).alias("total_precipitation_mean"), F.lit(20.0).alias("t2m_max"))
    out = features.droughts(cube, features.annual_rain(cube))
    assert "SortMergeJoin" in plan_of(out) and out.count() == 60


def test_a_history_is_dealt_out_once(spark, small, monkeypatch):
    monkeypatch.setattr(calendar, "ROWS", 1000)
    annual = spark.range(40).select(F.col("id").cast("int").alias("cell"), F.lit(500.0).alias("annual"))
    plan = plan_of(features.history(upkeep._years(spark, small), annual))
    assert plan.count("hashpartitioning(cell") == 2 and not re.search(r"hashpartitioning\((cell#\d+, day|part)", plan)  # the cube and the yearly rain


def test_an_index_walked_with_its_rows_is_that_of_groups(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(c, date(2024, 1, 1) + timedelta(k), None if rng.random() < 0.2 else float(rng.choice([0.0, 3.0, 40.0])), None if rng.random() < 0.1 else float(rng.normal(20, 8)), 400.0 + c, [None, 90.0][c % 2], 4.0) for c in (*range(9), 300) for k in range(1 + 7 * c % 40)]
    df = spark.createDataFrame(rows, "cell int, day date, rain double, tmax double, annual double, q0 double, wet0 double")
    kept = lambda d: sorted((r.cell, r.day, r.q, r.wet) for r in d.collect())
    x = [F.col(c) for c in df.columns[2:]]
    assert str(kept(recursive.walked(df.repartition(5), *x))) == str(kept(recursive.drought(df, q0="q0", wet0="wet0")))
    late = F.col("day") > F.lit("2024-01-10").cast("date")
    assert str(kept(recursive.walked(df, *x).where(late))) == str(kept(recursive.drought(df, q0="q0", wet0="wet0").where(late)))  # days before are walked too
    table = df.orderBy("cell", "day").toPandas()
    number = table.groupby("cell").cumcount().to_numpy() + 1
    sent = [pa.array(number), *(pa.array(table[c], from_pandas=True) for c in table.columns[2:])]
    one = pa.concat_arrays(list(recursive._walk(iter([tuple(sent)]))))
    monkeypatch.setattr(recursive, "ROWS", 6)
    parts = list(recursive._walk(iter([tuple(a.slice(k, 4) for a in sent) for k in range(0, len(table), 4)])))
    assert len(parts) > 3 and pa.concat_arrays(parts).equals(one)
    with pytest.raises(ValueError, match="not in order"):
        list(recursive._walk(iter([tuple(a.take(pa.array([1, 3])) for a in sent)])))


def test_narrow_rows_have_the_same_nearest_events(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(d, c, int(rng.random() < (0, 0.02, 0.3)[d]), 1.0, None if rng.random() < 0.1 else 2.0) for d in range(3) for c in range(7 * 30) if rng.random() < 0.9]
    df = spark.createDataFrame(rows, "day int, cell int, is_fire int, wind_u double, wind_v double")
    grid = Grid(0.0, 0.0, 2000.0, -2000.0, 7, 30)
    at_once = sorted(map(str, spatial.nearest_events(df, grid).collect()))
    monkeypatch.setattr(spatial, "NARROW", 0)
    assert sorted(map(str, spatial.nearest_events(df, grid).collect())) == at_once and len(at_once) == len(rows)


def test_cells_of_a_group_are_taken_at_once():
    rng = np.random.default_rng(6)
    n = 900
    of = lambda c, k: pd.DataFrame({"cell": c, "day": [date(2020, 1, 1) + timedelta(j) for j in range(k)], "rain_mean": np.where(rng.random(k) < 0.2, np.nan, rng.uniform(0, 1, k)), "tmax": np.where(rng.random(k) < 0.1, np.nan, 20.0), "annual": 500.0, "is_fire": np.where(rng.random(k) < 0.5, np.nan, rng.random(k) < 0.02), "NDVI": rng.uniform(0, 1, k), "LAI": rng.uniform(1, 2, k)}).assign(rain=lambda d: 24 * d.rain_mean)
    cells = [of(c, k) for c, k in ((4, n), (9, 700), (200, 30))]

    def run(parts, start=None):
        made = jobs.CellFeatures()
        made.init(Handle())
        if start is not None:
            made.handleInitialState((0,), start, None)
        return pd.concat([f for p in parts for f in made.handleInputRows((0,), iter(p), None)]).sort_values(["cell", "day"]).reset_index(drop=True)

    alone = pd.concat([run([[c]]) for c in cells]).reset_index(drop=True)
    both = pd.concat(cells).sample(frac=1, random_state=1)
    early = both["day"] < date(2021, 6, 1)  # later days are of two cells, which the first batch has too
    assert set(both[early]["cell"]) == {4, 9, 200} and set(both[~early]["cell"]) == {4, 9}
    got = run([[both[early][:400], both[early][400:]], [both[~early]]])
    pd.testing.assert_frame_equal(got, alone)
    assert alone.notna().any().all() and len(alone) == n + 730
    # From a state whose days before are known by their sums.
    start = pd.DataFrame([{"cell": 9, "q0": np.nan, "wet0": 3.0, "since0": 5, "held": 2, "numbers": np.array([np.nan, 2.0, 0.0, 1.0, 1.0, *[2.0, 0.5, 0.02] * 3])}, {"cell": 4, "q0": 7.0, "wet0": 0.0, "since0": 11, "held": 0, "numbers": np.zeros(0)}])
    late = run([[pd.concat([c[:3] for c in cells])]], start)
    first = late.groupby("cell").first()
    rain = cells[1]["rain_mean"][0]
    assert abs(first.precip_sum_7d[9] - (2.0 + (0 if np.isnan(rain) else rain))) < 1e-12
    assert abs(first.ndvi_anomaly[9] - (cells[1]["NDVI"][0] - 0.5) / (0.1 + 1e-6)) < 1e-9
    assert first.time_since_last_fire.tolist() == [12 if cells[0]["is_fire"][0] != 1 else 0, 6 if cells[1]["is_fire"][0] != 1 else 0, 1 if cells[2]["is_fire"][0] != 1 else 0]
