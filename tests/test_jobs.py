"""Jobs from end to end on a small cube, and the assembly of its days."""

import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave import cli
from gridweave.grid import Grid
from gridweave.plans import features
from gridweave.schema import FEATURES
from gridweave.sources import sinks

GRID = "0,0,2000,-2000,4,4"
DAY = date(2020, 1, 1)


def raw(spark, days=40):
    rng = np.random.default_rng(0)
    rows = [(DAY + timedelta(d), c, int(rng.random() < 0.1 + 0.03 * c % 0.3), *map(float, rng.uniform(0, 1, 8))) for d in range(days) for c in range(16)]
    names = ["total_precipitation_mean", "t2m_max", "RH_min", "wind_speed_max", "wind_u_mean", "wind_v_mean", "NDVI", "LAI"]
    df = spark.createDataFrame(rows, "day date, cell int, is_fire int, " + ", ".join(f"{n} double" for n in names))
    return df.withColumns({"t2m_max": F.col("t2m_max") * 30, "RH_min": F.col("RH_min") * 100})


def test_jobs(spark, tmp_path, capsys):
    silver, gold, store, card = (str(tmp_path / n) for n in ("silver", "gold", "store", "model"))
    run = lambda *a: cli.main([str(x) for x in a], spark)
    sinks.replace_days(raw(spark).where("day < date'2020-02-01'"), silver)
    run("build", silver, gold, "--grid", GRID)
    with pytest.raises(SystemExit):
        run("build", silver, gold, "--grid", GRID)
    bronze = str(tmp_path / "bronze")
    sinks.replace_days(raw(spark), bronze)
    run("append", bronze, silver)
    run("edge", silver, gold, "--grid", GRID, "--dry-run")
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"last": "2020-01-31", "new": 9}
    run("edge", silver, gold, "--grid", GRID)
    assert spark.read.parquet(gold).select("day").distinct().count() == 40
    run("update", gold, "--today", "2020-02-12")
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["current"] is True
    run("train", gold, card, "--trees", 2, "--depth", 2)
    assert set(json.loads(capsys.readouterr().out.splitlines()[-1])) >= {"roc", "overall_ap", "prec_at_k"}
    run("serve", gold, card, store, "--date", "2020-02-09", "--threshold", 0.1)
    assert spark.read.parquet(f"{store}/grids").count() == 16
    assert sinks.manifest(spark, f"{store}/manifest")["issue"] == "2020-02-09"
    run("serve", gold, card, store, "--show")
    run("coarsen", silver, str(tmp_path / "coarse"), "--factor", 2, "--grid", GRID)
    assert spark.read.parquet(str(tmp_path / "coarse")).count() == 160
    run("rechunk", silver, str(tmp_path / "wide"), "--files", 2)


def test_assembly_and_matrix(spark):
    days = spark.createDataFrame([(DAY + timedelta(d), 0) for d in range(3)], "day date, cell int")
    weather = days.limit(2).withColumn("t2m_max", F.lit(20.0))
    fires = days.limit(1).withColumn("is_fire", F.lit(1))
    editions = spark.createDataFrame([(0, DAY, 1.0), (0, DAY + timedelta(2), 3.0)], "cell int, edition date, v double")
    out = features.assembled(days, weather, fires, editions.withColumnRenamed("v", "NDVI"), editions.withColumnRenamed("v", "popdens"), ["NDVI"], ["popdens"]).orderBy("day").collect()
    assert [r.is_fire for r in out] == [1, 0, 0] and [r.NDVI for r in out] == [1, 2, 3] and out[2].t2m_max is None
    with pytest.raises(ValueError, match="CLC_2018_1"):
        features.matrix(weather, FEATURES)
    live = features.live_over(weather.withColumn("NDVI", F.lit(0.1)), spark.createDataFrame([(0, 31.0, None)], "cell int, t2m_max double, NDVI double"), ["t2m_max", "NDVI"]).first()
    assert (live.t2m_max, live.NDVI, live.refreshed) == (31.0, 0.1, ["t2m_max"])


def test_another_label(spark):
    cube = raw(spark, 10)
    labels = cube.where("cell = 3 and day = date'2020-01-05'").select("day", "cell")
    out = features.relabelled(features.fire_context(cube, Grid(0, 0, 2000, -2000, 4, 4)), labels, Grid(0, 0, 2000, -2000, 4, 4))
    assert out.where("is_fire = 1").count() == 1 and out.where("day = date'2020-01-05' and cell = 3").first().dist_to_fire == 0
