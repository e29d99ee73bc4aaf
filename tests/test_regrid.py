"""Scattered sources against brute force, and the small tools around runs and feeds."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.grid import Grid
from gridweave.operators import regrid, sampling, spatial
from gridweave.plans import maintain
from gridweave.sources import readers, sinks


def empty_circles(x, y, t):
    """Whether no point lies well inside a triangle's circle."""
    for a, b, c in t:
        m = np.array([[x[b] - x[a], y[b] - y[a]], [x[c] - x[a], y[c] - y[a]]]) * 2
        centre = np.linalg.solve(m, [(x[b] ** 2 - x[a] ** 2) + (y[b] ** 2 - y[a] ** 2), (x[c] ** 2 - x[a] ** 2) + (y[c] ** 2 - y[a] ** 2)])
        if (np.hypot(x - centre[0], y - centre[1]) < np.hypot(x[a] - centre[0], y[a] - centre[1]) - 1e-6).any():
            return False
    return True


@pytest.mark.parametrize("kind", ["scattered", "mesh"])
def test_triangles_are_delaunay_and_cover_the_hull(kind):
    rng = np.random.default_rng(3)
    if kind == "mesh":
        x, y = [a.ravel().astype(float) for a in np.meshgrid(np.arange(9), np.arange(7))]
        area = 8 * 6
    else:
        x, y = np.concatenate([[0, 50, 50, 0], rng.uniform(0, 50, 120)]), np.concatenate([[0, 0, 30, 30], rng.uniform(0, 30, 120)])
        area = 50 * 30
    t = regrid.triangulated(x, y)
    size = np.abs((x[t[:, 1]] - x[t[:, 0]]) * (y[t[:, 2]] - y[t[:, 0]]) - (x[t[:, 2]] - x[t[:, 0]]) * (y[t[:, 1]] - y[t[:, 0]])) / 2
    assert size.sum() == pytest.approx(area)
    assert empty_circles(x, y, t)


def test_triangles_of_too_few_or_collinear_points():
    none = regrid.triangulated(np.array([]), np.array([]))
    assert none.shape == (0, 3)
    line = np.arange(5.0)
    assert len(regrid.triangulated(line, 2 * line)) == 0


def test_a_plane_comes_out_exact_and_missing_points_change_the_grid(spark):
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 10, 60), rng.uniform(0, 10, 60)
    rows = [(d, i, float(x[i]), float(y[i]), None if d == 1 and i % 3 == 0 else 2 * float(x[i]) - float(y[i]) + d) for d in range(3) for i in range(60)]
    field = spark.createDataFrame(rows, "day int, src_id int, px double, py double, value double")
    tx, ty = rng.uniform(-2, 12, 200), rng.uniform(-2, 12, 200)
    targets = spark.createDataFrame([(i, float(tx[i]), float(ty[i])) for i in range(200)] + [(200, None, 1.0)], "cell int, px double, py double")
    assert regrid.signed(field).select("sig").distinct().count() == 2
    found = {(r.day, r.cell): r.value for r in regrid.regridded_scattered(field, targets).collect()}
    assert len(found) == 600
    for d in range(3):
        there = np.array([i for i in range(60) if not (d == 1 and i % 3 == 0)])
        for c in range(200):
            plane, near = 2 * tx[c] - ty[c] + d, there[np.hypot(x[there] - tx[c], y[there] - ty[c]).argmin()]
            assert min(abs(found[d, c] - plane), abs(found[d, c] - (2 * x[near] - y[near] + d))) < 1e-6
        assert sum(abs(found[d, c] - (2 * tx[c] - ty[c] + d)) < 1e-6 for c in range(200)) > 60


def test_few_points_take_the_nearest(spark):
    field = spark.createDataFrame([(0, 1, 0.0, 0.0, 5.0), (0, 2, 1.0, 0.0, 7.0), (1, 1, 0.0, 0.0, None)], "day int, src_id int, px double, py double, value double")
    targets = spark.createDataFrame([(0, 0.2, 3.0), (1, 0.9, -1.0)], "cell int, px double, py double")
    assert {(r.day, r.cell, r.value) for r in regrid.regridded_scattered(field, targets).collect()} == {(0, 0, 5.0), (0, 1, 7.0)}


@pytest.mark.parametrize("size", [3, 5])
def test_neighbourhoods_equal_a_loop_on_a_grid_with_holes(spark, size):
    grid, rng = Grid(0.0, 0.0, 1.0, -1.0, 7, 5), np.random.default_rng(size)
    cells = [c for c in range(35) if c not in (0, 6, 17)]
    value = {c: None if c % 9 == 4 else float(rng.uniform(0, 100)) for c in cells}
    df = spark.createDataFrame([(k, c, None if value[c] is None else value[c] + k) for k in range(2) for c in cells], "k int, cell int, e double")
    found = {(r.k, r.cell): r.mean for r in spatial.neighbourhood_mean(df, grid, "e", size, ("k",)).collect()}
    assert len(found) == 2 * len(cells)
    reach = size // 2
    for c in cells:
        near = [value.get(min(max(c // 7 + a, 0), 4) * 7 + min(max(c % 7 + b, 0), 6)) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)]
        near = [v for v in near if v is not None]
        for k in range(2):
            assert found[k, c] == pytest.approx(np.mean(near) + k if near else 0.0)


def test_drawn_days_follow_their_weights(spark):
    rows = [(date(2000, 1, 1) + timedelta(d), c, int(d == 3 and c == 1)) for d in range(10) for c in range(2)]
    df = spark.createDataFrame(rows, "day date, cell int, e int")
    n = {r.day.day: r["count"] for r in sampling.drawn_days(df, "e", 1900).groupBy("day").count().collect()}
    assert sum(n.values()) == 1900 and n[4] == pytest.approx(1000, rel=0.1)


def test_a_mask_on_its_grid_has_no_fault(spark):
    grid = Grid(10.0, 20.0, 2.0, -2.0, 4, 3)
    mask = grid.cells(spark).select("cell", "x_m", "y_m")
    assert regrid.misaligned(mask, grid).count() == 0
    bad = mask.where("cell <> 2").unionByName(mask.where("cell = 5")).withColumn("x_m", F.when(F.col("cell") == 7, None).otherwise(F.col("x_m")))
    assert {(r.cell, r.fault) for r in regrid.misaligned(bad, grid).collect()} == {(2, "missing"), (5, "repeated"), (7, "moved")}


def test_a_refused_request_fails_and_bad_lines_are_told(spark, tmp_path):
    (tmp_path / "said.csv").write_text("Invalid MAP_KEY.\n")
    with pytest.raises(ValueError, match="Invalid MAP_KEY"):
        readers.detections(spark, str(tmp_path / "said.csv"))
    (tmp_path / "d.csv").write_text("latitude,longitude,acq_date,confidence\n1.5,2.5,2024-01-01,n\nx,2.5,2024-01-01,n\n")
    assert readers.detections(spark, str(tmp_path / "d.csv")).collect()[0].latitude == 1.5
    assert [r.line for r in readers.refused(spark, str(tmp_path / "d.csv")).collect()] == ["x,2.5,2024-01-01,n"]


def test_one_run_holds_the_lock_and_a_stale_one_is_taken_over(spark, tmp_path):
    first, second = (maintain.RunLock(spark, str(tmp_path / "lock")) for _ in range(2))
    assert first.age() is None and first.claim() and not second.claim()
    first.beat()
    assert not second.claim()
    second.stale = -1.0
    assert second.claim()
    second.release()
    assert first.age() is None


def test_a_manifest_is_read_again_only_when_its_version_changes(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert sinks.manifest_if_newer(spark, path, None) is None
    sinks.publish(spark, path, {"version": "a"})
    assert sinks.manifest_if_newer(spark, path, None) == {"version": "a"}
    assert sinks.manifest_if_newer(spark, path, "a") is None
