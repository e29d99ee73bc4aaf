"""Watersheds and connected pieces against plain loops, on grids of one tile and of many."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.grid import Grid
from gridweave.operators import watershed

DAY = date(2024, 1, 1)


def plain_spanning(cells, nx):
    """{cell: (level, label, kind)} -> {cell: (part's least cell, label)}: edges in order, parts of two marks stay apart."""
    edges = []
    for c, (level, _, kind) in cells.items():
        for way, other in enumerate((c + 1 if c % nx < nx - 1 else -1, c + nx)):
            if other in cells and cells[other][2] == kind:
                edges.append((abs(level - cells[other][0]), c * 2 + way, c, other))
    part = {c: c for c in cells}
    mark = {c: label for c, (_, label, _) in cells.items()}

    def root(c):
        while part[c] != c:
            c = part[c]
        return c

    for _, _, a, b in sorted(edges):
        a, b = root(a), root(b)
        if a != b and (mark[a] is None or mark[b] is None):
            keep, gone = min(a, b), max(a, b)
            mark[keep] = mark[keep] if mark[keep] is not None else mark[gone]
            part[gone] = keep
    return {c: (root(c), mark[root(c)]) for c in cells}


@pytest.mark.parametrize("tile", [3, 256])
def test_spanning_forest_equals_edges_in_order(spark, monkeypatch, tile):
    monkeypatch.setattr(watershed, "TILE", tile)
    rng, grid, days = np.random.default_rng(tile), Grid(0, 0, 1, -1, 11, 8), {}
    for day in range(6):
        cells = {}
        for c in range(88):
            if rng.random() < (1, 1, 0.8)[day % 3]:
                label = int(rng.integers(0, 5)) * 7 if rng.random() < (0.1, 0.02, 0)[day // 2] else None
                cells[c] = (int(rng.integers(0, (5, 100)[day % 2])), label, int(rng.random() < (0, 0.3)[day % 2]))
        days[day if day else None] = cells
    df = spark.createDataFrame([(d, c, *v) for d, cells in days.items() for c, v in cells.items()], "day int, cell int, level int, label long, kind long")
    got = {(r.day, r.cell): (r.piece, r.label) for r in watershed.spanning(df, grid).collect()}
    assert len(got) == df.count()
    for day, cells in days.items():
        for c, (piece, label) in plain_spanning(cells, 11).items():
            assert got[day, c][1] == label and (label is not None or got[day, c][0] == piece), (day, c)
    assert watershed.spanning(df.limit(0), grid).count() == 0


def plain_pieces(p, threshold, sigma, apart):
    """The same areas with whole rasters and loops."""
    ny, nx = p.shape
    r = max(1, int(4 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    s = p.copy()
    for axis in (1, 0):
        padded = np.pad(s, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        s = sum(k * np.take(padded, range(i, i + p.shape[axis]), axis) for i, k in enumerate(kernel))
    before, after = apart // 2, apart - 1 - apart // 2
    top = np.array([[s[max(0, y - before) : y + after + 1, max(0, x - before) : x + after + 1].max() <= s[y, x] for x in range(nx)] for y in range(ny)])
    mask = p > threshold

    def pieces(cells):
        return plain_spanning({c: (0, None, k) for c, k in cells.items()}, nx)

    tops = pieces({int(c): 0 for c in np.flatnonzero(top & mask)})
    level = np.floor(255 * (1 - np.clip(s / max(s.max(), 1e-9), 0, 1))).astype(int)
    basin = plain_spanning({c: (int(level.flat[c]), tops[c][0] if c in tops else None, 0) for c in range(p.size)}, nx)
    found = pieces({int(c): -1 if basin[c][1] is None else basin[c][1] for c in np.flatnonzero(mask)})
    return {c: piece for c, (piece, _) in found.items()}


@pytest.mark.parametrize("tile", [5, 256])
def test_areas_equal_whole_rasters(spark, monkeypatch, tile):
    monkeypatch.setattr(watershed, "TILE", tile)
    rng, grid = np.random.default_rng(8), Grid(0, 0, 2000, -2000, 17, 13)
    fields = {}
    for day in (1, 2):
        p = np.zeros((13, 17))
        for _ in range(6 * day):
            p[rng.integers(0, 13), rng.integers(0, 17)] += rng.uniform(0.1, 0.5)
        p = (p + np.roll(p, 1, 0) + np.roll(p, 1, 1) + np.roll(p, -1, 1)) / 4
        fields[day] = p
    df = spark.createDataFrame([(d, c, float(v), 1) for d, p in fields.items() for c, v in enumerate(p.ravel()) if v > 0], "day int, cell int, p double, regime int")
    got = {(r.day, r.cell): r.piece for r in watershed.risk_pieces(df, grid, threshold=0.02, smooth_km=2.4, apart_km=8.0).collect()}
    want = {(d, c): piece for d, p in fields.items() for c, piece in plain_pieces(p, 0.02, 1.2, 4).items()}
    assert got == want and len(set(want.values())) > 4


def test_valleys_part_neighbouring_hotspots(spark):
    """Two hotspots of one elevated region are two areas; causes come from the drivers of their regime."""
    grid = Grid(0, 0, 2000, -2000, 40, 9)
    x = np.arange(40)
    ridge = 0.03 + 0.3 * np.exp(-((x - 8) ** 2) / 8) + 0.2 * np.exp(-((x - 30) ** 2) / 8)
    rows = [(DAY, y * 40 + int(i), float(ridge[i]) * (abs(y - 4) < 2), 2 if i > 20 else 1, 1) for y in range(9) for i in x]
    df = spark.createDataFrame(rows, "day date, cell int, p double, regime int, region int")
    drivers = spark.createDataFrame([(1, ["dist_to_fire", "kbdi"]), (2, ["dist_to_fire", "t2m_max", "kbdi"])], "regime int, features array<string>")
    got = watershed.danger_areas(df, grid, drivers=drivers, least=0.0).collect()
    said = {r.peak_cell % 40: (r.regime, list(r.causes)) for r in got}
    # What lies behind a steep flank may be a piece of its own, with a peak of its own.
    assert said[8] == (1, ["very dry ground"]) and said[30] == (2, ["near active fire", "very dry ground"])
    assert sum(r.n_cells for r in got) == 3 * 40 and sorted(r.area for r in got) == list(range(1, len(got) + 1))
    assert watershed.danger_areas(df.where("p < 0"), grid).count() == 0
    bare = df.withColumn("p", F.when(F.col("cell") % 3 > 0, F.col("p")))
    assert watershed.danger_areas(bare, grid).count() > 0
