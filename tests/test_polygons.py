"""Polygons by scan lines, projected corners and the display's index map."""

import math
import random

import pytest

from gridweave.grid import KILOMETRE, Grid
from gridweave.operators import spatial


def inside(rings, x, y):
    """Even-odd over all rings."""
    hits = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            hits += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return hits % 2 == 1


@pytest.mark.parametrize("grid", [Grid(0, 0, 1, 1, 14, 12), Grid(13, 11, -1, -1, 14, 12), Grid(0, 11, 1, -1, 14, 12)])
def test_random_polygons_with_holes_and_parts(spark, grid):
    rng = random.Random(4)
    shape = lambda n, x, y, r: [(x + rng.uniform(0.2, 1) * r * math.cos(2 * math.pi * k / n) + 1e-3, y + rng.uniform(0.2, 1) * r * math.sin(2 * math.pi * k / n) + 1e-3) for k in range(n)]
    polygons = []
    for i in range(25):
        x, y = rng.uniform(-1, 14), rng.uniform(-1, 12)
        parts = [[shape(rng.randint(3, 9), x, y, 6), shape(5, x, y, 2)], [shape(4, x + 3, y, 2)]][: rng.randint(1, 2)]
        if i % 4 == 0:
            parts[0][0] += parts[0][0][:1]  # closed
        polygons.append((i, parts))
    polygons += [(90, []), (91, [[]]), (92, [[[(1.0, 1.0), (2.0, 2.0)]]]), (93, None)]
    df = spark.createDataFrame(polygons, "id int, parts array<array<array<struct<x:double,y:double>>>>")
    got = {(r.id, r.cell) for r in spatial.scanned_cells(df, grid).collect()}
    want = {(i, j * 14 + k) for i, parts in polygons[:25] for j in range(12) for k in range(14) if any(inside(rings, grid.x0 + grid.dx * k, grid.y0 + grid.dy * j) for rings in parts)}
    assert got == want and len(want) > 100


def test_projected_corners_and_display(spark):
    ring = [(-4.0, 40.0), (-3.9, 40.0), (-3.9, 40.1), (-4.0, 40.1)]
    df = spark.createDataFrame([(1, [[ring]])], "id int, parts array<array<array<struct<x:double,y:double>>>>")
    cells = [r.cell for r in spatial.scanned_cells(df.withColumn("parts", spatial.projected("parts")), KILOMETRE).collect()]
    assert 80 < len(cells) < 110  # 8.5 by 11.1 kilometres
    shown = {r.pixel: r.cell for r in spatial.display_index(spark, KILOMETRE, 8, 6, -4.0, 40.0, -3.9, 40.1).collect()}
    assert len(shown) == 48 and set(shown.values()) <= set(cells) and len(set(shown.values())) > 30
    assert {r.cell for r in spatial.display_index(spark, KILOMETRE, 2, 2, 60.0, 10.0, 61.0, 11.0).collect()} == {-1}
