"""Fields on scattered source points, and rasters on another grid, brought to the cells of a grid."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..grid import Grid

#: Cells whose weights meet a field's values in one row group of the join.
BLOCK = 4096


def triangulated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(m, 3) corners of the Delaunay triangles of distinct places, each in ascending order.

    Starts from an edge that is surely one (a point and its nearest) and gives
    every edge the point beyond it that sees it under the widest angle.  Places
    are moved by 1e-10 of their extent first, so that no four lie on one circle
    (regular meshes); triangles without an area by the true places are left out.
    """
    n = len(x)
    extent = max(np.ptp(x), np.ptp(y)) if n else 0.0
    if n < 3 or extent == 0:
        return np.zeros((0, 3), int)
    moved = np.random.default_rng(n).uniform(-1e-10, 1e-10, (n, 2))
    p = np.column_stack([x - x.min(), y - y.min()]) / extent + moved
    far = ((p - p[0]) ** 2).sum(1)
    far[0] = np.inf
    first = (0, int(far.argmin()))
    edges, seen, found = deque([first, first[::-1]]), set(), set()
    while edges:
        a, b = edges.popleft()
        if (a, b) in seen:
            continue
        seen.add((a, b))
        to_a, to_b = p[a] - p, p[b] - p
        area = to_a[:, 0] * to_b[:, 1] - to_a[:, 1] * to_b[:, 0]
        area[[a, b]] = 0.0
        beyond = area > 0
        if beyond.any():
            narrow = np.where(beyond, (to_a * to_b).sum(1) / np.where(beyond, area, 1.0), np.inf)
            c = int(narrow.argmin())
            found.add(tuple(sorted((a, b, c))))
            seen.update([(b, c), (c, a)])
            edges.extend([(c, b), (a, c)])
    t = np.array(sorted(found), int).reshape(-1, 3)
    ax, ay, bx, by = x[t[:, 1]] - x[t[:, 0]], y[t[:, 1]] - y[t[:, 0]], x[t[:, 2]] - x[t[:, 0]], y[t[:, 2]] - y[t[:, 0]]
    return t[np.abs(ax * by - ay * bx) > 1e-9 * extent * extent]


_TRIANGLES = "sig string, step double, x0 double, y0 double, i array<int>, x array<double>, y array<double>"


def _triangles(points: pd.DataFrame) -> pd.DataFrame:
    points = points.sort_values("src_id")
    x, y = points.px.to_numpy(float), points.py.to_numpy(float)
    # Of points of one place the first counts; positions stay those of all points.
    _, kept = np.unique(np.column_stack([x, y]), axis=0, return_index=True)
    kept.sort()
    t = kept[triangulated(x[kept], y[kept])] if len(kept) else np.zeros((0, 3), int)
    step = max((np.ptp(x) * np.ptp(y) / max(len(x), 1)) ** 0.5, max(np.ptp(x), np.ptp(y)) / max(len(x), 1)) or 1.0
    lists = {c: pd.Series(v.tolist(), dtype=object) for c, v in (("i", t), ("x", x[t]), ("y", y[t]))}
    return pd.DataFrame(lists).assign(sig=points.sig.iloc[0], step=step, x0=x.min(), y0=y.min())[["sig", "step", "x0", "y0", "i", "x", "y"]]


def scattered_weights(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(sig, cell, i, w): linear weights of target places (cell, px, py) for every source grid (sig, src_id, px, py).

    ``i`` are positions among the grid's points in order of src_id.  A grid is
    triangulated in one task: it is one model's grid, some thousands of points,
    and does not grow with the days.  Triangles and places meet by squares; a
    place in no triangle takes the nearest point.
    """
    found = sources.groupBy("sig").applyInPandas(_triangles, _TRIANGLES).persist()
    corner = lambda c, k: F.element_at(c, k + 1)
    (xa, xb, xc), (ya, yb, yc) = [[corner(c, k) for k in range(3)] for c in ("x", "y")]
    square = lambda v, o: F.floor((v - F.col(o)) / F.col("step"))
    slack = F.col("step") * 1e-9
    covered = lambda c, o: F.explode(F.sequence(square(F.array_min(c) - slack, o), square(F.array_max(c) + slack, o)))
    triangles = found.withColumn("bx", covered("x", "x0")).withColumn("by", covered("y", "y0"))
    # One row a source grid.
    frames = found.select("sig", "step", "x0", "y0").distinct()
    placed = targets.where("px is not null and py is not null").select("cell", "px", "py").join(F.broadcast(frames))
    placed = placed.withColumns({"bx": square(F.col("px"), "x0"), "by": square(F.col("py"), "y0")}).drop("step", "x0", "y0")
    both = placed.join(triangles, ["sig", "bx", "by"])
    whole = (xb - xa) * (yc - ya) - (xc - xa) * (yb - ya)
    wb = ((F.col("px") - xa) * (yc - ya) - (xc - xa) * (F.col("py") - ya)) / whole
    wc = ((xb - xa) * (F.col("py") - ya) - (F.col("px") - xa) * (yb - ya)) / whole
    w = F.array(1 - wb - wc, wb, wc)
    inside = both.withColumn("w", w).where(F.array_min("w") >= -1e-9).groupBy("sig", "cell").agg(F.min_by(F.struct("i", "w"), "i").alias("e")).select("sig", "cell", "e.i", "e.w")
    return inside.unionByName(_nearest(sources, targets, inside))


def _nearest(sources: DataFrame, targets: DataFrame, inside: DataFrame) -> DataFrame:
    """(sig, cell, i, w) of the places that lie in no triangle; a place looks through one grid's points, as an array."""
    points = F.array_sort(F.collect_list(F.struct("src_id", "px", "py")))
    grids = sources.groupBy("sig").agg(F.transform(points, lambda p, k: F.struct(p.px.alias("x"), p.py.alias("y"), k.alias("k"))).alias("p"))
    placed = targets.where("px is not null and py is not null").select("cell", "px", "py", F.floor(F.col("cell") / BLOCK).alias("block"))
    # One row a source grid and block of cells, so that a grid's cells are not in one task.
    met = placed.select("block").distinct().join(F.broadcast(sources.select("sig").distinct())).join(grids, "sig")
    away = lambda p: (p.x - F.col("px")) * (p.x - F.col("px")) + (p.y - F.col("py")) * (p.y - F.col("py"))
    best = F.array_min(F.transform("p", lambda p: F.struct(away(p).alias("d"), p.k.alias("k"))))
    left = placed.join(met.select("sig", "block"), "block").join(inside.select("sig", "cell"), ["sig", "cell"], "left_anti")
    return left.join(met, ["sig", "block"]).select("sig", "cell", F.array(best.k).alias("i"), F.array(F.lit(1.0)).alias("w"))


def signed(field: DataFrame, value: str = "value", keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """(keys, sig, v): each key's values as an array in order of src_id, and the signature of the points that have one."""
    there = field.where(F.col(value).isNotNull() & F.col("px").isNotNull() & F.col("py").isNotNull())
    points = F.array_sort(F.collect_list(F.struct("src_id", "px", "py", F.col(value).cast("double").alias("v"))))
    listed = there.groupBy(*keys).agg(points.alias("e"))
    place = F.transform("e", lambda e: F.struct(e.src_id, e.px, e.py))
    return listed.select(*keys, F.sha1(F.to_json(place)).alias("sig"), F.transform("e", lambda e: e.v).alias("v"), place.alias("points"))


def regridded_scattered(field: DataFrame, targets: DataFrame, value: str = "value", keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """(keys, cell, value) of a field (keys, src_id, px, py, value) at target places (cell, px, py).

    Linear inside the hull of the points that have a value, else the nearest
    one.  Weights are made once for each set of points, not for each key, and
    applied by block of cells, so that no value is shuffled per cell.  Keys
    without any value give no rows; src_id must be distinct in a key.
    """
    arrays = signed(field, value, keys)
    grids = arrays.groupBy("sig").agg(F.first("points").alias("p"))
    sources = grids.select("sig", F.explode("p").alias("e")).select("sig", "e.src_id", "e.px", "e.py")
    # Kept, since the blocks and the sums both read them; a lost part is made again.
    weights = scattered_weights(sources, targets).withColumn("block", F.floor(F.col("cell") / BLOCK)).persist()
    spread = arrays.select(*keys, "sig", "v").join(weights.select("sig", "block").distinct(), "sig")
    total = F.aggregate(F.arrays_zip("i", "w"), F.lit(0.0), lambda s, e: s + e.w * F.element_at("v", e.i + 1))
    return spread.join(weights, ["sig", "block"]).select(*keys, "cell", total.alias(value))


def mosaicked(tiles: DataFrame, tile: str, value: str = "value", nodata: Column | None = None, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """(keys, value): the first tile's value that is data, tiles in order of ``tile``; missing where none has any."""
    there = F.col(value).isNotNull() if nodata is None else F.col(value).isNotNull() & ~nodata
    return tiles.groupBy(*keys).agg(F.min_by(value, F.when(there, F.col(tile))).alias(value))


def matched(raster: DataFrame, targets: DataFrame, x0: float, y0: float, dx: float, dy: float, value: str = "value") -> DataFrame:
    """(cell, value): the raster's pixel under each target place (cell, x, y in the raster's projection).

    ``x0, y0`` is the outer corner of pixel (0, 0).  Places beyond the raster and
    pixels without data give a missing value, never a neighbour's.
    """
    col, row = F.floor((F.col("x") - x0) / dx), F.floor((F.col("y") - y0) / dy)
    asked = targets.select("cell", row.alias("row"), col.alias("col"))
    return asked.join(raster.select("row", "col", value), ["row", "col"], "left").select("cell", value)


def misaligned(mask: DataFrame, grid: Grid, tolerance: float = 1e-6) -> DataFrame:
    """(cell, fault) where a mask (cell, x_m, y_m) is not the grid's: outside, repeated, moved or missing; no rows if it is."""
    apart = lambda c, own: F.coalesce(F.abs(F.col(c) - own(F.col("cell"))), F.lit(float("inf")))
    given = mask.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.greatest(apart("x_m", grid.easting), apart("y_m", grid.northing))).alias("off"))
    own = grid.cells(mask.sparkSession).select("cell", F.lit(True).alias("own"))
    fault = F.when(F.col("own").isNull(), "outside").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(F.col("off") > tolerance, "moved")
    return own.join(given, "cell", "full").select("cell", fault.alias("fault")).where("fault is not null")
