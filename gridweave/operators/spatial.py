"""Operators over the cells of a grid."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.projection import equal_area
from ..grid import Grid


def pooling(name: str) -> str:
    """How a variable is pooled, by its name: events and maxima by maximum, minima by minimum, else by mean."""
    return "max" if name == "is_fire" or name.endswith("_max") else "min" if name.endswith("_min") else "avg"


def block_pool(df: DataFrame, grid: Grid, factor: int, variables: list[str], keys: tuple[str, ...] = ("day",), codes: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of cells with each variable pooled by its name; codes by their mode, the smallest of tied ones."""
    found = [getattr(F, pooling(v))(v).alias(v) for v in variables] + [F.mode(c, True).alias(c) for c in codes]
    return df.withColumn("cell", grid.block(F.col("cell"), factor)).groupBy(*keys, "cell").agg(*found)


def refine(df: DataFrame, coarse: Grid, factor: int) -> DataFrame:
    """Every row of a coarse cell once for each of its fine cells; no join."""
    y, x = coarse.row(F.col("cell")), coarse.column(F.col("cell"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(factor * factor - 1))).alias("_k")
    fine = ((y * factor + F.floor(F.col("_k") / factor)) * (coarse.nx * factor) + x * factor + F.pmod(F.col("_k"), F.lit(factor))).cast("int")
    return df.select("*", parts).withColumn("cell", fine).drop("_k")


def rasterized(points: DataFrame, grid: Grid, lon: str = "longitude", lat: str = "latitude", day: str = "day") -> DataFrame:
    """(day, cell, is_fire): cells with a detection; places outside the grid are left out."""
    return points.select(F.col(day).alias("day"), grid.located(F.col(lon), F.col(lat)).alias("cell")).where("cell is not null").distinct().withColumn("is_fire", F.lit(1))


def _changes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """Where a row differs from the one before in any column; missing values are equal to each other."""
    n = len(columns[0])
    out = np.ones(n, bool)
    if n > 1:
        out[1:] = False
        for c in columns:
            a, b = c.slice(1), c.slice(0, n - 1)
            same = pc.if_else(pc.is_null(a), pc.is_null(b), pc.fill_null(pc.equal(a, b), False))
            out[1:] |= ~same.to_numpy(zero_copy_only=False)
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of sorted rows as tables of some batches' size: the last group of a batch waits for the next one."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        table = pa.Table.from_batches(kept)
        last = int(np.flatnonzero(_changes([table.column(k) for k in keys]))[-1]) if len(table) else 0
        if last:
            yield table.slice(0, last)
            kept = table.slice(last).combine_chunks().to_batches()
    if kept and (table := pa.Table.from_batches(kept)).num_rows:
        yield table


def _served(x: list[int], height: list[int], place: list[int], nx: int) -> tuple[list[int], list[int]]:
    """Which site serves each place of a row: (sites, first place of each), for sites from left to right at squared heights.

    The lower envelope of their parabolas, in whole numbers; of equal distances
    the site of the least ``place`` serves.
    """
    found: list[int] = []
    first: list[int] = []
    for k in range(len(x)):
        start = 0
        while found:
            j = found[-1]
            ahead, twice = x[k] * x[k] + height[k] - x[j] * x[j] - height[j], 2 * (x[k] - x[j])
            start = -(-ahead // twice)
            start += start * twice == ahead and place[k] > place[j]
            if start > first[-1]:
                break
            found.pop()
            first.pop()
        if not found:
            start = 0
        if start < nx:
            found.append(k)
            first.append(start)
    return found, first


#: Columns of a grid up to which each cell of a row is compared with all of the row's sites, row by row of a batch at once.
NARROW = 64


def _compared(x: np.ndarray, row: np.ndarray, kind: np.ndarray, height: np.ndarray, place: np.ndarray, nx: int) -> np.ndarray:
    """Which site's place is nearest to each row's place ``x``, of equal distances the least; -1 without a site.

    ``row`` numbers the rows of the grid from 0; sites (kind 0), at most one a
    column, are in ``height``, squared distances along columns.
    """
    n, site = int(row[-1]) + 1, kind == 0
    far = np.iinfo(np.int64).max // 4
    high, own = np.full((nx, n), far), np.full((nx, n), -1)
    high[x[site], row[site]], own[x[site], row[site]] = height[site], place[site]
    found, least = np.full(len(x), -1), np.full(len(x), far)
    for k in range(nx):
        there, other = high[k][row] + (x - k) ** 2, own[k][row]
        better = (other >= 0) & ((there < least) | ((there == least) & (other < found)))
        found, least = np.where(better, other, found), np.where(better, there, least)
    return found


def nearest_events(df: DataFrame, grid: Grid, event: str = "is_fire", u: str = "wind_u", v: str = "wind_v", keys: tuple[str, ...] = ("day",), none_km: float | None = None) -> DataFrame:
    """(keys, cell, dist_km, exposure, nearest): exact distance to the nearest event cell, of ties the smallest cell.

    Exposure is the wind's component along the way from the event over the
    squared distance: 0 on an event, missing without wind.  Without any event
    the distance is the grid's diagonal (or ``none_km``) and the exposure 0.

    Along columns first: an event serves the rows that are nearer to it than to the
    next event of its column, by a window over events.  Then along rows: the
    sites that serve a row, at most one a column, and the row's cells meet in a
    group, where the lower envelope of the sites' parabolas tells each cell's
    nearest.  So no group is larger than a row of the grid and its cells.
    """
    far = grid.diagonal_km() if none_km is None else none_km
    nx, step, km = grid.nx, (grid.dx, grid.dy), abs(grid.dx) / 1000
    cell = F.col("cell").cast("int")
    kept = df.where("cell is not null").select(*keys, cell.alias("cell"), grid.row(cell).cast("int").alias("_y"), grid.column(cell).cast("int").alias("_x"), F.coalesce(F.col(event).cast("int"), F.lit(0)).alias("_e"), F.col(u).cast("double").alias("u"), F.col(v).cast("double").alias("v"))
    along = Window.partitionBy(*keys, "_x").orderBy("_y")
    events = kept.where("_e > 0").select(*keys, "_x", "_y").distinct()
    # Of two events as near, the upper one, which is the smaller cell.
    since, until = F.coalesce(F.floor((F.lag("_y").over(along) + F.col("_y")) / 2) + 1, F.lit(0)), F.coalesce(F.floor((F.lead("_y").over(along) + F.col("_y")) / 2), F.lit(grid.ny - 1))
    spans = events.select(*keys, "_x", F.col("_y").alias("_at"), since.cast("int").alias("_a"), until.cast("int").alias("_b")).where("_a <= _b")
    nothing = F.lit(None).cast("double")
    sites = spans.select(*keys, F.explode(F.sequence("_a", "_b")).alias("_y"), F.lit(0).alias("_kind"), "_x", "_at", F.lit(-1).alias("cell"), nothing.alias("u"), nothing.alias("v"))
    cells = kept.select(*keys, "_y", F.lit(1).alias("_kind"), "_x", F.lit(-1).alias("_at"), "cell", "u", "v")

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, [*keys, "_y"]):
            kind, x, at, y, number = (table.column(n).to_numpy() for n in ("_kind", "_x", "_at", "_y", "cell"))
            start = np.flatnonzero(_changes([table.column(k) for k in [*keys, "_y"]]))
            place = np.full(len(table), -1, np.int64)
            if nx <= NARROW:
                row = np.zeros(len(table), np.int64)
                row[start[1:]] = 1
                place = _compared(x.astype(np.int64), np.cumsum(row), kind, (at.astype(np.int64) - y) ** 2, at.astype(np.int64) * nx + x, nx)
            for a, b in zip(start.tolist(), [*start[1:].tolist(), len(table)], strict=True) if nx > NARROW else ():
                m = a + int(np.searchsorted(kind[a:b], 1))  # sites come first, from left to right
                if m > a:
                    own = at[a:m].astype(np.int64) * nx + x[a:m]
                    found, first = _served(x[a:m].tolist(), ((at[a:m].astype(np.int64) - y[a]) ** 2).tolist(), own.tolist(), nx)
                    place[m:b] = own[np.array(found)[np.searchsorted(first, x[m:b], "right") - 1]]
            here = kind == 1
            rows, place, x, y = table.filter(pa.array(here)), place[here], x[here].astype(np.int64), y[here].astype(np.int64)
            ey, ex = np.divmod(place, nx)
            square = np.where(place >= 0, (x - ex) ** 2 + (y - ey) ** 2, 0)
            wind_u, wind_v = (rows.column(n).to_numpy(zero_copy_only=False).astype(float) for n in "uv")
            toward = wind_u * (x - ex) * step[0] + wind_v * (y - ey) * step[1]
            exposure = np.where(square > 0, toward / np.maximum(square * (km * 1000) ** 2, 1), 0.0)
            distance = np.where(place >= 0, np.sqrt(square) * km, far)
            new = [pa.array(number[here]), pa.array(distance), pa.array(exposure, mask=np.isnan(exposure)), pa.array(place.astype(np.int32), mask=place < 0)]
            yield from pa.table([*(rows.column(k) for k in keys), *new], [*keys, "cell", "dist_km", "exposure", "nearest"]).to_batches()

    types = dict(kept.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "cell int, dist_km double, exposure double, nearest int"])
    met = sites.unionByName(cells).repartition(*keys, "_y").sortWithinPartitions(*keys, "_y", "_kind", "_x")
    return met.mapInArrow(transform, schema)


def _complete(df: DataFrame, grid: Grid, value: str, keys: tuple[str, ...]) -> DataFrame:
    """(keys, cell, y, x, value, here) for all cells of the grid; cells that df lacks have no value."""
    cells = F.explode(F.sequence(F.lit(0), F.lit(grid.nx * grid.ny - 1))).alias("cell")
    every = df.select(*keys).distinct().select(*keys, cells) if keys else grid.cells(df.sparkSession).select("cell")
    found = every.join(df.select(*keys, "cell", value, F.lit(True).alias("here")), [*keys, "cell"], "left")
    return found.withColumns({"y": grid.row(F.col("cell")), "x": grid.column(F.col("cell"))})


def _along(x: Column, line: str, place: str, last: int, reach: int, keys: tuple[str, ...]) -> Column:
    """Sum of x over the places within reach on a line of the grid, edge places standing for those beyond the edge."""
    w = Window.partitionBy(*keys, line).orderBy(place)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, after = F.greatest(reach - F.col(place), F.lit(0)), F.greatest(F.col(place) + reach - last, F.lit(0))
    return F.sum(x).over(w.rowsBetween(-reach, reach)) + before * F.first(x).over(whole) + after * F.last(x).over(whole)


def neighbourhood_mean(df: DataFrame, grid: Grid, value: str, size: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cell, mean) of the values there are in size x size cells around, edges replicated.

    Sums along rows, then along columns: two shuffles of one row a cell, whatever the size.
    """
    full = _complete(df, grid, value, keys).withColumns({"_s": F.coalesce(F.col(value).cast("double"), F.lit(0.0)), "_n": F.col(value).isNotNull().cast("double")})
    for line, place, last in (("y", "x", grid.nx - 1), ("x", "y", grid.ny - 1)):
        full = full.withColumns({c: _along(F.col(c), line, place, last, size // 2, keys) for c in ("_s", "_n")})
    return full.where("here").select(*keys, "cell", (F.col("_s") / F.greatest("_n", F.lit(1e-6))).alias("mean"))


def position_index(df: DataFrame, grid: Grid, value: str, size: int = 5) -> DataFrame:
    """(cell, tpi): height above the neighbourhood's mean; missing where the cell is."""
    return df.join(neighbourhood_mean(df, grid, value, size), "cell").select("cell", (F.col(value) - F.col("mean")).alias("tpi"))


def curvature(df: DataFrame, grid: Grid, value: str) -> DataFrame:
    """(cell, curvature): sum of the four neighbours less four times the cell; a missing height counts as 0."""
    full = _complete(df, grid, value, ()).withColumn("_s", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    row, column = _along(F.col("_s"), "y", "x", grid.nx - 1, 1, ()), _along(F.col("_s"), "x", "y", grid.ny - 1, 1, ())
    # Both sums hold the cell itself.
    bend = F.col("_r") + F.col("_c") - 6 * F.col("_s")
    return full.withColumn("_r", row).withColumn("_c", column).where("here").select("cell", bend.alias("curvature"))


def regrid_weights(spark: SparkSession, xs: list[float], ys: list[float], targets: DataFrame) -> DataFrame:
    """(cell, src_id, w): linear weights from a regular source mesh (src_id = row * columns + column) to target places (cell, px, py).

    A mesh square is cut from its low-low to its high-high corner, so that each
    place lies in one of two triangles; places beyond the mesh take the nearest
    mesh point.  Made once for a mesh and used for every field on it.
    """
    nx, ny = len(xs), len(ys)
    x0, y0, sx, sy = xs[0], ys[0], xs[1] - xs[0], ys[1] - ys[0]
    gx, gy = (F.col("px") - x0) / sx, (F.col("py") - y0) / sy
    i = F.least(F.greatest(F.floor(gx), F.lit(0)), F.lit(nx - 2)).cast("int")
    j = F.least(F.greatest(F.floor(gy), F.lit(0)), F.lit(ny - 2)).cast("int")
    within = (gx >= 0) & (gx <= nx - 1) & (gy >= 0) & (gy <= ny - 1)
    a, b = gx - i, gy - j
    point = lambda dj, di: (j + dj) * nx + (i + di)
    entry = lambda src, w: F.struct(src.cast("int").alias("src_id"), w.cast("double").alias("w"))
    lower = F.array(entry(point(0, 0), 1 - a), entry(point(0, 1), a - b), entry(point(1, 1), b))
    upper = F.array(entry(point(0, 0), 1 - b), entry(point(1, 0), b - a), entry(point(1, 1), a))
    nearest_x = F.least(F.greatest(F.rint(gx), F.lit(0.0)), F.lit(float(nx - 1)))
    nearest_y = F.least(F.greatest(F.rint(gy), F.lit(0.0)), F.lit(float(ny - 1)))
    nearest = F.array(entry(nearest_y * nx + nearest_x, F.lit(1.0)))
    found = F.when(~within, nearest).when(a >= b, lower).otherwise(upper)
    return targets.select("cell", F.explode(found).alias("e")).select("cell", "e.src_id", "e.w").where("w > 0")


def regridded(field: DataFrame, weights: DataFrame, value: str = "value", keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """(keys, cell, value): weighted sums; a missing source takes the nearest of the cell's sources that has one."""
    joined = field.join(weights, "src_id")
    there = F.col(value).isNotNull()
    whole = F.count(F.when(~there, 1)) == 0
    best = F.max_by(value, F.when(there, F.struct("w", (-F.col("src_id")).alias("s"))))
    return joined.groupBy(*keys, "cell").agg(F.when(whole, F.sum(F.col("w") * F.col(value))).otherwise(best).alias(value))


def interpolated(points: DataFrame, targets: DataFrame, k: int = 12, power: float = 2.0, value: str = "value", keys: tuple[str, ...] = (), step: float | None = None) -> DataFrame:
    """(keys, cell, value): inverse distance weighting of the k nearest of (keys, src_id, px, py, value), for targets (cell, tx, ty).

    Places meet by squares (of ``step`` at first), which widen until the k nearest
    are certain; no target is joined with all points.  Points and targets without
    a place and points without a value take no part.
    """
    # Of points of one place only the first k can be among the k nearest.
    place = Window.partitionBy(*keys, "px", "py").orderBy("src_id")
    known = points.where(F.col(value).isNotNull() & F.col("px").isNotNull() & F.col("py").isNotNull()).withColumn("_r", F.row_number().over(place)).where(F.col("_r") <= k).select(*keys, "src_id", "px", "py", value)
    asked = targets.select("cell", "tx", "ty").where("tx is not null and ty is not null")
    return _by_squares(known, asked, k, power, value, keys, step)


def _nearest(pairs: DataFrame, k: int, keys: tuple[str, ...]) -> DataFrame:
    order = Window.partitionBy(*keys, "cell").orderBy(F.col("d").asc_nulls_last(), "src_id")
    distance = F.hypot(F.col("tx") - F.col("px"), F.col("ty") - F.col("py"))
    return pairs.withColumn("d", F.when(distance.isNotNull(), F.greatest(distance, F.lit(1.0)))).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def _weighted(value: str, power: float) -> Column:
    weight = 1 / F.pow(F.col("d"), F.lit(power))
    return F.sum(weight * F.col(value)) / F.sum(weight)


#: Pairs of a target and a point that one task orders, about.
PAIRS = 250_000


def _by_squares(known: DataFrame, asked: DataFrame, k: int, power: float, value: str, keys: tuple[str, ...], step: float | None) -> DataFrame:
    """The same by rounds: a target sees the points of its square and the eight around it.

    All points within one square's size are among those, so that a target is
    done if its k-th is no farther; for the others the next round's squares are
    twice as large, until nine hold everything.  A round's rows, one a target,
    are cached for the next; only their number reaches the driver.
    """
    ends = lambda c: (F.min(c).alias(f"{c}0"), F.max(c).alias(f"{c}1"))
    p = known.agg(F.count("*").alias("n"), *ends("px"), *ends("py")).first()
    t = asked.agg(F.count("*").alias("n"), *ends("tx"), *ends("ty")).first()
    if not p.n or t.tx0 is None:
        return asked.join(known.limit(0)).select(*keys, "cell", value)
    x0, y0 = min(p.px0, t.tx0), min(p.py0, t.ty0)
    extent = max(max(p.px1, t.tx1) - x0, max(p.py1, t.ty1) - y0)
    wide, high = p.px1 - p.px0, p.py1 - p.py0
    # About k points a square; distances below 1 count as 1, so smaller squares decide nothing.
    size = max(step or ((wide * high * k / p.n) ** 0.5 or max(wide, high) * k / p.n), 1.001)
    square = lambda x, y: (F.floor((F.col(x) - x0) / size).alias("bx"), F.floor((F.col(y) - y0) / size).alias("by"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o")
    # A target meets about 9 k points at first, which stay in its task.
    asked = asked.repartition(max(1, -(-t.n * 9 * k // PAIRS)), "cell")
    todo = asked.join(F.broadcast(known.select(*keys).distinct())) if keys else asked
    done = []
    while True:
        last = size > extent
        a = todo.select("*", *square("tx", "ty"), around).withColumns({"bx": F.col("bx") + F.col("o.i"), "by": F.col("by") + F.col("o.j")}).alias("a")
        b = known.select("*", *square("px", "py")).alias("b")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "bx", "by")]
        seen = a.join(b, same, "left").select(*[f"a.{c}" for c in (*keys, "cell", "tx", "ty")], *[f"b.{c}" for c in ("src_id", "px", "py", value)])
        sure = F.lit(True) if last else (F.count("d") >= k) & (F.max("d") <= size * (1 - 1e-9))
        found = _nearest(seen, k, keys).groupBy(*keys, "cell", "tx", "ty").agg(_weighted(value, power).alias(value), sure.alias("sure"))
        if last:
            done.append(found)
            break
        found = found.persist()
        done.append(found.where("sure"))
        todo = found.where("not sure").drop(value, "sure")
        if todo.isEmpty():
            break
        size *= 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*keys, "cell", value)


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a place lies in a ring (array of structs x, y): even-odd rule, any orientation, closed or not."""
    n = F.size(ring)

    def crossed(k: Column) -> Column:
        a, b = F.element_at(ring, k), F.element_at(ring, F.when(k == n, F.lit(1)).otherwise(k + 1))
        return F.when((a.x.isNotNull()) & ((a.y > y) != (b.y > y)) & (x < (b.x - a.x) * (y - a.y) / (b.y - a.y) + a.x), 1).otherwise(0)

    return F.pmod(F.aggregate(F.transform(F.sequence(F.lit(1), n), crossed), F.lit(0), lambda s, c: s + c), F.lit(2)) == 1


def polygon_cells(polygons: DataFrame, grid: Grid, ring: str = "ring") -> DataFrame:
    """(polygon columns, cell) for cells whose centre lies in the ring; a polygon only meets cells of its bounding box."""
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    clamp = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)).cast("int")
    corner = lambda a, o, s: (F.array_min(a) - o) / s if s > 0 else (F.array_max(a) - o) / s
    other = lambda a, o, s: (F.array_max(a) - o) / s if s > 0 else (F.array_min(a) - o) / s
    box = polygons.withColumns({"_y": F.sequence(clamp(F.floor(corner(ys, grid.y0, grid.dy)), grid.ny), clamp(F.ceil(other(ys, grid.y0, grid.dy)), grid.ny)), "_x": F.sequence(clamp(F.floor(corner(xs, grid.x0, grid.dx)), grid.nx), clamp(F.ceil(other(xs, grid.x0, grid.dx)), grid.nx))})
    rows = box.withColumn("_y", F.explode("_y")).withColumn("_x", F.explode("_x"))
    x, y = grid.x0 + grid.dx * F.col("_x"), grid.y0 + grid.dy * F.col("_y")
    return rows.where(inside_ring(x, y, F.col(ring))).withColumn("cell", grid.cell(F.col("_y"), F.col("_x"))).drop("_y", "_x")


def projected(parts: Column | str) -> Column:
    """Parts of rings of (x: longitude, y: latitude) with their corners in the European grid."""
    def corner(p: Column) -> Column:
        east, north = equal_area(p.x, p.y)
        return F.struct(east.alias("x"), north.alias("y"))

    return F.transform(parts, lambda rings: F.transform(rings, lambda ring: F.transform(ring, corner)))


def scanned_cells(polygons: DataFrame, grid: Grid, parts: str = "parts", keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """(keys, cell) for cells whose centre lies in a polygon: an array of parts, each an array of rings (the outer one and holes) of structs x, y.

    Edges cross the rows of the grid, a row's crossings are put in order, and
    every other stretch between them is filled; so a part's holes are open,
    whatever the rings' orientation and whether they are closed.  What is worked on
    grows with the edges' rows and the filled cells, not with bounding boxes.
    Corners are in the grid's projection (see :func:`projected`); a part without
    a ring of three corners has no cells.
    """
    points = polygons.select(*keys, F.posexplode(parts).alias("_part", "_rings")).select(*keys, "_part", F.explode("_rings").alias("_ring"))
    n = F.size("_ring")
    edge = lambda p, i: F.struct(p.alias("a"), F.element_at("_ring", F.when(i == n - 1, F.lit(1)).otherwise(i + 2)).alias("b"))
    edges = points.where(n > 2).select(*keys, "_part", F.explode(F.transform("_ring", edge)).alias("e")).select(*keys, "_part", *[F.col(f"e.{p}.{c}").cast("double").alias(f"{p}{c}") for p in "ab" for c in "xy"])
    row = lambda y: (F.col(y) - grid.y0) / grid.dy
    top, bottom = F.greatest(F.ceil(F.least(row("ay"), row("by"))), F.lit(0)), F.least(F.floor(F.greatest(row("ay"), row("by"))), F.lit(grid.ny - 1))
    crossed = edges.withColumns({"_a": top.cast("int"), "_b": bottom.cast("int")}).where("ay <> by and _a <= _b").select("*", F.explode(F.sequence("_a", "_b")).alias("_y"))
    at = grid.y0 + grid.dy * F.col("_y")
    crossed = crossed.where((F.col("ay") > at) != (F.col("by") > at))
    x = ((F.col("ax") + (at - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))) - grid.x0) / grid.dx
    along = Window.partitionBy(*keys, "_part", "_y").orderBy("_x")
    spans = crossed.select(*keys, "_part", "_y", x.alias("_x")).withColumns({"_next": F.lead("_x").over(along), "_n": F.row_number().over(along)}).where("_n % 2 = 1 and _next is not null")
    # A centre on the left end is in, one on the right end is not; with columns that run west it is the other way round.
    first, last = (F.ceil("_x"), F.ceil("_next") - 1) if grid.dx > 0 else (F.floor("_x") + 1, F.floor("_next"))
    filled = spans.withColumns({"_a": F.greatest(first, F.lit(0)).cast("int"), "_b": F.least(last, F.lit(grid.nx - 1)).cast("int")}).where("_a <= _b").select(*keys, "_y", F.explode(F.sequence("_a", "_b")).alias("_x"))
    return filled.select(*keys, grid.cell(F.col("_y"), F.col("_x")).alias("cell")).distinct()


def display_index(spark: SparkSession, grid: Grid, width: int, height: int, west: float, south: float, east: float, north: float) -> DataFrame:
    """(pixel, cell): the grid's cell under each pixel of a Mercator picture of these bounds (degrees), pixels row by row from the north-west; -1 outside the grid."""
    pixel = F.col("id")
    top, bottom = mercator(north), mercator(south)
    lon = west + (east - west) * (F.pmod(pixel, F.lit(width)) + 0.5) / width
    y = top + (bottom - top) * (F.floor(pixel / width) + 0.5) / height
    lat = F.degrees(2 * F.atan(F.exp(y)) - math.pi / 2)
    return spark.range(width * height).select(pixel.alias("pixel"), F.coalesce(grid.located(lon, lat), F.lit(-1)).alias("cell"))


def mercator(lat: float) -> float:
    return math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))


def gathered(values: DataFrame, index: DataFrame, value: str = "value") -> DataFrame:
    """(pixel, value): a raster shown through an index map (pixel, cell); a cell of -1 is nothing."""
    return index.join(values.select("cell", value), "cell", "left").select("pixel", value)
