"""Watersheds over a grid of any size: basins of marked summits, and connected pieces of cells.

Cells are nodes, neighbours along rows and columns are edges, and an edge costs
the difference of its cells' levels.  Every cell belongs to the mark that it
reaches over the least greatest step: edges are taken by (cost, upper or left
cell, direction), an order without ties, and the spanning forest that grows from
the marks in that order is the only one of least edges.

A grid is cut into tiles of ``TILE`` x ``TILE`` cells, each with the ring of cells
around it.  Within a tile every part without a mark joins along its least edge,
which is an edge of the forest wherever it leads, until that edge leaves the
tile.  What is left, parts at a tile's border and their edges, is some cells a
tile's side; the same rule joins these over a whole grid.  So a task holds one
tile, or the borders of one grid's tiles.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..grid import Grid
from ..sources.sinks import shared_dir
from .spatial import _changes, _complete, _groups

TILE = 256


def _rooted(to: np.ndarray) -> np.ndarray:
    """Where each index ends up by following ``to`` until it stays."""
    while (to[to] != to).any():
        to = to[to]
    return to


def grown(n: int, a: np.ndarray, b: np.ndarray, order: np.ndarray, marked: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """The root of each of n nodes after all that is certain: parts without a mark join along their least edge (a, b).

    ``order`` ranks edges without ties.  A part whose least edge leads to a node
    that is ``outside`` waits; a root with a mark stays a root.
    """
    by = np.argsort(order, kind="stable")
    a, b = a[by], b[by]
    root, fixed = np.arange(n), marked | outside
    live = np.arange(len(a))
    while True:
        ra, rb = root[a[live]], root[b[live]]
        useful = (ra != rb) & ~(fixed[ra] & fixed[rb])
        live, ra, rb = live[useful], ra[useful], rb[useful]
        if not len(live):
            return root
        first = np.full(n, len(a))
        np.minimum.at(first, ra, live)
        np.minimum.at(first, rb, live)
        parts = np.flatnonzero((first < len(a)) & ~fixed)
        edge = first[parts]
        other = np.where(root[a[edge]] == parts, root[b[edge]], root[a[edge]])
        joins = ~outside[other]
        if not joins.any():
            return root
        to = np.arange(n)
        to[parts[joins]] = other[joins]
        both = to[to] == np.arange(n)  # two parts that chose each other: the smaller one is the root
        to[both & (np.arange(n) < to)] = np.flatnonzero(both & (np.arange(n) < to))
        root = _rooted(to)[root]


def _met(left: DataFrame, right: DataFrame, on: tuple[str, ...], how: str = "inner") -> DataFrame:
    """A join by columns of both, where missing values are equal; the left ones stay."""
    named = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(named, same, how).drop(*[f"_on_{c}" for c in on])


def _tiles(cell: Column, grid: Grid, halo: bool) -> Column:
    """The tile of a cell, or all tiles that see it: its own and those whose side it touches."""
    across = -(-grid.nx // TILE)
    y, x = grid.row(cell), grid.column(cell)
    tile = lambda dy, dx: (F.floor((y + dy) / TILE) * across + F.floor((x + dx) / TILE)).cast("int")
    if not halo:
        return tile(0, 0)
    inside = lambda dy, dx: F.when((y + dy >= 0) & (y + dy < grid.ny) & (x + dx >= 0) & (x + dx < grid.nx), tile(dy, dx))
    return F.array_distinct(F.array_compact(F.array(tile(0, 0), inside(-1, 0), inside(1, 0), inside(0, -1), inside(0, 1))))


def spanning(df: DataFrame, grid: Grid, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """(keys, cell, piece, label) of cells (keys, cell, level int, label long, kind long), one row each.

    Neighbours of one kind are joined; a label is the mark of a cell or missing,
    and equal labels are one mark.  A row tells its part's least cell (``piece``,
    of parts without a mark) and mark (missing where none is reached).
    """
    nx, across = grid.nx, -(-grid.nx // TILE)
    spark = df.sparkSession
    seen = df.select(*keys, F.explode(_tiles(F.col("cell"), grid, True)).alias("_tile"), F.col("cell").cast("int").alias("cell"), F.col("level").cast("int").alias("level"), F.col("label").cast("long").alias("label"), F.col("kind").cast("long").alias("kind"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, [*keys, "_tile"]):
            start = np.flatnonzero(_changes([table.column(k) for k in [*keys, "_tile"]])).tolist()
            for begin, end in zip(start, [*start[1:], len(table)], strict=True):
                rows = table.slice(begin, end - begin)
                cell, level, kind = (rows.column(c).to_numpy().astype(np.int64) for c in ("cell", "level", "kind"))
                label = rows.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
                marked = ~np.isnan(label)
                n, tile = len(cell), rows.column("_tile")[0].as_py()
                y, x = np.divmod(cell, nx)
                own = (y // TILE == tile // across) & (x // TILE == tile % across)
                at = np.full((TILE + 2, TILE + 2), -1)
                ly, lx = y - tile // across * TILE + 1, x - tile % across * TILE + 1
                at[ly, lx] = np.arange(n)
                ends = []
                for way, (near, far) in enumerate(((at[:, :-1], at[:, 1:]), (at[:-1], at[1:]))):
                    both = (near >= 0) & (far >= 0)
                    u, v = near[both], far[both]
                    met = (own[u] | own[v]) & (kind[u] == kind[v])
                    ends.append((u[met], v[met], np.abs(level[u[met]] - level[v[met]]) << 40 | cell[u[met]] * 2 + way))
                u, v, order = (np.concatenate(z) for z in zip(*ends, strict=True))
                # Cells of one mark are one node from the start.
                node = np.arange(n)
                here = np.flatnonzero(own & marked)
                if len(here):
                    _, first, back = np.unique(label[here], return_index=True, return_inverse=True)
                    node[here] = here[first][back]
                root = grown(n, node[u], node[v], order, marked & own, ~own)[node]
                least = np.full(n, np.iinfo(np.int64).max)
                np.minimum.at(least, root, cell)
                mark = np.where(marked[root] & own[root], label[root], np.nan)
                side = own & ((lx == 1) | (lx == TILE) | (ly == 1) | (ly == TILE))
                open_ = own & np.isnan(mark)
                left = (root[u] != root[v]) & (open_[u] | open_[v])
                u, v, order = u[left], v[left], order[left]
                # Of edges between the same two parts only the least counts.
                pair = np.sort(np.stack([root[u], root[v]], 1), 1)
                by = np.lexsort((order, pair[:, 1], pair[:, 0]))
                one = np.append(True, (np.diff(pair[by], axis=0) != 0).any(1))[: len(by)]
                pick = by[one]
                u, v, order = u[pick], v[pick], order[pick]
                shown = side.copy()
                shown[u[own[u]]], shown[v[own[v]]] = True, True
                yield sent(rows, np.flatnonzero(own), 0, cell, least[root], mark)
                yield sent(rows, np.flatnonzero(shown), 1, cell, least[root], mark)
                yield edges_sent(rows, cell[u], cell[v], order)

    def sent(rows: pa.Table, at: np.ndarray, sort: int, cell: np.ndarray, piece: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        m = len(at)
        head = [rows.column(k).combine_chunks().take(pa.array(np.zeros(m, np.int64))) for k in keys]
        marks = pa.array(np.nan_to_num(mark[at]).astype(np.int64), mask=np.isnan(mark[at]))
        return pa.RecordBatch.from_arrays([*head, pa.array(np.full(m, sort, np.int32)), pa.array(cell[at]), pa.array(piece[at]), marks], [*keys, "_sort", "cell", "piece", "label"])

    def edges_sent(rows: pa.Table, u: np.ndarray, v: np.ndarray, order: np.ndarray) -> pa.RecordBatch:
        m = len(u)
        head = [rows.column(k).combine_chunks().take(pa.array(np.zeros(m, np.int64))) for k in keys]
        return pa.RecordBatch.from_arrays([*head, pa.array(np.full(m, 2, np.int32)), pa.array(u), pa.array(v), pa.array(order)], [*keys, "_sort", "cell", "piece", "label"])

    def over_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, [*keys, "_all"]):
            start = np.flatnonzero(_changes([table.column(k) for k in [*keys, "_all"]])).tolist()
            for begin, end in zip(start, [*start[1:], len(table)], strict=True):
                rows = table.slice(begin, end - begin)
                sort, cell, piece = (rows.column(c).to_numpy() for c in ("_sort", "cell", "piece"))
                nodes, edges = sort == 1, sort == 2
                label = rows.column("label").filter(pa.array(nodes)).to_numpy(zero_copy_only=False).astype(np.float64)
                # A part is named by its mark, or by its least cell.
                name = np.where(np.isnan(label), piece[nodes], -1 - np.nan_to_num(label).astype(np.int64))
                names, part = np.unique(name, return_inverse=True)
                by = np.argsort(cell[nodes], kind="stable")
                of = lambda c, by=by, part=part, cells=cell[nodes][by]: part[by[np.searchsorted(cells, c)]]
                order = rows.column("label").filter(pa.array(edges)).to_numpy().astype(np.int64)
                root = grown(len(names), of(cell[edges]), of(piece[edges]), order, names < 0, np.zeros(len(names), bool))
                least = np.full(len(names), np.iinfo(np.int64).max)
                np.minimum.at(least, root, np.where(names < 0, np.iinfo(np.int64).max, names))
                loose = np.flatnonzero(names >= 0)
                mark = names[root[loose]]
                head = [rows.column(k).combine_chunks().take(pa.array(np.zeros(len(loose), np.int64))) for k in keys]
                whole = pa.array(least[root[loose]])
                yield pa.RecordBatch.from_arrays([*head, pa.array(names[loose]), whole, pa.array(-1 - mark, mask=mark >= 0)], [*keys, "piece", "_whole", "_label"])

    types = dict(df.dtypes)
    ddl = "".join(f"`{k}` {types[k]}, " for k in keys)
    parts = seen.repartition(*keys, "_tile").sortWithinPartitions(*keys, "_tile", "cell").mapInArrow(local, ddl + "_sort int, cell long, piece long, label long")
    path = f"{shared_dir(spark)}/gridweave/{spark.sparkContext.applicationId}/tiles-{uuid.uuid4().hex}"
    parts.write.parquet(path)
    parts = spark.read.schema(parts.schema).parquet(path)
    borders = parts.where("_sort > 0").withColumn("_all", F.lit(0)).repartition(*keys, "_all").sortWithinPartitions(*keys, "_sort")
    wholes = borders.mapInArrow(over_borders, ddl + "piece long, _whole long, _label long")
    cells = parts.where("_sort = 0").drop("_sort")
    # A part with a mark is whole as it is.
    joined = _met(cells.withColumn("_open", F.when(F.col("label").isNull(), F.col("piece"))), wholes.withColumnRenamed("piece", "_open").where("_open is not null"), (*keys, "_open"), "left")
    return joined.select(*keys, F.col("cell").cast("int").alias("cell"), F.coalesce("_whole", "piece").alias("piece"), F.coalesce("label", "_label").alias("label"))


def connected(df: DataFrame, grid: Grid, keys: tuple[str, ...] = ("day",), kind: str | None = None) -> DataFrame:
    """(keys, cell, piece): which cells of df hang together along rows and columns (of one ``kind``), named by their least cell."""
    same = F.lit(0) if kind is None else F.col(kind)
    return spanning(df.select(*keys, "cell", F.lit(0).alias("level"), F.lit(None).cast("long").alias("label"), same.alias("kind")), grid, keys).drop("label")


def basins(df: DataFrame, grid: Grid, level: str, label: str, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """(keys, cell, label): the mark that each cell belongs to; missing where a grid has none."""
    return spanning(df.select(*keys, "cell", F.col(level).alias("level"), F.col(label).alias("label"), F.lit(0).alias("kind")), grid, keys).drop("piece")


def smoothed(full: DataFrame, grid: Grid, value: str, sigma: float, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """full, all cells of each grid once with their y and x, with ``value`` under a Gaussian of ``sigma`` cells, edges mirrored; rows, then columns."""
    reach = max(1, int(4 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    column = full.columns.index(value)

    def along(line: str, length: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _groups(batches, [*keys, line]):
                v = table.column(value).to_numpy().reshape(-1, length)
                padded = np.pad(v, [(0, 0), (reach, reach)], mode="symmetric")
                out = sum(k * padded[:, i : i + length] for i, k in enumerate(kernel))
                yield from table.set_column(column, value, pa.array(out.ravel())).to_batches()

        return run

    out = full.withColumn(value, F.col(value).cast("double"))
    for line, place, length in (("y", "x", grid.nx), ("x", "y", grid.ny)):
        out = out.repartition(*keys, line).sortWithinPartitions(*keys, line, place).mapInArrow(along(line, length), out.schema)
    return out


def summits(full: DataFrame, value: str, apart: int, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """full, all cells of each grid, with ``top``: whether none is higher in the square of ``apart`` cells around."""
    before, after = apart // 2, apart - 1 - apart // 2
    out = full.withColumn("_m", F.col(value))
    for line, place in (("y", "x"), ("x", "y")):
        out = out.withColumn("_m", F.max("_m").over(Window.partitionBy(*keys, line).orderBy(place).rowsBetween(-before, after)))
    return out.withColumn("top", F.col("_m") <= F.col(value)).drop("_m")


#: Levels of the flooded surface.
LEVELS = 255


def risk_pieces(df: DataFrame, grid: Grid, prob: str = "p", keys: tuple[str, ...] = ("day",), threshold: float = 8.6 * 1.276e-3, smooth_km: float = 4.8, apart_km: float = 20.0) -> DataFrame:
    """(keys, cell, piece): cells above the threshold, in connected pieces that lie in the basin of one summit of the smoothed surface.

    df holds a ``regime`` (0 off land).  Cells that df lacks count as 0 and as off land.
    """
    km = abs(grid.dx) / 1000
    kept = df.select(*keys, F.col("cell").cast("int").alias("cell"), F.struct(F.coalesce(F.nanvl(F.col(prob).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("p"), F.coalesce(F.col("regime") > 0, F.lit(False)).alias("land")).alias("_v"))
    full = _complete(kept, grid, "_v", keys).select(*keys, "cell", "y", "x", F.coalesce("_v.p", F.lit(0.0)).alias("s"), (F.coalesce("_v.land", F.lit(False)) & (F.col("_v.p") > threshold)).alias("mask"))
    field = summits(smoothed(full, grid, "s", smooth_km / km, keys), "s", max(3, round(apart_km / km)), keys)
    tops = connected(field.where("top and mask"), grid, keys).withColumnRenamed("piece", "mark")
    highest = field.groupBy(*keys).agg(F.max("s").alias("_top"))
    share = F.least(F.greatest(F.col("s") / F.greatest("_top", F.lit(1e-9)), F.lit(0.0)), F.lit(1.0))
    level = _met(field, highest, keys).select(*keys, "cell", "mask", F.floor(LEVELS * (1 - share)).cast("int").alias("level"))
    basin = basins(_met(level, tops, (*keys, "cell"), "left"), grid, "level", "mark", keys)
    of = _met(level.where("mask").select(*keys, "cell"), basin, (*keys, "cell")).select(*keys, "cell", F.coalesce("label", F.lit(-1)).alias("label"))
    return connected(of, grid, keys, "label")


def danger_areas(df: DataFrame, grid: Grid, prob: str = "p", region: str = "region", keys: tuple[str, ...] = ("day",), least: float = 0.10, drivers: DataFrame | None = None, **settings: float) -> DataFrame:
    """(keys, area, p_any, peak_cell, radius_m, n_cells, regime, region, causes): the pieces with at least that probability of any event.

    What pieces (:func:`risk_pieces`) amount to is a grouping of their cells.
    ``drivers`` are (regime, features array), by which an area of that regime has
    its causes in plain words; those of areas without spread leave out events nearby.
    """
    from ..plans.serving import SPREAD, causes
    from .aggregates import any_event

    cells = df.select(*keys, F.col("cell").cast("int").alias("cell"), F.col(prob).cast("double").alias("p"), "regime", F.nullif(F.col(region).cast("int"), F.lit(0)).alias("g"))
    x, y = grid.column(F.col("cell")), grid.row(F.col("cell"))
    reach = F.greatest((F.max(x) - F.min(x)) / 2, (F.max(y) - F.min(y)) / 2, F.lit(1.0))
    pieces = risk_pieces(df, grid, prob, keys, **settings)
    found = _met(pieces, cells, (*keys, "cell")).groupBy(*keys, "piece").agg(
        any_event(F.col("p")).alias("p_any"),
        F.max_by("cell", F.struct("p", -F.col("cell"))).alias("peak_cell"),
        ((reach + 0.5) * abs(grid.dx)).alias("radius_m"),
        F.count("*").cast("int").alias("n_cells"),
        F.when(F.avg((F.col("regime") == SPREAD).cast("int")) > 0.5, SPREAD).otherwise(1).alias("regime"),
        F.coalesce(F.mode("g", True), F.lit(0)).alias("region"),
    ).where(F.col("p_any") >= least)
    if drivers is None:
        found = found.withColumn("causes", F.array().cast("array<string>"))
    else:
        said = causes(F.col("features"))
        said = F.when(F.col("regime") == SPREAD, said).otherwise(F.filter(said, lambda c: c != "near active fire"))
        found = found.join(F.broadcast(drivers.select("regime", said.alias("causes"))), "regime", "left").withColumn("causes", F.coalesce("causes", F.array().cast("array<string>")))
    first = Window.partitionBy(*keys).orderBy(F.desc("p_any"), "peak_cell")
    return found.select(*keys, F.row_number().over(first).alias("area"), "p_any", "peak_cell", "radius_m", "n_cells", "regime", "region", "causes")
