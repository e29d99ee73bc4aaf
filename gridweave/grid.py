"""A regular grid of cells, row-major from the north-west corner, and its column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.projection import equal_area, equal_area_inverse
from .functions.scalars import grid_index


@dataclass(frozen=True)
class Grid:
    x0: float
    y0: float
    dx: float
    dy: float
    nx: int
    ny: int

    def cell(self, y: Column, x: Column) -> Column:
        return (y * self.nx + x).cast("int")

    def row(self, cell: Column) -> Column:
        return F.floor(cell / self.nx).cast("int")

    def column(self, cell: Column) -> Column:
        return F.pmod(cell, F.lit(self.nx)).cast("int")

    def easting(self, cell: Column) -> Column:
        return self.x0 + self.dx * self.column(cell)

    def northing(self, cell: Column) -> Column:
        return self.y0 + self.dy * self.row(cell)

    def lonlat(self, cell: Column) -> tuple[Column, Column]:
        return equal_area_inverse(self.easting(cell), self.northing(cell))

    def located(self, lon: Column, lat: Column) -> Column:
        """The cell that a place falls in, missing outside the grid."""
        e, n = equal_area(lon, lat)
        x, y = grid_index(e, self.x0, self.dx), grid_index(n, self.y0, self.dy)
        return F.when(self.inside(y, x), self.cell(y, x))

    def inside(self, y: Column, x: Column) -> Column:
        return (x >= 0) & (x < self.nx) & (y >= 0) & (y < self.ny)

    def coarse(self, factor: int) -> Grid:
        """Blocks of factor x factor cells; a centre is the mean of its cells' centres."""
        if self.nx % factor or self.ny % factor:
            raise ValueError("blocks must cover the grid exactly")
        return Grid(self.x0 + self.dx * (factor - 1) / 2, self.y0 + self.dy * (factor - 1) / 2, self.dx * factor, self.dy * factor, self.nx // factor, self.ny // factor)

    def block(self, cell: Column, factor: int) -> Column:
        return (F.floor(self.row(cell) / factor) * (self.nx // factor) + F.floor(self.column(cell) / factor)).cast("int")

    def bounds(self) -> tuple[float, float, float, float]:
        """(west, south, east, north) of the cells' edges."""
        xs = (self.x0 - self.dx / 2, self.x0 + self.dx * (self.nx - 0.5))
        ys = (self.y0 - self.dy / 2, self.y0 + self.dy * (self.ny - 0.5))
        return min(xs), min(ys), max(xs), max(ys)

    def diagonal_km(self) -> float:
        return (self.nx**2 + self.ny**2) ** 0.5 * abs(self.dx) / 1000

    def cells(self, spark: SparkSession) -> DataFrame:
        """(cell, y, x, x_m, y_m) of the whole grid."""
        c = F.col("id").cast("int")
        return spark.range(self.nx * self.ny).select(c.alias("cell"), self.row(c).alias("y"), self.column(c).alias("x"), self.easting(c).alias("x_m"), self.northing(c).alias("y_m"))


# The canonical 1 km grid (metres) and the factor of the served one.
KILOMETRE = Grid(2674734.3466, 2492195.9911, 1000.0, -1000.0, 1188, 920)
SERVED_FACTOR = 2
