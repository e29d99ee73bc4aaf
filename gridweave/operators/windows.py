"""Windows along the days of a cell; all take columns over one specification, so one sort serves a chain of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.nulls import clip, holds


def along(cell: str = "cell", day: str = "day") -> WindowSpec:
    return Window.partitionBy(cell).orderBy(day)


#: Doubles are summed as whole multiples of these units, each of what the one before leaves, so that differences of
#: running sums are exact whatever came before.  Totals may reach 2**103; what a value has below 2**-80 is cut.
UNITS = (2.0**40, 1.0, 2.0**-40, 2.0**-80)


def _so_far(w: WindowSpec, back: int = 0) -> WindowSpec:
    """Rows up to ``back`` rows ago.  Such a frame only grows, so each row is taken in once; a sliding one is summed anew for each row."""
    return w.rowsBetween(Window.unboundedPreceding, -back)


def _within(f: Column, n: int, w: WindowSpec) -> Column:
    """A sum or count over the last n rows, as the difference of two running ones."""
    if n < 1:
        raise ValueError("a window has one row at least")
    return F.coalesce(f.over(_so_far(w)), F.lit(0)) - F.coalesce(f.over(_so_far(w, n)), F.lit(0))


def _finite(x: Column) -> Column:
    """x as a double, missing if it is NaN or infinite."""
    x = x.cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _sum(x: Column, n: int, w: WindowSpec, whole: bool) -> Column:
    if whole:
        return _within(F.sum(x), n, w)
    out = F.lit(0.0)
    for unit in UNITS:
        out = out + _within(F.sum((x / unit).cast("long")), n, w) * F.lit(unit)
        x = x % F.lit(unit)
    return out


def trailing_sum(x: Column, n: int, w: WindowSpec, whole: bool = False) -> Column:
    """Sum of the last n rows, or of those there are; missing values, NaN and infinite ones are skipped.

    ``whole``: x is a whole number and is summed as it is.
    """
    x = x if whole else _finite(x)
    return F.when(_within(F.count(x), n, w) > 0, _sum(x, n, w, whole))


def strict_sum(x: Column, n: int, w: WindowSpec, complete: bool = False, whole: bool = False) -> Column:
    """As trailing_sum, but missing before n rows; ``complete``: also where a row of the window is missing."""
    there = _within(F.count(x if whole else _finite(x)), n, w) == n if complete else F.row_number().over(w) >= n
    return F.when(there, trailing_sum(x, n, w, whole))


def poisoned_sum(x: Column, n: int, w: WindowSpec, whole: bool = False) -> Column:
    """As strict_sum, but missing from a cell's first missing value on, as differences of a running sum are."""
    row = F.row_number().over(w)
    return F.when((row >= n) & (F.count(x if whole else _finite(x)).over(_so_far(w)) == row), trailing_sum(x, n, w, whole))


#: When a sum over the last rows is there, by what rolled() knows of a row: its number, the values in the window and the values so far.
RULES = {
    "any": lambda row, n, here, so_far: here > 0,
    "strict": lambda row, n, here, so_far: (row >= n) & (here > 0),
    "complete": lambda row, n, here, so_far: here == n,
    "poisoned": lambda row, n, here, so_far: (row >= n) & (so_far == row),
}


def rolled(df: DataFrame, x: Column, w: WindowSpec, **sums: tuple[int, str]) -> DataFrame:
    """df with several sums of x at once: (rows, rule) by name, as trailing_sum (``any``), strict_sum and poisoned_sum give them.

    Each of those takes the running sums anew, as does Spark; here they are taken once, and looked up n rows ago.
    """
    if any(n < 1 for n, _ in sums.values()):
        raise ValueError("a window has one row at least")
    x = _finite(x)
    kept = {"_row": F.row_number().over(w), "_n": F.count(x).over(_so_far(w))}
    for k, unit in enumerate(UNITS):
        kept[f"_s{k}"] = F.coalesce(F.sum((x / unit).cast("long")).over(_so_far(w)), F.lit(0))
        x = x % F.lit(unit)
    within = {f"_{c}_{n}": F.col(c) - F.lag(c, n, 0).over(w) for n in {n for n, _ in sums.values()} for c in kept if c != "_row"}
    wide = df.withColumns(kept).withColumns(within)
    out = {}
    for name, (n, rule) in sums.items():
        total = F.lit(0.0)
        for k, unit in enumerate(UNITS):
            total = total + F.col(f"__s{k}_{n}") * F.lit(unit)
        out[name] = F.when(RULES[rule](F.col("_row"), n, F.col(f"__n_{n}"), F.col("_n")), total)
    return wide.withColumns(out).drop(*kept, *within)


def run_length(condition: Column, w: WindowSpec) -> Column:
    """Rows in a row, up to this one, for which the condition held; a missing value ends a run."""
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    row = F.row_number().over(w)
    return (row - F.coalesce(F.max(F.when(~holds(condition), row)).over(up_to), F.lit(0))).cast("int")


def rows_numbered(df: DataFrame, w: WindowSpec, name: str = "_row") -> DataFrame:
    return df.withColumn(name, F.row_number().over(w))


def run_lengths(df: DataFrame, w: WindowSpec, **conditions: Column) -> DataFrame:
    """df with a run length for each named condition; window functions cannot nest, so rows are numbered first."""
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows_numbered(df, w)
    out = {name: (F.col("_row") - F.coalesce(F.max(F.when(~holds(c), F.col("_row"))).over(up_to), F.lit(0))).cast("int") for name, c in conditions.items()}
    return numbered.withColumns(out).drop("_row")


def days_since(df: DataFrame, w: WindowSpec, event: Column, name: str, day: str = "day", before_first: str = "count") -> DataFrame:
    """Days since the last event: 0 on it; before the first one the days of the series (``count``) or missing (``null``)."""
    last = F.last(F.when(holds(event), F.col(day)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    gap = F.datediff(F.col(day), last)
    if before_first == "null":
        return df.withColumn(name, gap)
    return df.withColumn(name, F.coalesce(gap, F.row_number().over(w)).cast("int"))


def counter(df: DataFrame, w: WindowSpec, event: Column, seed: Column, name: str) -> DataFrame:
    """Rows since the last event, carried on from a seed (the count before the first row); a missing event is none."""
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows_numbered(df, w)
    last = F.max(F.when(holds(event), F.col("_row"))).over(up_to)
    return numbered.withColumn(name, F.coalesce(F.col("_row") - last, F.col("_row") + seed).cast("int")).drop("_row")


def zscore(x: Column, by: list[str], eps: float = 1e-6, bound: float = 10.0) -> Column:
    """Departure from all years' mean in population deviations, cut at the bound."""
    w = Window.partitionBy(*by)
    return clip((x - F.avg(x).over(w)) / (F.stddev_pop(x).over(w) + eps), -bound, bound)


def causal_zscore(x: Column, by: list[str], order: str, eps: float = 1e-6, bound: float | None = 10.0) -> Column:
    """Departure from earlier occurrences only; missing before two of them have values; not cut without a bound."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # Central moments: squares less a squared mean would cancel for large values of small spread.
    apart = (x - F.avg(x).over(w)) / (F.stddev_pop(x).over(w) + eps)
    return F.when(F.count(x).over(w) >= 2, apart if bound is None else clip(apart, -bound, bound))


def within_horizon(event: Column, days: int, w: WindowSpec) -> Column:
    """Whether an event comes on one of the next rows; missing where fewer than that many follow."""
    ahead = w.rowsBetween(1, days)
    return F.when(F.count(F.lit(1)).over(ahead) == days, F.max(holds(event).cast("int")).over(ahead))


def running(x: Column, w: WindowSpec) -> tuple[Column, Column]:
    """(sum, maximum) so far."""
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(x).over(up_to), F.max(x).over(up_to)
