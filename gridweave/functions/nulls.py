"""Missing values: NaN becomes NULL once, at the scan; what combines columns afterwards passes NULL on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any float column becomes NULL, so that aggregates skip it."""
    floats = {c for c, t in df.dtypes if t in ("float", "double")}
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns))


def at_least(x: Column, low: float) -> Column:
    """max(x, low) that is NULL where x is; greatest() alone would skip the NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def at_most(x: Column, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(x, F.lit(high)))


def clip(x: Column, low: float, high: float) -> Column:
    return at_most(at_least(x, low), high)


def holds(condition: Column) -> Column:
    """A comparison with a missing value is false."""
    return F.coalesce(condition, F.lit(False))


def filled(x: Column, policy: str, mean: Column | None = None) -> Column:
    """Missing and infinite values by policy: ``mean``, ``zero`` or ``error``."""
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    other = {"mean": mean, "zero": F.lit(0.0), "error": F.raise_error(F.lit("a feature has a missing value")).cast("double")}[policy]
    return F.when(bad, other).otherwise(x)
