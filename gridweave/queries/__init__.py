"""Every registered query of the engine with the SQL it is held against."""

from . import aggregates, joins, regrid, scalars, scoring, spatial, upkeep, windows  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
