"""Queries over the test tables, each with the SQL it is checked against."""

from .registry import ORACLES, QUERIES
from . import landed, places, plans, series, shapes, store, values  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
