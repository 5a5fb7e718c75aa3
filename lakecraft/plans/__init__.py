"""Registered queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLE``)."""

from lakecraft.plans import challenges, changes, dashboards, events, features, loads, mart, windows_extra  # noqa: F401
from lakecraft.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
