"""Registered queries over the driver's tables, and the SQL that tells their results."""

from .plans import files, further  # noqa: F401  they register their queries
from .plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
