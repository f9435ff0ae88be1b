"""Queries over the test tables and the SQL they are compared with."""

from checks.registry import ORACLES, QUERIES
from checks import (  # noqa: F401  (register their queries)
    arrivals, features, incremental, ingest, linear, models, prep, relational, trees)

__all__ = ["ORACLES", "QUERIES"]
