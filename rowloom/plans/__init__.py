"""Queries that run the operators on the driver tables, each with its SQL where SQL can say it."""

from rowloom.plans import (  # noqa: F401
    aggregates,
    changes,
    checks,
    formats,
    functions,
    lookups,
    matches,
    outcomes,
    rowcodes,
    shapes,
    streams,
    tables,
)
from rowloom.plans.registry import QUERIES, SQL, TABLES

__all__ = ["QUERIES", "SQL", "TABLES"]
