"""Queries that run each operator on the given tables, with the SQL that gives the same result."""

from staywise.plans.catalog import (  # noqa: F401
    cleaning,
    explanation,
    metrics,
    models,
    monitoring,
    preparation,
    statistics,
    storage,
)
from staywise.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
