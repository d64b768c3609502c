"""Queries over the given tables, each with the SQL that must give the same rows."""

from registry import forecast_queries, relational_queries, review_queries  # noqa: F401
from registry import rule_queries, training_queries  # noqa: F401
from registry.base import ORACLES, QUERIES  # noqa: F401
