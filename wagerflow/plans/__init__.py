"""Registered queries over the driver's tables, each with its DuckDB oracle."""

from wagerflow.plans.queries import FLAGSHIP, ORACLE, QUERIES  # noqa: F401
