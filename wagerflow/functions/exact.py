"""Sums of doubles that do not depend on the order of addition.

A value whose decimal spelling fits DECIMAL(28,15) is added exactly as a decimal; all others (very large, very small,
NaN, infinite) are added as doubles beside it.  No value is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "decimal(28,15)"
_LIMIT = 1e12


def exact_part(v: Column) -> Column:
    """The value as a decimal if that holds all of it, else NULL."""
    # NaN compares greater than every number, so the first test drops it too
    d = F.when(F.abs(v) < _LIMIT, v).cast(EXACT_TYPE)
    return F.when(d.cast("double") == v, d)


def inexact_part(v: Column) -> Column:
    """The value as a double if it has no exact part, else 0."""
    return F.when(v.isNotNull() & exact_part(v).isNull(), v).otherwise(F.lit(0.0))


def total(exact_sum: Column, inexact_sum: Column) -> Column:
    """The sum of both parts as a double (0 for no rows)."""
    return F.coalesce(exact_sum.cast("double"), F.lit(0.0)) + F.coalesce(inexact_sum, F.lit(0.0))


def exact_sum(v: Column) -> Column:
    """``sum(v)`` of a group; NULL if it has no value."""
    return F.when(F.count(v) > 0, total(F.sum(exact_part(v)), F.sum(inexact_part(v))))
