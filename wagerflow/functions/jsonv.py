"""Tolerant JSON access through VARIANT.

Text is parsed once per row with ``try_parse_json``; fields are read with
``try_variant_get``.  VARIANT keeps the difference between a missing key
(SQL NULL) and a key holding JSON null (variant null), which
``get_json_object`` loses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_json(col: str | Column = "value") -> Column:
    """VARIANT of the text, or NULL when it is not valid JSON."""
    return F.try_parse_json(F.col(col) if isinstance(col, str) else col)


def _node(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def present(v: Column, path: str) -> Column:
    """True when ``path`` exists (even holding JSON null)."""
    return _node(v, path).isNotNull()


def get_string(v: Column, path: str) -> Column:
    """Scalar as text (numbers and booleans in their JSON spelling)."""
    return F.try_variant_get(v, path, "string")


def get_double(v: Column, path: str) -> Column:
    """Number the way Python's ``float()`` reads it: JSON numbers, numeric
    strings (also ``" 7 "`` and ``"nan"``) and booleans (1.0 / 0.0)."""
    return F.try_variant_get(v, path, "double")
