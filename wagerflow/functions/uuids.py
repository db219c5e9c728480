"""UUID validation and canonical spelling without a UUID type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical UUID text and the 32-digit hex form.
CANONICAL = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
HEX32 = r"^[0-9a-f]{32}$"


def canonical_uuid(s: Column) -> Column:
    """Lower-case hyphenated UUID, or NULL when ``s`` is not one.

    Accepts what the standard UUID parser accepts in practice: ``urn:`` /
    ``uuid:`` prefixes, surrounding braces, hyphens anywhere, any letter
    case; the rest must be exactly 32 hex digits.  Text that is already
    canonical (the common case) costs one anchored match.
    """
    h = F.lower(F.regexp_replace(F.regexp_replace(s, "urn:|uuid:", ""), r"^[{}]+|[{}]+$|-", ""))
    rebuilt = F.when(h.rlike(HEX32), F.regexp_replace(
        h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
    return F.when(s.rlike(CANONICAL), s).otherwise(rebuilt)
