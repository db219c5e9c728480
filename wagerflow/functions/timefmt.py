"""ISO-8601 parsing and formatting (UTC session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the ISO shapes accepted for event times (date, optional time
# with 'T' or space, optional fraction, optional Z or numeric offset).
ISO_PATTERN = (r"^\d{4}-\d{2}-\d{2}"
               r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?"
               r"(Z|[+-]\d{2}(:?\d{2})?)?$")

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_iso_timestamp(s: Column) -> Column:
    """UTC instant of an ISO string; NULL for anything else.

    A plain ``try_cast`` would also take words such as ``'yesterday'`` or a
    bare year, hence the pattern guard.  Strings without a zone are UTC.
    """
    t = F.trim(s)
    return F.when(t.rlike(ISO_PATTERN), F.try_to_timestamp(
        F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")))


def iso_format(ts: Column, fmt: str = ISO_SECONDS) -> Column:
    return F.date_format(ts, fmt)
