"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from wagerflow.functions.jsonv import (  # noqa: F401
    get_double, get_string, parse_json, present,
)
from wagerflow.functions.timefmt import iso_format, parse_iso_timestamp  # noqa: F401
from wagerflow.functions.uuids import canonical_uuid  # noqa: F401
