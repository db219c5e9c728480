"""Per-record parsers of the four stream jobs (game, status, amount, user).

Semantics of the reference jobs, expressed as Column expressions:

* a key that is present -- even holding JSON null -- yields ``(key, 1)``;
* a missing key, text that is not JSON, or JSON that is not an object yields
  ``("invalid", 0)``;
* the amount is read like Python's ``float()`` (numbers, numeric strings,
  ``"nan"``, booleans); anything else yields ``(0, 0.0)``.

``shape="flat"`` reads the flat keys the jobs use; ``shape="nested"`` reads the
same fields from the producer's nested event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerflow.functions.exact import exact_part, inexact_part
from wagerflow.functions.jsonv import get_double, get_string, parse_json, present
from wagerflow.functions.timefmt import parse_iso_timestamp
from wagerflow.session import ensure_parse_conf

INVALID = "invalid"

# JSON paths per event shape.
PATHS = {
    "flat": {"game": "$.game", "status": "$.status", "amount": "$.amount",
             "user_id": "$.user_id", "timestamp": "$.timestamp", "bet_id": "$.bet_id"},
    "nested": {"game": "$.event.sport", "status": "$.bet.status", "amount": "$.bet.amount",
               "user_id": "$.user.user_id", "timestamp": "$.bet.timestamp",
               "bet_id": "$.bet_id"},
}

def _paths(shape: str) -> dict[str, str]:
    if shape not in PATHS:
        raise ValueError(f"unknown event shape {shape!r}")
    return PATHS[shape]


def with_variant(df: DataFrame, col: str = "value") -> DataFrame:
    """Parse the JSON text once; later expressions read fields from ``_v``."""
    if "_v" in df.columns:
        return df
    ensure_parse_conf(df.sparkSession)
    return df.withColumn("_v", parse_json(col))


def event_time(shape: str = "flat"):
    """Event time: the event's ISO timestamp, else the record time, else the
    ingestion time.  The last fallback makes the column non-nullable, so the
    ``isnotnull`` guard that ``window()`` adds is folded away instead of being
    pushed below the parse (which would parse every row twice)."""
    v = F.col("_v")
    return F.coalesce(parse_iso_timestamp(get_string(v, _paths(shape)["timestamp"])),
                      F.col("timestamp"), F.current_timestamp())


def parse_key(df: DataFrame, field: str, shape: str = "flat", out: str | None = None) -> DataFrame:
    """Add ``(out, n)``: the key's text if present else ``'invalid'``; n = 1/0."""
    path = _paths(shape)[field]
    df = with_variant(df)
    v = F.col("_v")
    p = present(v, path)
    return (df.withColumn(out or field, F.when(p, get_string(v, path)).otherwise(F.lit(INVALID)))
              .withColumn("n", p.cast("long")))


def parse_bet(df: DataFrame, shape: str = "flat") -> DataFrame:
    """``(game, n)`` plus ``event_time``."""
    return parse_key(df, "game", shape).withColumn("event_time", event_time(shape))


def parse_status(df: DataFrame, shape: str = "flat") -> DataFrame:
    return parse_key(df, "status", shape)


def parse_user(df: DataFrame, shape: str = "flat") -> DataFrame:
    return parse_key(df, "user_id", shape).withColumn("event_time", event_time(shape))


def parse_amount(df: DataFrame, shape: str = "flat") -> DataFrame:
    """Add ``n`` (1 when the amount reads as a number), ``amount`` (double,
    0.0 otherwise) and the exact parts used by the running average:
    ``amount_exact`` (DECIMAL, NULL when it does not hold the whole value) and
    ``amount_inexact`` (the double when it has no exact form, else 0)."""
    path = _paths(shape)["amount"]
    df = with_variant(df)
    v = F.col("_v")
    d = get_double(v, path)
    return (df.withColumn("n", d.isNotNull().cast("long"))
              .withColumn("amount", F.coalesce(d, F.lit(0.0)))
              .withColumn("amount_exact", exact_part(d))
              .withColumn("amount_inexact", inexact_part(d)))
