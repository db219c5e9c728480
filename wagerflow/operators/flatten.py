"""Typing and validation of nested bet events (the ingest consumer).

``annotate_bets`` computes, from one JSON parse per record, the 21 typed
columns of the ``bets`` table plus an array of reasons why the row cannot be
stored.  ``split_bets`` turns that into the valid rows and a quarantine
table; nothing is dropped silently (the reference skips bad rows with a log
line, or dies on undecodable text).

Rules (the consumer's, expressed as Column expressions):

* required: ``bet_id`` (UUID), objects ``user``/``event``/``bet``/``metadata``,
  ``user.user_id`` (UUID), ``bet.timestamp`` (ISO), ``metadata.session_id``
  (UUID), ``metadata.created_at`` (ISO);
* optional text / age: missing or JSON null -> NULL; text longer than the
  column -> rejected;
* odds / amount / payout: missing -> 0; JSON null, booleans, non-numbers,
  NaN or values that overflow the column -> rejected; rounded half-up to the
  column scale;
* ``event.start_time`` is not a column (kept only in ``raw_event``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerflow.functions.jsonv import present
from wagerflow.functions.timefmt import parse_iso_timestamp
from wagerflow.functions.uuids import canonical_uuid
from wagerflow.operators.parse import with_variant
from wagerflow.schemas import BET_COLUMNS, MONEY_TYPE, ODDS_TYPE, VARCHAR_LIMITS


# Optional text columns and their JSON paths.
TEXT_FIELDS = {
    "country": "$.user.country", "device": "$.user.device", "ip_address": "$.user.ip_address",
    "sport": "$.event.sport", "league": "$.event.league", "match": "$.event.match",
    "selection": "$.event.selection", "currency": "$.bet.currency", "status": "$.bet.status",
    "source": "$.metadata.source",
}
DECIMAL_FIELDS = {"odds": ("$.event.odds", ODDS_TYPE), "amount": ("$.bet.amount", MONEY_TYPE),
                  "payout": ("$.bet.payout", MONEY_TYPE)}
UUID_FIELDS = {"bet_id": "$.bet_id", "user_id": "$.user.user_id",
               "session_id": "$.metadata.session_id"}
TIME_FIELDS = {"bet_timestamp": "$.bet.timestamp", "created_at": "$.metadata.created_at"}
OBJECTS = ["user", "event", "bet", "metadata"]


def _compact(checks: list[Column]) -> Column:
    """The non-NULL reasons, in order.  ``array_except`` with a NULL array is
    code-generated, unlike a lambda ``filter`` (which would drop the whole
    projection out of whole-stage codegen); reasons are distinct anyway."""
    return F.array_except(F.array(*checks), F.array(F.lit(None).cast("string")))


def _parent(path: str) -> str | None:
    parts = path[2:].split(".")
    return parts[0] if len(parts) > 1 else None


def _kind(path: str) -> Column:
    """Type name of a leaf JSON node (NULL when the key is missing,
    ``'VOID'`` for JSON null, ``'STRING'``, ``'BOOLEAN'``, ...)."""
    return F.schema_of_variant(F.try_variant_get(F.col("_v"), path, "variant"))


def _slug(path: str) -> str:
    return path[2:].replace(".", "__")


# Every leaf the table reads, extracted as text in one pass over the event.
_LEAVES = sorted(set(list(UUID_FIELDS.values()) + list(TIME_FIELDS.values())
                     + [p for p, _ in DECIMAL_FIELDS.values()] + list(TEXT_FIELDS.values())
                     + ["$.user.age"]))
# Leaves whose JSON type decides validity (uuid/time must be strings, money
# must not be boolean/null, age null vs bad).
_TYPED_LEAVES = list(UUID_FIELDS.values()) + list(TIME_FIELDS.values()) \
    + [p for p, _ in DECIMAL_FIELDS.values()] + ["$.user.age"]


def _event_struct_type() -> str:
    top: dict[str, list[str]] = {}
    for p in _LEAVES:
        parts = p[2:].split(".")
        top.setdefault(parts[0], [])
        if len(parts) > 1:
            top[parts[0]].append(parts[1])
    fields = [f"`{k}` string" if not subs else
              f"`{k}` struct<{', '.join(f'`{x}` string' for x in subs)}>"
              for k, subs in top.items()]
    return f"struct<{', '.join(fields)}>"


def _k(path: str) -> Column:
    return F.col(f"_k_{_slug(path)}")


def _s(path: str) -> Column:
    return F.col("_e").getField(path[2:].split(".")[0]) if path.count(".") == 1 else \
        F.col("_e").getField(path[2:].split(".")[0]).getField(path[2:].split(".")[1])


def _decimal(path: str, dtype) -> tuple[Column, Column]:
    """(value, bad) from stage-A columns: missing -> 0; numbers or numeric
    text are rounded to the column scale; booleans/null/garbage are bad."""
    kind = _k(path)
    val = F.when(kind.isNull(), F.lit(0).cast(dtype)).otherwise(
        F.when(kind != F.lit("BOOLEAN"), _s(path).try_cast(dtype)))
    return val, kind.isNotNull() & val.isNull()


def annotate_bets(records: DataFrame) -> DataFrame:
    """Typed columns + ``reasons`` (empty array = storable) + version columns.

    Stage A reads the event once as a struct of texts, plus the presence of
    the sub-objects and the JSON type of the leaves that need it; stage B
    types and validates from those columns (each computed exactly once).
    """
    df = with_variant(records)
    keep = [F.col(c) for c in ("value", "timestamp", "partition", "offset")]
    V = F.col("_v")
    staged = df.select(
        *keep, V.isNull().alias("_malformed"),
        F.try_variant_get(V, "$", _event_struct_type()).alias("_e"),
        *[present(V, f"$.{o}").alias(f"_p_{o}") for o in OBJECTS],
        *[_kind(p).alias(f"_k_{_slug(p)}") for p in _TYPED_LEAVES])

    def obj_ok(o: str) -> Column:
        return F.col(f"_o_{o}")

    def guarded(path: str, cond: Column) -> Column:
        parent = _parent(path)
        return cond if parent is None else F.when(obj_ok(parent), cond)

    # Stage B1: typed values, each computed once.
    cols: dict[str, Column] = {}
    for name, path in UUID_FIELDS.items():
        cols[name] = F.when(_k(path) == F.lit("STRING"), canonical_uuid(_s(path)))
    for name, path in TIME_FIELDS.items():
        cols[name] = F.when(_k(path) == F.lit("STRING"), parse_iso_timestamp(_s(path)))
    for name, path in TEXT_FIELDS.items():
        cols[name] = _s(path)
    cols["age"] = _s("$.user.age").try_cast("int")
    for name, (path, dtype) in DECIMAL_FIELDS.items():
        cols[name] = _decimal(path, dtype)[0]
    typed = staged.select(
        *keep, "_malformed", F.col("_e").isNull().alias("_not_obj"),
        *[F.col(f"_p_{o}") for o in OBJECTS],
        *[F.col("_e").getField(o).isNotNull().alias(f"_o_{o}") for o in OBJECTS],
        *[F.col(f"_k_{_slug(p)}") for p in _TYPED_LEAVES],
        *[c.alias(n) for n, c in cols.items()])

    # Stage B2: reasons from the typed values (plain column references).
    checks: list[Column] = []
    for o in OBJECTS:
        checks.append(F.when(~F.col(f"_p_{o}"), F.lit(f"missing:{o}"))
                      .when(~obj_ok(o), F.lit(f"not_object:{o}")))
    for name, path in UUID_FIELDS.items():
        checks.append(guarded(path, F.when(_k(path).isNull(), F.lit(f"missing:{path[2:]}"))
                                     .when(F.col(name).isNull(), F.lit(f"bad_uuid:{path[2:]}"))))
    for name, path in TIME_FIELDS.items():
        checks.append(guarded(path, F.when(_k(path).isNull(), F.lit(f"missing:{path[2:]}"))
                                     .when(F.col(name).isNull(),
                                           F.lit(f"bad_timestamp:{path[2:]}"))))
    for name, path in TEXT_FIELDS.items():
        checks.append(guarded(path, F.when(F.length(F.col(name)) > VARCHAR_LIMITS[name],
                                           F.lit(f"too_long:{name}"))))
    age_kind = _k("$.user.age")
    checks.append(guarded("$.user.age", F.when(
        age_kind.isNotNull() & (age_kind != F.lit("VOID")) & F.col("age").isNull(),
        F.lit("bad_int:age"))))
    for name, (path, _) in DECIMAL_FIELDS.items():
        checks.append(guarded(path, F.when(_k(path).isNotNull() & F.col(name).isNull(),
                                           F.lit(f"bad_decimal:{name}"))))

    reasons = (F.when(F.col("_malformed"), F.array(F.lit("malformed_json")))
                .when(F.col("_not_obj"), F.array(F.lit("not_object")))
                .otherwise(_compact(checks)))
    out = {c: F.col(c) for c in cols}
    out["exported"] = F.lit(False)
    out["raw_event"] = F.col("value")
    return typed.select(
        *[out[c].alias(c) for c in BET_COLUMNS],
        F.col("timestamp").alias("src_timestamp"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
        reasons.alias("reasons"),
        *keep)


INGEST_METRICS = "wagerflow_ingest"


def observe_ingest(annotated: DataFrame, name: str = INGEST_METRICS) -> DataFrame:
    """Attach ingestion counters (rows, stored, rejected) as observed metrics.

    Reported per action / micro-batch (``StreamingQueryProgress.observedMetrics``
    or a query listener).  The observation node also keeps Catalyst from
    pushing the validity filter below the typing projection, which would
    re-evaluate the parse inside the predicate once per referenced field.
    """
    return annotated.observe(
        name, F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.size("reasons") == 0, 1)).alias("stored"),
        F.count(F.when(F.size("reasons") > 0, 1)).alias("rejected"))


def split_bets(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid bets with version columns, quarantine rows)."""
    annotated = observe_ingest(annotated)
    ok = F.size("reasons") == 0
    valid = annotated.filter(ok).select(*BET_COLUMNS, "src_timestamp", "src_partition",
                                        "src_offset")
    bad = annotated.filter(~ok).select("value", "reasons", "timestamp", "partition", "offset")
    return valid, bad


def flatten_bets(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_bets(annotate_bets(records))


def rejected_by_reason(quarantine: DataFrame) -> DataFrame:
    """Ingestion error counter by reason: ``(reason, rows)``."""
    return (quarantine.select(F.explode("reasons").alias("reason"))
                      .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def expected_payout(bets: DataFrame) -> DataFrame:
    """Settlement rule: ``round(amount * odds, 2)`` for a win, else 0; adds
    ``expected_payout`` and ``payout_ok`` (stored payout equals the rule).
    The rule has the digits of the product: a win that the money type cannot
    hold is a payout that differs, not an error."""
    exp = F.when(F.col("status") == "win", F.round(F.col("amount") * F.col("odds"), 2)) \
        .otherwise(F.lit(0)).cast("decimal(18,2)")
    return (bets.withColumn("expected_payout", exp)
                .withColumn("payout_ok", F.col("payout").eqNullSafe(exp)))


# --- top games consumer ---------------------------------------------------

def annotate_top_games(records: DataFrame) -> DataFrame:
    """Rows of the ``top_games`` table plus ``reasons``.

    sport defaults to ``'unknown'`` only when missing (JSON null violates NOT
    NULL); league defaults to NULL; amount defaults to 0 and may be NULL; the
    time is the record's (broker) time.
    """
    df = with_variant(records)
    V = F.col("_v")
    staged = df.select(
        "value", "timestamp", "partition", "offset", V.isNull().alias("_malformed"),
        F.try_variant_get(V, "$", "struct<`event` struct<`sport` string, `league` string>, "
                                 "`bet` struct<`amount` string>>").alias("_e"),
        present(V, "$.event").alias("_p_event"), present(V, "$.bet").alias("_p_bet"),
        _kind("$.event.sport").alias("_k_event__sport"),
        _kind("$.bet.amount").alias("_k_bet__amount"))
    e = F.col("_e")
    ev_ok = ~F.col("_p_event") | e.getField("event").isNotNull()
    bet_ok = ~F.col("_p_bet") | e.getField("bet").isNotNull()
    sport = F.when(_k("$.event.sport").isNull(), F.lit("unknown")) \
        .otherwise(_s("$.event.sport"))
    amt_null = _k("$.bet.amount") == F.lit("VOID")
    amt, amt_bad = _decimal("$.bet.amount", MONEY_TYPE)
    amount = F.when(amt_null, F.lit(None).cast(MONEY_TYPE)).otherwise(amt)
    reasons = (F.when(F.col("_malformed"), F.array(F.lit("malformed_json")))
                .when(e.isNull(), F.array(F.lit("not_object")))
                .otherwise(_compact([
                    F.when(~ev_ok, F.lit("not_object:event")),
                    F.when(~bet_ok, F.lit("not_object:bet")),
                    F.when(ev_ok & sport.isNull(), F.lit("null:event.sport")),
                    F.when(bet_ok & ~amt_null & amt_bad, F.lit("bad_decimal:amount"))])))
    return staged.select(
        sport.alias("sport"),
        F.when(ev_ok, _s("$.event.league")).alias("league"),
        amount.alias("total_amount"),
        F.col("timestamp"),
        F.col("value").alias("raw_event"),
        reasons.alias("reasons"),
        F.col("partition"), F.col("offset"))


def flatten_top_games(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_top_games(annotate_top_games(records))


def split_top_games(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(top_games rows, quarantine rows) from ``annotate_top_games``."""
    ann = observe_ingest(annotated, "wagerflow_top_games")
    ok = F.size("reasons") == 0
    return (ann.filter(ok).select("sport", "league", "total_amount", "timestamp", "raw_event"),
            ann.filter(~ok).select(F.col("raw_event").alias("value"), "reasons", "timestamp",
                                   "partition", "offset"))


# --- legacy flat table (bet_id, user_id, game, amount, status, timestamp) --

LEGACY_LIMITS = {"game": 100, "status": 20}


def annotate_legacy_bets(records: DataFrame) -> DataFrame:
    """Rows of the older flat ``bets`` table plus ``reasons``.

    All of bet_id/user_id (UUID), game, amount, status are NOT NULL; the time
    defaults to the record (ingestion) time when the event has none.
    """
    df = with_variant(records)
    V = F.col("_v")
    paths = {"bet_id": "$.bet_id", "user_id": "$.user_id", "game": "$.game",
             "amount": "$.amount", "status": "$.status", "timestamp": "$.timestamp"}
    staged = df.select(
        "value", "timestamp", "partition", "offset", V.isNull().alias("_malformed"),
        F.try_variant_get(V, "$", "struct<" + ", ".join(f"`{k}` string" for k in paths)
                          + ">").alias("_e"),
        *[_kind(p).alias(f"_k_{_slug(p)}") for p in paths.values()])
    e = F.col("_e")
    cols = {
        "bet_id": F.when(_k("$.bet_id") == "STRING", canonical_uuid(e.getField("bet_id"))),
        "user_id": F.when(_k("$.user_id") == "STRING", canonical_uuid(e.getField("user_id"))),
        "game": e.getField("game"),
        "amount": F.when(_k("$.amount") != "BOOLEAN", e.getField("amount").try_cast(MONEY_TYPE)),
        "status": e.getField("status"),
    }
    ts_given = _k("$.timestamp").isNotNull() & (_k("$.timestamp") != "VOID")
    ts = F.when(ts_given, F.when(_k("$.timestamp") == "STRING",
                                 parse_iso_timestamp(e.getField("timestamp")))) \
        .otherwise(F.col("timestamp"))
    checks = [F.when(cols[c].isNull(), F.lit(f"invalid:{c}")) for c in cols]
    checks += [F.when(F.length(cols[c]) > n, F.lit(f"too_long:{c}"))
               for c, n in LEGACY_LIMITS.items()]
    checks.append(F.when(ts.isNull(), F.lit("bad_timestamp:timestamp")))
    reasons = (F.when(F.col("_malformed"), F.array(F.lit("malformed_json")))
                .when(e.isNull(), F.array(F.lit("not_object")))
                .otherwise(_compact(checks)))
    return staged.select(
        *[c.alias(n) for n, c in cols.items()], ts.alias("ts"),
        F.col("timestamp").alias("src_timestamp"), F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"), reasons.alias("reasons"),
        "value", "timestamp", "partition", "offset")


def flatten_legacy_bets(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_legacy_bets(annotate_legacy_bets(records))


def split_legacy_bets(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid legacy rows with version columns, quarantine rows)."""
    ann = observe_ingest(annotated, "wagerflow_legacy_ingest")
    ok = F.size("reasons") == 0
    valid = ann.filter(ok).select(
        "bet_id", "user_id", "game", "amount", "status", F.col("ts").alias("timestamp"),
        F.lit(False).alias("exported"), "src_timestamp", "src_partition", "src_offset")
    bad = ann.filter(~ok).select("value", "reasons", "timestamp", "partition", "offset")
    return valid, bad
