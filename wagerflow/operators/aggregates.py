"""The stream jobs' aggregates as DataFrame functions (batch and streaming).

* ``game_window_counts``  per-game count in 10 s tumbling event-time windows
* ``status_counts``        running count per status (final state / stream update)
* ``status_changelog``     the value emitted after every record (batch; on a
                           stream see ``streaming.changelog``)
* ``average_bet``          running average stake (final state / stream update)
* ``average_changelog``    the average emitted after every record (batch)
* ``active_users``         distinct users per 2 min window (two keyed stages)
* ``top_games_ranked``     top-k games per window (documented, not coded upstream)

Record order (arrival) is ``(timestamp, partition, offset)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerflow.operators.ordered import prefix_aggregate
from wagerflow.operators.parse import (
    INVALID, parse_amount, parse_bet, parse_status, parse_user,
)

ARRIVAL = ["timestamp", "partition", "offset"]
AVG_METRIC = "avg_bet"


def _watermarked(df: DataFrame, col: str, delay: str | None) -> DataFrame:
    return df.withWatermark(col, delay) if (df.isStreaming and delay) else df


def _window_cols(w: str = "w") -> list[Column]:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def game_window_counts(records: DataFrame, shape: str = "flat", window: str = "10 seconds",
                       watermark: str | None = "5 seconds") -> DataFrame:
    """``(window_start, window_end, game, count)``.

    Bad records count under ``'invalid'`` with 0, exactly like the reference's
    keyed reduce.  On a stream the watermark (default 5 s bounded
    out-of-orderness) closes windows and drops later rows.
    """
    df = _watermarked(parse_bet(records, shape), "event_time", watermark)
    agg = df.groupBy(F.window("event_time", window).alias("w"), "game") \
            .agg(F.sum("n").alias("count"))
    return agg.select(*_window_cols(), "game", "count")


def game_count_messages(counts: DataFrame) -> DataFrame:
    """Sink payload ``{"game": ..., "count": ...}`` per window and game."""
    payload = F.to_json(F.struct("game", "count"), {"ignoreNullFields": "false"})
    return counts.select("window_start", "window_end", payload.alias("value"))


def top_games_ranked(counts: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` games per window by count (ties: game name).

    ``row_number() <= k`` is planned with a map-side group limit, so a window
    with many games never ships more than k rows per map task.
    """
    w = Window.partitionBy("window_start", "window_end") \
        .orderBy(F.col("count").desc(), F.col("game").asc_nulls_last())
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= k))


def game_history(counts: DataFrame) -> DataFrame:
    """History rows ``(game, count, event_time)``; the time is the window's end."""
    return counts.select("game", "count", F.col("window_end").alias("event_time"))


def status_counts(records: DataFrame, shape: str = "flat") -> DataFrame:
    """``(status, count)``: current running count per status."""
    return parse_status(records, shape).groupBy("status").agg(F.sum("n").alias("count"))


def status_changelog(records: DataFrame, shape: str = "flat",
                     n_buckets: int | None = None, materialize: bool = False) -> DataFrame:
    """One row per record: the ``(status, count)`` the keyed reduce emits
    after that record.  Skew-safe (see ``operators.ordered``).  The parse is
    evaluated by both branches of the bucketed running sum; ``materialize``
    checkpoints the narrow parsed input instead (worth it only when parsing
    costs more than writing and re-reading the narrow rows)."""
    df = parse_status(records, shape).select(*ARRIVAL, "status", "n")
    out = prefix_aggregate(df, ["status"], ARRIVAL, {"count": ("sum", "n")},
                           n_buckets=n_buckets, materialize=materialize)
    return out.select("partition", "offset", "status", "count")


def _avg_value(n: Column, exact: Column, inexact: Column, n_inexact: Column) -> Column:
    """sum/n if n > 0 else 0.  Finite stakes are summed exactly (DECIMAL), so
    the result does not depend on partitioning; NaN/inf stakes propagate."""
    s = F.coalesce(exact, F.lit(0)).cast("double")
    total = F.when(F.coalesce(n_inexact, F.lit(0)) > 0, s + inexact).otherwise(s)
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def average_bet(records: DataFrame, shape: str = "flat") -> DataFrame:
    """``(metric='avg_bet', value, n)``: running average stake, current state."""
    df = parse_amount(records, shape)
    agg = df.agg(F.sum("n").alias("n"), F.sum("amount_exact").alias("_s"),
                 F.sum("amount_inexact").alias("_f"),
                 F.count(F.when((F.col("n") == 1) & F.col("amount_exact").isNull(), 1))
                 .alias("_b"))
    return agg.select(F.lit(AVG_METRIC).alias("metric"),
                      _avg_value(F.col("n"), F.col("_s"), F.col("_f"), F.col("_b"))
                      .alias("value"),
                      F.col("n"))


def average_changelog(records: DataFrame, shape: str = "flat",
                      n_buckets: int | None = None, materialize: bool = False) -> DataFrame:
    """One row per record: the average emitted after it.  A global running
    aggregate, computed without funnelling all rows through one task."""
    df = parse_amount(records, shape).select(
        *ARRIVAL, "n", "amount_exact", "amount_inexact",
        ((F.col("n") == 1) & F.col("amount_exact").isNull()).cast("long").alias("_bad"))
    out = prefix_aggregate(df, [], ARRIVAL, {
        "_cn": ("sum", "n"), "_cs": ("sum", "amount_exact"),
        "_cf": ("sum", "amount_inexact"), "_cb": ("sum", "_bad")}, n_buckets=n_buckets,
        materialize=materialize)
    return out.select("partition", "offset", F.lit(AVG_METRIC).alias("metric"),
                      _avg_value(F.col("_cn"), F.col("_cs"), F.col("_cf"), F.col("_cb"))
                      .alias("value"))


def _clock(spark, user_type: T.DataType) -> DataFrame:
    """A row per second that moves the watermark on: bad rows of no user, which
    the first stage drops like any other.  Their user is nullable as a parsed
    one is: a batch of ticks alone reads the same state."""
    user = F.when(F.col("value") >= 0, F.lit(INVALID).cast(user_type))
    return spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load().select(
        user.alias("user_id"), F.lit(0).alias("n"), F.current_timestamp().alias("event_time"))


def active_users(records: DataFrame, shape: str = "flat", window: str = "2 minutes",
                 watermark: str | None = "5 seconds", time_mode: str = "event") -> DataFrame:
    """``(window_start, window_end, active_users)``.

    Stage 1 reduces per (window, user); stage 2 counts users per window -- the
    reference's two keyed windows.  Unlike ``count(DISTINCT)``, a JSON-null
    user is one user, as in the reference.  Users literally named
    ``'invalid'`` are dropped with the bad rows (null-safe comparison keeps
    the NULL user).  ``time_mode='processing'`` windows by ingestion time; on
    a stream a clock closes them, also when no further record comes.
    """
    df = parse_user(records, shape)
    if time_mode == "processing":
        df = df.withColumn("event_time", F.current_timestamp())
        if df.isStreaming:
            df = df.select("user_id", "n", "event_time").unionByName(_clock(df.sparkSession, df.schema["user_id"].dataType))
    df = _watermarked(df, "event_time", watermark)
    # The 'invalid' group is tagged inside stage 1 and removed after it: a
    # filter on the parsed key itself would be pushed below the parse and
    # evaluate it again.
    per_user = df.groupBy(F.window("event_time", window).alias("w"), "user_id") \
                 .agg(F.sum("n").alias("n"),
                      F.max(F.col("user_id").eqNullSafe(F.lit(INVALID))).alias("_invalid"))
    per_window = per_user.filter(~F.col("_invalid")) \
                         .groupBy("w").agg(F.count(F.lit(1)).alias("active_users"))
    return per_window.select(*_window_cols(), "active_users")


def active_users_messages(active: DataFrame, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> DataFrame:
    """Sink payload ``{"window_start", "window_end", "active_users"}`` (ISO)."""
    rec = F.struct(F.date_format("window_start", fmt).alias("window_start"),
                   F.date_format("window_end", fmt).alias("window_end"),
                   F.col("active_users"))
    return active.select("window_start", F.to_json(rec).alias("value"))
