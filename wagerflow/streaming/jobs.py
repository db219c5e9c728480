"""The reference's long-running jobs as named Structured Streaming queries.

Each function takes a record stream (see ``sources.read_records``) and starts
one independently restartable query with its own checkpoint.  The same
operators run in batch through ``wagerflow.plans``.

===================  ======================  =======================
job                  result                  mode / sinks
===================  ======================  =======================
top_games_job        {"game","count"} / 10 s append, event time, Kafka
top_games_ranked_job top-k per closed window foreachBatch, Parquet
bet_status_job       (status, count)         update, console
bet_status_changelog (status, count)/record  foreachBatch + state
avg_bet_job          ("avg_bet", value)      update, console
avg_bet_changelog    ("avg_bet", v)/record   foreachBatch + state
active_users_job     {window, active_users}  append, console+files+Kafka
ingest_job           bets version log        foreachBatch upsert
top_games_rows_job   top_games table rows    append Parquet
game_history_job     (game, count, time)     append Parquet
export_job           date-partitioned files  batch run, idempotent
===================  ======================  =======================
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagerflow.operators import aggregates as agg
from wagerflow.operators import flatten as fl
from wagerflow.operators.upsert import append_versions
from wagerflow.streaming.sinks import (
    BatchWriter, batch_dir_writer, console_writer, fan_out, kafka_writer, named_files_writer, run_id,
    start_stream, table_writer,
)


def top_games_job(records: DataFrame, sink: str = "kafka", *, shape: str = "flat",
                  topic: str = "top_games", path: str | None = None,
                  servers: str | None = None, checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Per-game counts in 10 s event-time windows, 5 s watermark, as JSON."""
    msgs = agg.game_count_messages(agg.game_window_counts(records, shape))
    out = msgs.select("value") if sink in ("kafka", "text") else msgs
    return start_stream(out, "top_games", sink, mode="append", topic=topic, path=path,
                        servers=servers, checkpoint=checkpoint, trigger=trigger)


def top_games_ranked_job(records: DataFrame, path: str, *, k: int = 3,
                         window: str = "1 hour", shape: str = "flat",
                         checkpoint: str | None = None,
                         trigger: dict | None = None) -> StreamingQuery:
    """Top-k games per closed window.  In append mode a window's counts
    arrive once, when the watermark closes it, so ranking inside each
    micro-batch is exact; output under ``path/run=R/batch_id=N``."""
    counts = agg.game_window_counts(records, shape, window=window)

    files = batch_dir_writer(path, "parquet")

    def write(batch: DataFrame, batch_id: int) -> None:
        files(agg.top_games_ranked(batch, k), batch_id)

    return fan_out(counts, "top_games_ranked", [write], mode="append", checkpoint=checkpoint,
                   trigger=trigger)


def bet_status_job(records: DataFrame, sink: str = "console", *, shape: str = "flat",
                   checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Running count per status; one update per changed status per batch."""
    return start_stream(agg.status_counts(records, shape), "bet_status", sink, mode="update",
                        checkpoint=checkpoint, trigger=trigger)


def avg_bet_job(records: DataFrame, sink: str = "console", *, shape: str = "flat",
                checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Running average stake (global aggregate; partial sums per task)."""
    return start_stream(agg.average_bet(records, shape), "avg_bet", sink, mode="update",
                        checkpoint=checkpoint, trigger=trigger)


def bet_status_changelog_job(records: DataFrame, out_root: str, *, shape: str = "flat",
                             checkpoint: str | None = None,
                             trigger: dict | None = None) -> StreamingQuery:
    """``(status, count)`` after every record, exactly as the keyed reduce
    emits it (see ``streaming.changelog``)."""
    from wagerflow.operators.parse import parse_status
    from wagerflow.streaming.changelog import changelog_stream
    prepared = parse_status(records, shape).select(*agg.ARRIVAL, "status", "n")
    return changelog_stream(
        prepared, "bet_status_changelog", out_root, keys=["status"], order=agg.ARRIVAL,
        aggs={"count": ("sum", "n")},
        finish=lambda df: df.select("partition", "offset", "status", "count"),
        checkpoint=checkpoint, trigger=trigger)


def avg_bet_changelog_job(records: DataFrame, out_root: str, *, shape: str = "flat",
                          checkpoint: str | None = None,
                          trigger: dict | None = None) -> StreamingQuery:
    """``("avg_bet", value)`` after every record (global running average)."""
    from wagerflow.operators.parse import parse_amount
    from wagerflow.streaming.changelog import changelog_stream
    prepared = parse_amount(records, shape).select(
        *agg.ARRIVAL, "n", "amount_exact", "amount_inexact",
        ((F.col("n") == 1) & F.col("amount_exact").isNull()).cast("long").alias("_bad"))
    finish = lambda df: df.select(
        "partition", "offset", F.lit(agg.AVG_METRIC).alias("metric"),
        agg._avg_value(F.col("_cn"), F.col("_cs"), F.col("_cf"), F.col("_cb")).alias("value"))
    return changelog_stream(
        prepared, "avg_bet_changelog", out_root, keys=[], order=agg.ARRIVAL,
        aggs={"_cn": ("sum", "n"), "_cs": ("sum", "amount_exact"),
              "_cf": ("sum", "amount_inexact"), "_cb": ("sum", "_bad")},
        finish=finish, checkpoint=checkpoint, trigger=trigger)


def active_users_job(records: DataFrame, *, shape: str = "flat", files: str | None = None,
                     topic: str | None = "active_users_results", servers: str | None = None,
                     console: bool = True, extra: list[BatchWriter] | None = None,
                     time_mode: str = "event", checkpoint: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Active users per 2 min window to console, JSON files and Kafka at once."""
    msgs = agg.active_users_messages(
        agg.active_users(records, shape, time_mode=time_mode)).select("value")
    writers: list[BatchWriter] = []
    if console:
        writers.append(console_writer())
    if files:
        writers.append(named_files_writer(files, "active_users", ".json"))
    if topic:
        writers.append(kafka_writer(topic, servers or "localhost:9092"))
    writers += extra or []
    return fan_out(msgs, "active_users", writers, mode="append", checkpoint=checkpoint,
                   trigger=trigger)


INGEST_COUNTERS = "ingest_counters"


def ingest_job(records: DataFrame, bets_root: str, *, table: str = "bets",
               checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Typed bets: valid rows to the version log, bad rows to quarantine.
    ``table="legacy"`` types flat events into the older 6-column table.

    One parse per record per batch; both outputs are keyed by run and batch
    id, so a replayed batch rewrites exactly what it wrote before.  Each batch's
    ``rows``/``stored``/``rejected`` counts are published as observed metrics
    named ``ingest_counters`` in the query progress.
    """
    quarantine = table_writer(os.path.join(bets_root, "quarantine"))
    annotate, split = ((fl.annotate_legacy_bets, fl.split_legacy_bets) if table == "legacy"
                       else (fl.annotate_bets, fl.split_bets))

    def write(annotated: DataFrame, batch_id: int) -> None:
        valid, bad = split(annotated)
        append_versions(valid, bets_root, batch_id, run_id(annotated))
        quarantine(bad, batch_id)

    # Counters per micro-batch in StreamingQueryProgress.observedMetrics.
    annotated = fl.observe_ingest(annotate(records), INGEST_COUNTERS)
    return fan_out(annotated, "ingest_bets", [write], checkpoint=checkpoint, trigger=trigger)


def top_games_rows_job(records: DataFrame, path: str, *, checkpoint: str | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """One ``top_games`` row per message (append), bad rows to quarantine."""
    rows_w = table_writer(os.path.join(path, "rows"))
    bad_w = table_writer(os.path.join(path, "quarantine"))

    def write(annotated: DataFrame, batch_id: int) -> None:
        rows, bad = fl.split_top_games(annotated)
        rows_w(rows, batch_id)
        bad_w(bad, batch_id)

    # The annotated batch is persisted by fan_out: one parse for both outputs.
    return fan_out(fl.annotate_top_games(records), "top_games_rows", [write],
                   checkpoint=checkpoint, trigger=trigger)


def game_history_job(records: DataFrame, path: str, *, shape: str = "flat",
                     checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """History of per-game window counts, ``event_time`` = window end."""
    hist = agg.game_history(agg.game_window_counts(records, shape))
    return start_stream(hist.withColumn("event_date", F.to_date("event_time")),
                        "top_games_history", "parquet", mode="append", path=path,
                        checkpoint=checkpoint, trigger=trigger, partition_by=["event_date"])


def export_job(spark, bets_root: str, out_root: str, scheduled_time, batch_id: str | None = None,
               layout: str = "current") -> int:
    """The scheduled export (every few minutes upstream): one idempotent run.

    ``scheduled_time`` is the scheduler's logical time, so a retry of the same
    run reuses the batch id and overwrites its own directories.  Returns the
    number of rows exported (0 -> nothing written).
    """
    from wagerflow.operators.export import run_export_once
    return run_export_once(spark, bets_root, out_root, scheduled_time, batch_id, layout)
