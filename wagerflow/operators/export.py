"""Incremental export of not-yet-exported bets to date-partitioned Parquet.

The reference selects ``exported = false`` rows, uploads one file, then flips
the flag per row.  Here ``exported`` is derived from an append-only *ledger*
with the content hash and arrival order of every exported version:

1. a run notes in ``_begun`` which batches of the version log it will read:
   those newer than the last run's (``_upto``: the last batch of every run
   id).  It takes the latest version per bet among them and compares it with
   the bet's last ledger entry (``against_ledger``): newer with other content
   -> pending; newer with equal content (a replayed event) -> only noted in
   the ledger; older -> nothing;
2. ``write_export`` writes the pending rows under ``export_date=YYYY-MM-DD/
   batch_id=B`` (UTC export time) -- a retry of batch B overwrites its own
   directory;
3. ``append_ledger`` records them under ``bucket=K/batch_id=B``, also
   idempotently, and last of all the batches read are noted in ``_upto``.

A run that died in between is finished under its own id, over the batches it
had noted, by its retry or by the next run: no duplicates, no loss.

The ledger is laid out by ``pmod(xxhash64(bet_id), BUCKETS)``; a run reads the
buckets of its new bets only.  Buckets with more than ``FOLD`` entries files
are folded to one entry per bet (``fold_ledger``); since the last entry of a
bet is the greatest in arrival order, a fold that is cut off between writing
and removing leaves the same ledger.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerflow.operators.upsert import (
    KEY, ROW_HASH, RUN_COLUMNS, held, latest_versions, read_versions, with_row_hash,
)
from wagerflow.schemas import VERSION_COLUMNS
from wagerflow.sources.tables import table_exists

# Export file layouts (current 20 columns; legacy 7 columns).
EXPORT_COLUMNS = [
    "bet_id", "user_id", "amount", "currency", "status", "payout", "bet_timestamp",
    "country", "age", "device", "ip_address", "sport", "league", "match", "selection",
    "odds", "source", "session_id", "created_at", "exported",
]
LEGACY_EXPORT_COLUMNS = ["bet_id", "user_id", "game", "amount", "status", "timestamp",
                         "exported"]
MONEY_COLUMNS = {"amount", "payout", "odds"}
# Fixed for the life of a ledger: entries lie where this number puts them.
BUCKETS = 1024
FOLD = 16


def bucket() -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int")


def last_exported(ledger: DataFrame) -> DataFrame:
    """``(bet_id, _hash, _at)``: the last ledger entry of each bet."""
    order = F.struct(*VERSION_COLUMNS)
    return ledger.groupBy(KEY).agg(F.max_by(ROW_HASH, order).alias("_hash"), F.max(order).alias("_at"))


def against_ledger(bets: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Compare each bet's version with its last ledger entry.  Adds ``exported``
    (that entry has this content) and, where the bets carry their arrival
    order, ``newer`` (there is no entry, or this version arrived after it)."""
    bets = (bets if ROW_HASH in bets.columns else with_row_hash(bets)).drop("exported")
    ordered = set(VERSION_COLUMNS) <= set(bets.columns)
    if ledger is None:
        out = bets.withColumn("exported", F.lit(False))
        return out.withColumn("newer", F.lit(True)) if ordered else out
    out = bets.join(last_exported(ledger), KEY, "left") \
        .withColumn("exported", F.coalesce(F.col("_hash") == F.col(ROW_HASH), F.lit(False)))
    if ordered:
        out = out.withColumn("newer", F.col("_at").isNull() | (F.struct(*VERSION_COLUMNS) > F.col("_at")))
    return out.drop("_hash", "_at")


def with_exported(bets: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Derive the ``exported`` flag: the bet's last exported content is its current one."""
    return against_ledger(bets, ledger).drop("newer")


def pending_bets(bets: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Bets whose current content is not the one exported last (``exported =
    false``); where arrival order is known, also not older than that one."""
    compared = against_ledger(bets, ledger).filter(~F.col("exported"))
    return compared.filter("newer").drop("newer") if "newer" in compared.columns else compared


def ledger_rows(bets: DataFrame) -> DataFrame:
    """What the ledger keeps of exported bets."""
    return (bets if ROW_HASH in bets.columns else with_row_hash(bets)) \
        .select(KEY, ROW_HASH, *VERSION_COLUMNS)


def export_counts(bets_with_flag: DataFrame) -> DataFrame:
    """``(exported, bets)`` -- the README's count of exported / pending rows."""
    return bets_with_flag.groupBy("exported").agg(F.count(F.lit(1)).alias("bets"))


def export_projection(bets: DataFrame) -> DataFrame:
    """The 20-column export row: ids as text, money as DOUBLE (NULL kept)."""
    return bets.select(*[F.col(c).cast("double").alias(c) if c in MONEY_COLUMNS else F.col(c)
                         for c in EXPORT_COLUMNS])


def legacy_export_projection(bets: DataFrame) -> DataFrame:
    """The 7-column export row of the older flat table."""
    return bets.select(*[F.col(c).cast("double").alias(c) if c == "amount" else F.col(c)
                         for c in LEGACY_EXPORT_COLUMNS])


def write_export(rows: DataFrame, out_root: str, batch_id: str,
                 export_time: dt.datetime) -> None:
    """Parquet under ``raw/export_date=<UTC date>/batch_id=<id>/``."""
    day = export_time.astimezone(dt.timezone.utc).strftime("%Y-%m-%d") \
        if export_time.tzinfo else export_time.strftime("%Y-%m-%d")
    (rows.withColumn("export_date", F.lit(day)).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("export_date", "batch_id").parquet(os.path.join(out_root, "raw")))


def append_ledger(exported: DataFrame, ledger_root: str, batch_id: str,
                  export_time: dt.datetime) -> None:
    (ledger_rows(exported)
        .withColumn("exported_at", F.lit(export_time).cast("timestamp"))
        .withColumn("bucket", bucket()).withColumn("batch_id", F.lit(batch_id))
        .repartition("bucket")   # one file per bucket touched
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "batch_id").parquet(ledger_root))


def read_ledger(spark: SparkSession, ledger_root: str) -> DataFrame | None:
    """The ledger, or None before the first export.  A ledger that cannot be
    read is an error: without it everything would be exported again."""
    if not table_exists(spark, ledger_root):
        return None
    # batch ids are texts, also where one looks like a number
    return spark.read.parquet(ledger_root).withColumn("batch_id", F.col("batch_id").cast("string"))


def touched(bets: DataFrame) -> list[int]:
    """The ledger buckets of some bets (at most BUCKETS numbers)."""
    return sorted(r.bucket for r in bets.select(bucket().alias("bucket")).distinct().collect())


def fold_ledger(spark: SparkSession, ledger_root: str, keep: str, fold_id: str, most: int = FOLD) -> list[int]:
    """Fold buckets with more than ``most`` batches, batch ``keep`` (the last
    run's, which may be retried) aside, to one entry per bet; returns them."""
    ledger = read_ledger(spark, ledger_root)
    if ledger is None:
        return []
    older = ledger.filter(F.col("batch_id") != keep)
    counts = older.groupBy("bucket").agg(F.count_distinct("batch_id").alias("n")).filter(F.col("n") > most)
    full = sorted(r.bucket for r in counts.collect())
    if not full:
        return []
    listed = {(r.bucket, r.batch_id) for r in older.filter(F.col("bucket").isin(full)).select("bucket", "batch_id").distinct().collect()}
    order = F.struct(*VERSION_COLUMNS)
    entry = F.struct(ROW_HASH, *VERSION_COLUMNS, "exported_at")
    folded = older.filter(F.col("bucket").isin(full)).groupBy("bucket", KEY).agg(F.max_by(entry, order).alias("_e")) \
        .select(KEY, "_e.*", "bucket", F.lit(fold_id).alias("batch_id"))
    folded.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("bucket", "batch_id").parquet(ledger_root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(ledger_root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k, batch in listed - {(k, fold_id) for k in full}:
        fs.delete(path(f"{ledger_root}/bucket={k}/batch_id={batch}"), True)
    return full


def _read_upto(spark: SparkSession, path: str, batch_id: str) -> dict[str, int]:
    """Last batch of every run id that earlier export runs have read."""
    if not table_exists(spark, path):
        return {}
    rows = spark.read.json(path, schema="run string, upto long, batch_id string") \
        .filter(F.col("batch_id") != batch_id).groupBy("run").agg(F.max("upto").alias("upto"))
    return {r["run"]: r["upto"] for r in rows.collect()}   # one row per checkpoint that ever wrote


_BEGUN = "batch_id string, export_time string, layout string, run string, upto long"


def _unfinished(spark: SparkSession, out_root: str, batch_id: str) -> list[tuple[str, dt.datetime, str, dict[str, int]]]:
    """Runs other than ``batch_id`` that were begun and not noted as done."""
    begun, upto = os.path.join(out_root, "_begun"), os.path.join(out_root, "_upto")
    if not table_exists(spark, begun):
        return []
    rows = spark.read.json(begun, schema=_BEGUN).filter(F.col("batch_id") != batch_id)
    if table_exists(spark, upto):
        done = spark.read.json(upto, schema="run string, upto long, batch_id string").select("batch_id").distinct()
        rows = rows.join(done, "batch_id", "left_anti")
    out: dict[str, tuple] = {}
    for r in sorted(rows.collect(), key=lambda r: r.batch_id):   # one row per checkpoint and unfinished run
        out.setdefault(r.batch_id, (r.batch_id, dt.datetime.fromisoformat(r.export_time), r.layout, {}))[3][r.run] = r.upto
    return list(out.values())


def run_export_once(spark: SparkSession, bets_root: str, out_root: str,
                    export_time: dt.datetime, batch_id: str | None = None,
                    layout: str = "current") -> int:
    """One scheduled export run; returns the number of rows exported by it.

    ``batch_id`` defaults to the scheduled time, so a retry of the same run
    rewrites the same directories.  No pending rows -> no files (returns 0).
    An earlier run that died is finished first, under its own id and over the
    batches it had begun with.  ``layout="legacy"`` writes the 7-column rows of
    the older flat table.
    """
    batch_id = batch_id or export_time.strftime("%Y%m%dT%H%M%S")
    for lost in _unfinished(spark, out_root, batch_id):
        _run(spark, bets_root, out_root, *lost)
    versions = read_versions(spark, bets_root)
    now = {r["run"]: r["upto"] for r in
           versions.groupBy("run").agg(F.max("batch_id").alias("upto")).collect()}
    return _run(spark, bets_root, out_root, batch_id, export_time, layout, now)


def _run(spark: SparkSession, bets_root: str, out_root: str, batch_id: str, export_time: dt.datetime,
         layout: str, now: dict[str, int]) -> int:
    ledger_root, upto_root = os.path.join(out_root, "_ledger"), os.path.join(out_root, "_upto")
    upto = _read_upto(spark, upto_root, batch_id)
    new = [(r, b) for r, b in now.items() if b > upto.get(r, -1)]
    if not new:
        return 0
    spark.createDataFrame([(batch_id, export_time.isoformat(), layout, r, b) for r, b in new], _BEGUN) \
        .coalesce(1).write.mode("append").json(os.path.join(out_root, "_begun"))
    # A fixed set of immutable batches: recomputing a lost part gives the same rows.
    fresh = read_versions(spark, bets_root).filter(held(now) & ~held(upto)).drop(*RUN_COLUMNS)
    latest = latest_versions(fresh).persist()
    try:
        ledger = read_ledger(spark, ledger_root)
        if ledger is not None:
            ledger = ledger.filter(F.col("bucket").isin(touched(latest)) & (F.col("batch_id") != batch_id))
        noted = against_ledger(latest, ledger).filter("newer").drop("newer").persist()
        try:
            pending = noted.filter(~F.col("exported"))
            n = pending.count()
            if n:
                project = legacy_export_projection if layout == "legacy" else export_projection
                write_export(project(pending), out_root, batch_id, export_time)
            if not noted.isEmpty():
                append_ledger(noted, ledger_root, batch_id, export_time)
        finally:
            noted.unpersist()
    finally:
        latest.unpersist()
    spark.createDataFrame([(r, b, batch_id) for r, b in new], "run string, upto long, batch_id string") \
        .coalesce(1).write.mode("append").json(upto_root)
    fold_ledger(spark, ledger_root, batch_id, f"fold-{batch_id}")
    return n
