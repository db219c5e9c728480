"""Last-write-wins upsert without a table format.

The reference merges each event into a keyed table and commits per message.
Here the table is an append-only *version log* plus a derived current view:

* ``append_versions`` writes one micro-batch to ``versions/run=R/batch_id=N``.
  The run is the streaming query's id, which lives in its checkpoint: a replay
  of batch N overwrites only its own directory, and a run with a new
  checkpoint (whose batches count from 0 again) adds to the log;
* ``latest_versions`` picks, per key, the version that arrived last
  (``(src_timestamp, src_partition, src_offset)`` is a total order) with a
  ``max_by`` aggregate -- partial aggregation on the map side, so a key that
  holds a third of all versions still ships one row per map task;
* ``compact`` writes the current view as a snapshot directory and then, beside
  it, the last batch of every run that it folded in; readers take the newest
  snapshot that has this list, and the batches that are not on it.  Nothing
  is overwritten in place, so a crash never loses the only copy.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerflow.schemas import VERSION_COLUMNS
from wagerflow.sources.tables import table_exists

KEY = "bet_id"
ROW_HASH = "row_hash"
# A version's *content* is every column except its arrival coordinates, the
# derived flag and the raw text; a replayed identical event keeps its hash and
# is not exported again.


RUN_COLUMNS = ["run", "batch_id"]
NON_CONTENT = set(VERSION_COLUMNS) | {"exported", "raw_event", ROW_HASH, *RUN_COLUMNS}


def content_columns(df: DataFrame) -> list[str]:
    """The columns that define a version's content (any table layout)."""
    return [c for c in df.columns if c not in NON_CONTENT]


def row_hash(columns: list[Column]) -> Column:
    """Hash of values and of which of them are NULL (``xxhash64`` skips NULLs,
    so a value that moves to the next column would keep its hash)."""
    return F.xxhash64(*[x for c in columns for x in (c.isNull(), c)])


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, row_hash([F.col(c) for c in content_columns(df)]))


def latest_versions(df: DataFrame, key: str | list[str] = KEY,
                    order: list[str] | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """One row per key: the version with the greatest ``order`` tuple.

    ``columns`` names what to carry besides the key (default: all); only they
    and the order go through the aggregate and its shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    order = order or VERSION_COLUMNS
    rest = [c for c in columns or df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]),
                 F.struct(*[F.col(c) for c in order])).alias("_latest"))
    return picked.select(*keys, *[F.col("_latest").getField(c).alias(c) for c in rest])


def append_versions(valid: DataFrame, root: str, batch_id: int, run: str = "batch") -> None:
    """Write one batch of typed bet versions (idempotent per run and batch)."""
    (with_row_hash(valid).withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RUN_COLUMNS).parquet(os.path.join(root, "versions")))


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    # run ids are texts, also where one looks like a number
    return spark.read.parquet(os.path.join(root, "versions")).withColumn("run", F.col("run").cast("string"))


def _snapshot(spark: SparkSession, root: str) -> tuple[str, dict[str, int]] | None:
    """Path of the newest complete snapshot and the last batch it holds of each
    run (one row per checkpoint that ever wrote to the table)."""
    folded = os.path.join(root, "_folded")
    if not table_exists(spark, folded):
        return None
    rows = spark.read.json(folded, schema="snapshot string, seq long, run string, upto long")
    last = rows.agg(F.max("seq")).first()[0]
    rows = rows.filter(F.col("seq") == last).collect()
    return rows[0]["snapshot"], {r["run"]: r["upto"] for r in rows}


def held(upto: dict[str, int]) -> Column:
    """Batches up to the last one of each run (a filter on partition columns)."""
    held = F.lit(False)
    for run, batch in upto.items():
        held = held | ((F.col("run") == run) & (F.col("batch_id") <= batch))
    return held


def current_bets(spark: SparkSession, root: str) -> DataFrame:
    """The bets table: latest version per ``bet_id`` (snapshot + newer batches)."""
    versions = read_versions(spark, root)
    snapshot = _snapshot(spark, root)
    if snapshot is None:
        return latest_versions(versions.drop(*RUN_COLUMNS))
    path, upto = snapshot
    return latest_versions(spark.read.parquet(path)
                           .unionByName(versions.filter(~held(upto)).drop(*RUN_COLUMNS)))


def compact(spark: SparkSession, root: str, snapshot_id: str) -> str:
    """Materialise the current view (cuts lineage), then list what it holds."""
    upto = {r["run"]: int(r["upto"]) for r in read_versions(spark, root).groupBy("run")
            .agg(F.max("batch_id").alias("upto")).collect()}
    if not upto:
        raise ValueError("nothing to compact")
    path = os.path.join(root, "snapshots", snapshot_id)
    before = _snapshot(spark, root)
    if before is not None and before[0] == path:
        raise ValueError(f"snapshot {snapshot_id!r} is in use")
    # only the batches listed above: one that arrives meanwhile stays newer
    listed = read_versions(spark, root).filter(held(upto))
    if before is None:
        current = latest_versions(listed.drop(*RUN_COLUMNS))
    else:
        current = latest_versions(spark.read.parquet(before[0]).unionByName(
            listed.filter(~held(before[1])).drop(*RUN_COLUMNS)))
    current.write.mode("overwrite").parquet(path)
    folded = os.path.join(root, "_folded")
    seq = 1 if before is None else 1 + spark.read.json(folded).agg(F.max("seq")).first()[0]
    spark.createDataFrame([(path, seq, r, b) for r, b in upto.items()],
                          "snapshot string, seq long, run string, upto long") \
        .coalesce(1).write.mode("append").json(folded)
    return path

