"""Stream sinks: one result stream to one or many targets.

Single sinks use Spark's own writers (Kafka, file formats, console, memory)
with a checkpoint per named query.  ``fan_out`` sends each micro-batch to
several targets through ``foreachBatch``.  File writers are keyed by run and
batch id (a replayed batch overwrites its own output), so a restart after a
crash leaves every row once; Kafka and the console get a replayed batch again
(at least once).  The run is the query's id, which lives in its checkpoint: a
new checkpoint counts batches from 0 again, in directories of its own.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagerflow.session import checkpoint_path

BatchWriter = Callable[[DataFrame, int], None]


def run_id(batch: DataFrame) -> str:
    """Id of the streaming query that delivers ``batch`` ("batch" outside one)."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _writer(df: DataFrame, name: str, mode: str, checkpoint: str | None,
            trigger: dict | None):
    w = (df.writeStream.queryName(name).outputMode(mode)
         .option("checkpointLocation",
                 checkpoint or checkpoint_path(df.sparkSession, "streams", name)))
    if trigger:
        w = w.trigger(**trigger)
    return w


def start_stream(df: DataFrame, name: str, sink: str = "console", *, mode: str = "append",
                 path: str | None = None, topic: str | None = None,
                 servers: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None, partition_by: list[str] | None = None,
                 options: dict[str, str] | None = None) -> StreamingQuery:
    """Start ``df`` as the named query ``name`` into one sink.

    ``sink``: ``kafka`` (needs a ``value`` column; ``topic``, ``servers``),
    ``json``/``parquet``/``text`` (``path``), ``console`` (every row, as one
    JSON line) or ``memory`` (all rows on the driver: tests only).
    """
    if sink == "console":
        return fan_out(df, name, [console_writer()], mode=mode, checkpoint=checkpoint, trigger=trigger)
    w = _writer(df, name, mode, checkpoint, trigger)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if sink == "kafka":
        w = (w.format("kafka").option("kafka.bootstrap.servers", servers or "localhost:9092")
              .option("topic", topic or name))
        return w.start()
    if sink in ("json", "parquet", "text", "csv"):
        if path is None:
            raise ValueError(f"sink {sink!r} needs a path")
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format(sink).start(path)
    if sink == "memory":
        return w.format("memory").start()
    raise ValueError(f"unknown sink {sink!r}")


def fan_out(df: DataFrame, name: str, writers: list[BatchWriter], *, mode: str = "append",
            checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Deliver every micro-batch to all ``writers`` (computed once, cached
    for the duration of the batch)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()
    return _writer(df, name, mode, checkpoint, trigger).foreachBatch(each).start()


# --- idempotent batch writers -----------------------------------------------

def batch_dir_writer(path: str, fmt: str = "json", prefix: str = "batch_id") -> BatchWriter:
    """Files under ``path/run=<run>/<prefix>=<id>/`` (overwritten on replay)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(
            os.path.join(path, f"run={run_id(df)}", f"{prefix}={batch_id}"))
    return write


def named_files_writer(path: str, prefix: str, suffix: str, fmt: str = "text") -> BatchWriter:
    """Files ``path/<prefix>-<run>-<batch>-<n><suffix>``: written aside by the
    executors, then renamed one by one.  A replayed batch first removes the
    names that it gave before; nothing is left in the staging folder."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        name = f"{prefix}-{run_id(df)}-{int(batch_id)}"
        staging = f"{path}/_staging/{name}"
        df.write.mode("overwrite").format(fmt).save(staging)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for old in fs.globStatus(hadoop(f"{path}/{name}-*{suffix}")) or []:
            fs.delete(old.getPath(), False)
        parts = sorted((f.getPath() for f in fs.globStatus(hadoop(f"{staging}/part-*")) or [] if f.getLen()),
                       key=lambda f: f.getName())   # one per task that wrote rows
        for n, part in enumerate(parts):
            if not fs.rename(part, hadoop(f"{path}/{name}-{n:05d}{suffix}")):
                raise OSError(f"{part} could not be renamed")
        fs.delete(hadoop(staging), True)
        if not fs.listStatus(hadoop(f"{path}/_staging")):   # others may be writing
            fs.delete(hadoop(f"{path}/_staging"), False)
    return write


def kafka_writer(topic: str, servers: str = "localhost:9092") -> BatchWriter:
    """Kafka topic (at-least-once on replay; Kafka has no overwrite)."""
    def write(df: DataFrame, batch_id: int) -> None:
        (df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("topic", topic).save())
    return write


def console_writer() -> BatchWriter:
    """Every row of the batch as a JSON line; one partition at a time is on the driver."""
    def write(df: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
        for row in lines.toLocalIterator():
            print(row.line)
    return write


def table_writer(path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> BatchWriter:
    """Append-style table whose files for batch N of run R live in ``run=R/batch_id=N``."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = df.withColumn("run", F.lit(run_id(df))).withColumn("batch_id", F.lit(int(batch_id)))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*(partition_by or []), "run", "batch_id").format(fmt).save(path))
    return write
