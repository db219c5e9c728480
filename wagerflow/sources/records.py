"""Record sources for batch and Structured Streaming.

A record is ``value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT``
-- the columns a Kafka source exposes.  Kafka is the production source; a
directory of record files (Parquet/JSON with those columns, or plain text
lines) is the stand-in when no broker is reachable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerflow.schemas import RECORD


# Records that one micro-batch takes from the topic at most; the rest waits for
# the next batch (a first batch from "earliest" would be the whole backlog).
MAX_OFFSETS_PER_TRIGGER = 10_000_000


def _kafka(spark: SparkSession, topic: str, servers: str, streaming: bool,
           starting: str, options: dict[str, str]) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if not streaming:
        r = r.option("endingOffsets", "latest")
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"))


def read_records(spark: SparkSession, path: str | None = None, *, fmt: str = "parquet",
                 streaming: bool = False, topic: str | None = None,
                 servers: str | None = None, starting: str = "earliest",
                 max_files_per_trigger: int | None = None,
                 max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
                 options: dict[str, str] | None = None) -> DataFrame:
    """Read bet records.

    ``fmt="kafka"`` subscribes to ``topic`` (earliest by default; the consumer
    group of the reference is replaced by the query checkpoint).  File formats
    read ``path`` with the fixed record schema; ``fmt="text"`` reads one JSON
    line per row and derives position columns from the file.
    """
    options = dict(options or {})
    if fmt == "kafka":
        if streaming and max_offsets_per_trigger:
            options.setdefault("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return _kafka(spark, topic or "bets", servers or "localhost:9092",
                      streaming, starting, options)
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "text":
        df = reader.format("text").load(path)
        return records_from_lines(df)
    return reader.format(fmt).schema(RECORD).load(path).select(*RECORD.fieldNames())


def records_from_lines(lines: DataFrame) -> DataFrame:
    """Turn raw text lines into records.

    The file modification time is the record time and the partition a hash of
    the file name; the offset is Spark's row id, which is stable for the same
    files and split size, so (timestamp, partition, offset) is a total order.
    """
    meta = F.col("_metadata")
    return lines.select(
        F.col("value"),
        meta.getField("file_modification_time").alias("timestamp"),
        F.pmod(F.xxhash64(meta.getField("file_path")), F.lit(2147483647)).cast("int")
        .alias("partition"),
        (F.monotonically_increasing_id()).alias("offset"))


def write_records(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Persist records (the Kafka stand-in's producer side)."""
    df.select(*RECORD.fieldNames()).write.mode(mode).format(fmt).save(path)
