"""Store of metric samples: a series dictionary, and values by metric and day.

``series/metric=M/batch=B`` holds each label set once with its id;
``values/metric=M/day=D/batch=B`` holds ``(series_id, ts, value)``.  A selector
is resolved on the dictionary of its metric, and only that metric's partitions
of the wanted days are read; label maps are not stored per sample.  A batch
that is written again overwrites its own partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerflow.sources.tables import table_exists

SERIES_SCHEMA = "series_id string, series array<struct<key: string, value: string>>, metric string, batch string"
VALUES_SCHEMA = "series_id string, ts timestamp, value double, metric string, day date, batch string"


class SampleStore:
    """Samples under ``root``; ``select_series`` takes the place of a selector
    over a samples DataFrame (``metrics.select_series`` accepts a store)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not table_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def append(self, samples: DataFrame, batch: str) -> None:
        """Add samples ``(metric, labels, ts, value)``; the dictionary gets the
        series that no other batch has entered."""
        labels = F.array_sort(F.map_entries(F.coalesce("labels", F.create_map().cast("map<string,string>"))))
        rows = samples.select("metric", labels.alias("series"), "ts", "value") \
            .withColumn("series_id", F.md5(F.to_json("series")))
        (rows.filter(F.col("ts").isNotNull() & F.col("metric").isNotNull())
             .select("series_id", "ts", "value", "metric", F.to_date("ts").alias("day"), F.lit(batch).alias("batch"))
             .hint("rebalance", "metric", "day")   # one file per metric and day, several for a large one
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("metric", "day", "batch").parquet(f"{self.root}/values"))
        known = self._read("series", SERIES_SCHEMA).filter(F.col("batch") != batch).select("metric", "series_id")
        (rows.filter(F.col("metric").isNotNull()).groupBy("metric", "series_id").agg(F.min("series").alias("series"))
             .join(known, ["metric", "series_id"], "left_anti")
             .select("series_id", "series", "metric", F.lit(batch).alias("batch"))
             .hint("rebalance", "metric")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("metric", "batch").parquet(f"{self.root}/series"))

    def series(self, metric: str, equal: dict[str, str] | None = None,
               not_equal: dict[str, str] | None = None) -> DataFrame:
        """``series_id, series`` of a selector, from the metric's dictionary.  A
        missing label equals the empty string."""
        labels = F.map_from_entries("series")
        found = self._read("series", SERIES_SCHEMA).filter(F.col("metric") == metric)
        for k, v in (equal or {}).items():
            found = found.filter(F.coalesce(labels.getItem(k), F.lit("")) == v)
        for k, v in (not_equal or {}).items():
            found = found.filter(F.coalesce(labels.getItem(k), F.lit("")) != v)
        return found.groupBy("series_id").agg(F.min("series").alias("series"))

    def select_series(self, metric: str, equal: dict[str, str] | None = None, not_equal: dict[str, str] | None = None,
                      start: dt.datetime | None = None, stop: dt.datetime | None = None) -> DataFrame:
        """Samples ``(metric, labels, ts, value, series)`` of ``metric{...}`` in
        ``[start, stop)``: partitions of other metrics and days are not read."""
        values = self._read("values", VALUES_SCHEMA).filter(F.col("metric") == metric)
        if start is not None:
            values = values.filter((F.col("day") >= F.lit(start.date())) & (F.col("ts") >= F.lit(start).cast("timestamp")))
        if stop is not None:
            values = values.filter((F.col("day") <= F.lit(stop.date())) & (F.col("ts") < F.lit(stop).cast("timestamp")))
        return values.join(self.series(metric, equal, not_equal), "series_id").select(
            "metric", F.map_from_entries("series").alias("labels"), "ts", "value", "series")

    def days(self) -> list[dt.date]:
        """The days that have samples (one row per day)."""
        return sorted(r.day for r in self._read("values", VALUES_SCHEMA).select("day").distinct().collect())

    def expire(self, before: dt.date) -> int:
        """Retention: remove the partitions of days before ``before``; returns
        how many."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/values/metric=*/day=*")
        fs = pattern.getFileSystem(conf)
        gone = 0
        for status in fs.globStatus(pattern) or []:
            day = status.getPath().getName().split("=", 1)[1]
            if day < before.isoformat() and fs.delete(status.getPath(), True):
                gone += 1
        return gone
