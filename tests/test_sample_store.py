"""Sample store: selectors through the dictionary, partition pruning, replay, retention."""

import datetime as dt
import os

from pyspark.sql import functions as F

from wagerflow.operators import alerts as al
from wagerflow.operators import metrics as M
from wagerflow.sources.samples import SampleStore

from test_metrics import T0, samples


def rows(day, value):
    at = 86400 * day
    return [("cpu", {"name": "a", "host": "h1"}, at, value), ("cpu", {"name": "b"}, at + 60, value + 1), ("cpu", {}, at + 90, value + 2),
            ("mem", {"name": "a"}, at + 5, 10 * value)]


def got(df):
    return sorted((r.labels.get("name", ""), int((r.ts - T0).total_seconds()), r.value) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selectors_equal_those_over_samples(spark, workdir):
    store, all_rows = SampleStore(spark, os.path.join(workdir, "s")), []
    for day in range(3):
        store.append(samples(spark, rows(day, day)), f"b{day}")
        all_rows += rows(day, day)
    df = samples(spark, all_rows)
    for equal, unequal in (({}, {}), ({"name": "a"}, {}), ({"host": ""}, {}), ({}, {"name": ""}), ({"name": "a"}, {"host": ""}), ({"name": "zz"}, {})):
        assert got(M.select_series(store, "cpu", equal, unequal)) == got(M.select_series(df, "cpu", equal, unequal))
    assert got(M.select_series(store, "none")) == []
    assert spark.read.parquet(os.path.join(workdir, "s", "series")).count() == 4   # every label set once


def test_only_the_metric_and_the_days_are_read(spark, workdir):
    store = SampleStore(spark, os.path.join(workdir, "s"))
    for day in range(4):
        store.append(samples(spark, rows(day, day)), f"b{day}")
    df = store.select_series("cpu", {"name": "a"}, start=T0 + dt.timedelta(days=1), stop=T0 + dt.timedelta(days=2, seconds=30))
    assert got(df) == [("a", 86400, 1.0), ("a", 172800, 2.0)]
    scan, *_ = [x for x in plan(df).splitlines() if "series_id" in x and "FileScan" in x and "ts#" in x]
    pruned = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "= cpu)" in pruned and "(day#" in pruned


def test_a_batch_written_again_changes_nothing(spark, workdir):
    store = SampleStore(spark, os.path.join(workdir, "s"))
    for batch in ("b0", "b1", "b0", "b1"):
        store.append(samples(spark, rows(int(batch[1]), 5)), batch)
    assert len(got(M.select_series(store, "cpu"))) == 6
    assert store.series("cpu").count() == 3


def test_retention(spark, workdir):
    store = SampleStore(spark, os.path.join(workdir, "s"))
    for day in range(3):
        store.append(samples(spark, rows(day, day)), f"b{day}")
    assert store.days() == [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assert store.expire(dt.date(2024, 1, 3)) == 4   # two metrics, two days
    assert store.days() == [dt.date(2024, 1, 3)] and len(got(M.select_series(store, "cpu"))) == 3


def test_empty_and_null_samples(spark, workdir):
    store = SampleStore(spark, os.path.join(workdir, "s"))
    assert got(M.select_series(store, "cpu")) == [] and store.days() == []
    df = samples(spark, [("cpu", {"name": "a"}, 0, 1), ("cpu", {"name": "a"}, 30, 2), ("cpu", {"name": "n"}, 60, 3)])
    df = df.withColumn("ts", F.when(F.col("value") != 2, F.col("ts"))) \
        .withColumn("labels", F.when(F.col("value") != 3, F.col("labels"))).withColumn("value", F.col("value"))
    store.append(df, "b")
    assert got(M.select_series(store, "cpu")) == [("", 60, 3.0), ("a", 0, 1.0)]


def test_rules_over_a_store(spark, workdir):
    data = [("container_memory_usage_bytes", {"name": "a"}, 15 * k, 95) for k in range(60)] + \
           [("container_spec_memory_limit_bytes", {"name": "a"}, 15 * k, 100) for k in range(60)]
    store = SampleStore(spark, os.path.join(workdir, "s"))
    store.append(samples(spark, data), "b")
    over = lambda s: sorted((r.alert, r.active_since, r.last_true, r.summary) for r in al.evaluate_rules(s).collect())
    assert over(store) == over(samples(spark, data)) and len(over(store)) == 1
