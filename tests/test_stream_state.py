"""Windows that the clock closes, and the state that a running count keeps."""

import json
import os
import time

from pyspark.sql import functions as F

from test_streaming import _push
from wagerflow.operators import aggregates as agg
from wagerflow.session import checkpoint_path
from wagerflow.sources.records import read_records
from wagerflow.streaming.sinks import batch_dir_writer, fan_out, start_stream


def _records(spark, values, first):
    return spark.createDataFrame([(json.dumps(v), None, 0, first + i) for i, v in enumerate(values)],
                                 "value string, timestamp timestamp, partition int, offset long")


def test_processing_time_windows_close_without_further_records(spark, workdir):
    src = os.path.join(workdir, "src")
    users = ["a", "b", "a", None, "invalid", "c"]
    _push(_records(spark, [{"user_id": u} for u in users] + [{"x": 1}], 0), src, "b1")
    active = agg.active_users(read_records(spark, src, streaming=True), window="3 seconds", watermark="1 second", time_mode="processing")
    out = os.path.join(workdir, "out")
    q = start_stream(active, "clocked", "json", mode="append", path=out,
                     checkpoint=checkpoint_path(spark, "t", os.path.basename(workdir), "clock"))
    try:
        rows, until = [], time.time() + 150
        while not rows and time.time() < until:   # nothing more is pushed
            time.sleep(2)
            assert q.exception() is None
            rows = spark.read.schema("window_start timestamp, window_end timestamp, active_users long").json(out).collect() \
                if os.path.isdir(out) else []
    finally:
        q.stop()
    assert [r.active_users for r in rows] == [4]   # a, b, c and the null user; windows of ticks alone give none
    assert (rows[0].window_end - rows[0].window_start).total_seconds() == 3


def test_state_of_the_running_count(spark, workdir):
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    ck = checkpoint_path(spark, "t", os.path.basename(workdir), "status")

    def run():
        q = fan_out(agg.status_counts(read_records(spark, src, streaming=True)), "status_state", [batch_dir_writer(out)],
                    mode="update", checkpoint=ck)
        q.processAllAvailable()
        q.stop()
    batches = [["win", "win", "lose", None], ["win", "x"], ["lose"]]
    for k, statuses in enumerate(batches):   # a restart before every batch
        _push(_records(spark, [{"status": s} for s in statuses] + [{"y": 0}], 10 * k), src, f"b{k}")
        run()
    state = spark.read.format("statestore").load(ck).select("key.status", F.col("value.*"))
    rows = state.collect()
    assert len(rows) == len({r.status for r in rows})   # one row per status, whatever the number of records and batches
    batch = {r.status: r["count"] for r in agg.status_counts(read_records(spark, src)).collect()}
    assert {r.status: r[1] for r in rows} == batch == {"win": 3, "lose": 2, "x": 1, None: 1, "invalid": 0}


def test_named_files_and_replay(spark, workdir):
    from wagerflow.streaming.sinks import named_files_writer
    out = os.path.join(workdir, "named")
    write = named_files_writer(out, "active_users", ".json")
    lines = lambda *v: spark.createDataFrame([(x,) for x in v], "value string").repartition(len(v))
    write(lines("a", "b", "c"), 0)
    write(lines("d"), 1)
    first = sorted(f for f in os.listdir(out) if not f.startswith("."))
    write(lines("a", "b", "c"), 0)   # the batch is replayed
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == first
    assert all(f.startswith("active_users-") and f.endswith(".json") for f in first)   # no staging folder either
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a", "b", "c", "d"]
    write(lines("e").filter("false"), 2)
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == first
