"""Metric operators on F7-style fixtures (resets, gaps, labels, /0, for)."""

import datetime as dt
import math

import pytest

from pyspark.sql import functions as F

from wagerflow.operators import alerts as al
from wagerflow.operators import metrics as M

T0 = dt.datetime(2024, 1, 1)


def samples(spark, rows):
    """rows: (metric, {labels}, seconds after T0, value)."""
    data = [(m, lab, (T0 + dt.timedelta(seconds=s)).isoformat(sep=" "), float(v))
            for m, lab, s, v in rows]
    df = spark.createDataFrame(data, "metric string, labels map<string,string>, t string, value double")
    return df.select("metric", "labels", F.col("t").cast("timestamp").alias("ts"), "value")


def _vals(df, *labels):
    return sorted((tuple(M.label(l) for l in []) or ()) + (r.window_start.strftime("%H:%M"),
                  *[r.labels.get(l, "") for l in labels], r.value) for r in df.collect())


def test_increase_handles_resets_and_gaps(spark):
    c = [("c", {"job": "a"}, s, v) for s, v in
         [(0, 10), (60, 20), (120, 5), (180, 15), (3600 + 60, 25)]]  # reset at 120, gap
    inc = M.increase(samples(spark, c), "5 minutes")
    got = sorted((r.window_start.strftime("%H:%M"), r.value) for r in inc.collect())
    # 0->10: first sample 0; +10; reset -> +5; +10; after the gap +10 into 01:00
    assert got == [("00:00", 25.0), ("01:00", 10.0)]
    rate = M.rate(samples(spark, c), "5 minutes").collect()
    assert sorted(r.value for r in rate) == [10.0 / 300, 25.0 / 300]


def test_sliding_range_equals_sum_of_steps(spark):
    c = [("c", {}, s, s // 60) for s in range(0, 600, 60)]
    r = M.increase(samples(spark, c), "5 minutes", step="1 minute")
    got = {r.window_end.strftime("%H:%M"): r.value for r in r.collect()}
    assert got["00:05"] == 4.0 and got["00:06"] == 5.0 and got["00:10"] == 5.0


def test_selector_missing_label_is_empty(spark):
    s = samples(spark, [("m", {"container": "x"}, 0, 1), ("m", {}, 0, 2), ("m", {"container": ""}, 0, 3)])
    assert sorted(r.value for r in M.select_series(s, "m", not_equal={"container": ""}).collect()) == [1.0]
    assert sorted(r.value for r in M.select_series(s, "m", equal={"container": ""}).collect()) == [2.0, 3.0]


def test_binary_op_label_matching_and_zero_denominator(spark):
    s = samples(spark, [("num", {"instance": "i1", "db": "x"}, 0, 8), ("num", {"instance": "i2"}, 0, 0),
                        ("num", {"instance": "i3"}, 0, 1),
                        ("den", {"instance": "i1"}, 0, 10), ("den", {"instance": "i2"}, 0, 0),
                        ("den", {"instance": "i3"}, 0, 0)])
    num = M.instant_vector(M.select_series(s, "num"), "1 minute", lookback="1 minute")
    den = M.instant_vector(M.select_series(s, "den"), "1 minute", lookback="1 minute")
    assert M.binary_op(num, den, "/").count() == 2  # full label sets: i1 has an extra label
    got = {r.labels["instance"]: r.value for r in M.binary_op(num, den, "/", on=["instance"]).collect()}
    assert got["i1"] == 0.8 and math.isnan(got["i2"]) and got["i3"] == float("inf")
    assert [r.value for r in M.scalar_op(M.binary_op(num, den, "/", on=["instance"])
                                          .filter("labels['instance'] = 'i1'"), "-", 1).collect()] \
        == [1 - 0.8]


def test_aggregate_by_label(spark):
    s = samples(spark, [("m", {"api": "get", "n": "1"}, 0, 1), ("m", {"api": "get", "n": "2"}, 30, 2),
                        ("m", {"api": "put"}, 0, 5), ("m", {"api": "get", "n": "1"}, 50, 4)])
    v = M.instant_vector(s, "1 minute", lookback="1 minute")
    by = {r.labels["api"]: r.value for r in M.aggregate(v, "sum", by=["api"]).collect()}
    assert by == {"get": 6.0, "put": 5.0}
    assert M.aggregate(v, "avg").first().value == 11.0 / 3


def test_histogram_mean(spark):
    s = samples(spark, [("h_sum", {"s": "a"}, 0, 0), ("h_sum", {"s": "a"}, 60, 30),
                        ("h_count", {"s": "a"}, 0, 0), ("h_count", {"s": "a"}, 60, 3)])
    assert [r.value for r in M.histogram_mean(s, "h", "5 minutes").collect()] == [10.0]


def test_sustained_alert_for_duration(spark):
    rule = al.AlertRule("High", ">", 0.8, "5 minutes", "warning", "{{ $labels.name }} high {{ $value }}")
    rows = []
    # series a: true for 4 min (never fires); b: true exactly 5 min; c: 10 min with a dip
    for i in range(0, 5):
        rows.append(("m", {"name": "a"}, i * 60, 0.9))
    rows.append(("m", {"name": "a"}, 300, 0.1))
    for i in range(0, 6):
        rows.append(("m", {"name": "b"}, i * 60, 0.9))
    for i in range(0, 11):
        rows.append(("m", {"name": "c"}, i * 60, 0.1 if i == 3 else 0.95))
    out = al.sustained_alerts(samples(spark, rows), rule, n_buckets=3).collect()
    got = sorted((r.labels["name"], r.active_since.strftime("%M"), r.firing_since.strftime("%M"),
                  r.samples) for r in out)
    assert got == [("b", "00", "05", 6), ("c", "04", "09", 7)]
    assert sorted(r.summary for r in out)[0] == "b high 0.9"


def test_reference_rules_on_samples(spark):
    rows = [("kafka_consumergroup_lag_sum", {"consumergroup": "g"}, s, 20000) for s in range(0, 420, 15)]
    rows += [("flink_jobmanager_job_status", {"status": "FAILED", "job_name": "j"}, s, 1)
             for s in range(0, 120, 15)]
    rows += [("container_memory_usage_bytes", {"name": "n"}, s, 95) for s in range(0, 400, 15)]
    rows += [("container_spec_memory_limit_bytes", {"name": "n"}, s, 100) for s in range(0, 400, 15)]
    out = al.evaluate_rules(samples(spark, rows)).collect()
    names = sorted(r.alert for r in out)
    assert names == ["FlinkJobFailed", "HighMemoryUsage", "KafkaHighLag"]
    lag = [r for r in out if r.alert == "KafkaHighLag"][0]
    assert lag.description == "Consumer group g has lag of 20000.0 messages"


def test_consumer_lag_and_delay_histogram(spark):
    recs = spark.createDataFrame([(p, o) for p in range(2) for o in range(10)], "partition int, offset long")
    committed = spark.createDataFrame([(0, 4)], "partition int, committed_offset long")
    got = {r.partition: r.lag for r in M.consumer_lag(recs, committed).collect()}
    assert got == {0: 5, 1: 10}
    d = spark.createDataFrame([(T0, 0.5), (T0, 2.0), (T0, 20.0)], "timestamp timestamp, d double")
    h = M.delay_histogram(d, F.col("d"), [1, 5, 10]).first()
    assert (h["le_1"], h["le_5"], h["le_10"], h["count"]) == (1, 2, 2, 3)


def test_instant_value_survives_steps_without_a_sample(spark):
    s = samples(spark, [("up", {"i": str(i)}, t, 1.0) for i in range(2) for t in range(0, 300, 45)])
    v = M.aggregate(M.instant_vector(s, "30 seconds"), "sum").collect()
    got = {int(r.window_end.timestamp()) % 3600: r.value for r in v}
    assert all(got[t] == 2.0 for t in range(30, 570, 30))   # gone five minutes after the last sample, at 270 s
    assert 600 not in got


def test_binary_op_raises_on_several_series_per_match(spark):
    s = samples(spark, [("a", {"i": "x", "n": str(k)}, 0, 1.0) for k in range(2)] + [("b", {"i": "x"}, 0, 2.0)])
    a, b = (M.instant_vector(M.select_series(s, m), "1 minute") for m in "ab")
    with pytest.raises(Exception, match="same matching labels"):
        M.binary_op(a, b, "/", on=["i"]).collect()
    with pytest.raises(Exception, match="same matching labels"):
        M.binary_op(b, a, "/", on=["i"]).collect()
    assert M.binary_op(a, b, "/").collect() == []


def test_gap_resets_an_alert(spark):
    day = 86400
    s = samples(spark, [("m", {"i": "x"}, t, 5.0) for t in (0, 60, day)] + [("m", {"i": "y"}, t, 5.0) for t in range(0, 3900, 60)])
    rule = al.AlertRule("High", ">", 1, "1 hour", "warning", "x")
    out = al.sustained_alerts(s, rule).collect()
    assert [r.labels["i"] for r in out] == ["y"] and out[0].samples == 65


def test_sums_are_exact_for_every_size(spark):
    for values in ([1.23456789], [0.0000004, 0.0000004], [1e300, 1.0], [0.1] * 10, [1e-30, 2e-30], [123456789012.123]):
        s = samples(spark, [("m", {}, i, v) for i, v in enumerate(values)])
        got = M.avg_over_time(s, "1 hour").first().value
        assert got == math.fsum(values) / len(values)
