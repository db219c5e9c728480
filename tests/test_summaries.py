"""Counter summaries and alert runs: merged in any pieces they equal one pass over all samples."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wagerflow.operators import alerts as al
from wagerflow.operators import counters as C
from wagerflow.operators import flatten as fl
from wagerflow.operators import metrics as M
from wagerflow.plans.queries import QUERIES

from conftest import SF001
from test_metrics import T0, samples


def walk(rng, series, n, step=40):
    """A counter with restarts per series, at uneven times over some hours."""
    out = []
    for k in range(series):
        t, v = rng.randrange(600), 0
        for _ in range(n):
            t += rng.choice((1, step, 17 * step, 90 * step))
            v = rng.randrange(5) if rng.random() < 0.1 else v + rng.randrange(9)
            out.append(("c", {"job": str(k)}, t, v))
    return out


def plain_increase(rows, width):
    """value per (job, window start) by a loop over each series."""
    out, before = {}, {}
    for _, lab, t, v in sorted(rows, key=lambda r: (r[1]["job"], r[2], r[3])):
        job = lab["job"]
        p = before.get(job)
        d = 0 if p is None else v if v < p else v - p
        before[job] = v
        key = (job, t // width * width)
        out[key] = out.get(key, 0) + d
    return out


def by_window(df):
    return {(r.labels["job"], int((r.window_start - T0).total_seconds())): r.value for r in df.collect()}


@pytest.mark.parametrize("width", ["5 minutes", "1 hour", "3 hours"])
def test_increase_equals_a_loop(spark, width):
    rows = walk(random.Random(1), 4, 120)
    rows += [("c", {"job": "0"}, rows[3][2], 7)]   # two readings at one instant
    assert by_window(M.increase(samples(spark, rows), width)) == plain_increase(rows, M.seconds(width))


def test_summaries_merge_in_any_pieces(spark):
    s = M.with_series(samples(spark, walk(random.Random(2), 3, 150)))
    names = ["metric", "series", "cell", "first", "last", "inside", "samples"]
    rows = lambda df: sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    whole = rows(C.summarize(s, "12 hours"))
    assert whole == rows(C.merge(C.summarize(s, "1 hour"), "12 hours"))
    assert whole == rows(C.merge(C.merge(C.summarize(s, "20 seconds"), "2 hours"), "12 hours"))
    # stored by parts, joined later: as one pass
    stored = C.summarize(s.filter("ts < '2024-01-01 06:00:00'"), "1 hour").unionByName(
        C.summarize(s.filter("ts >= '2024-01-01 06:00:00'"), "1 hour"))
    assert by_window(M.increase_of(stored, "3 hours", "1 hour")) == by_window(M.increase(s, "3 hours", "1 hour"))


def test_null_readings_and_empty_samples(spark):
    s = samples(spark, [("c", {"job": "a"}, 0, 1), ("c", {"job": "a"}, 30, 9), ("c", {"job": "a"}, 60, 4)])
    s = s.withColumn("value", F.when(F.col("value") != 9, F.col("value")))
    assert [r.value for r in M.increase(s, "5 minutes").collect()] == [3.0]
    assert M.increase(s.filter("false"), "5 minutes").collect() == []


RULE = al.AlertRule("High", ">", 5.0, "10 minutes", "warning", "{{ $labels.job }} is high")


def points(rng, series, n):
    out = []
    for k in range(series):
        t, v = rng.randrange(100), 1
        for _ in range(n):
            t += rng.choice((30, 60, 200, 290, 310, 4000) if rng.random() < 0.1 else (60, 120, 240))
            v = rng.choice((1, 9, 9, 9)) if rng.random() < 0.2 else v
            out.append(("g", {"job": str(k)}, t, v + k / 100))
    return out


def plain_alerts(rows, hold=600, gap=300):
    out = {}
    for job in {r[1]["job"] for r in rows}:
        run = []
        for t, v in [*sorted((r[2], r[3]) for r in rows if r[1]["job"] == job), (None, None)]:
            if run and (t is None or not v > 5 or t - run[-1][0] > gap):
                due = [(a, b) for a, b in run if a >= run[0][0] + hold]
                if due:
                    out[job, run[0][0]] = (due[0][0], run[-1][0], len(run), due[0][1])
                run = []
            if t is not None and v > 5:
                run.append((t, v))
    return out


def fired(df):
    at = lambda t: int((t - T0).total_seconds())
    return {(r.labels["job"], at(r.active_since)): (at(r.firing_since), at(r.last_true), r.samples, r.value) for r in df.collect()}


def test_alerts_equal_a_loop(spark):
    rows = points(random.Random(3), 6, 200)
    want = plain_alerts(rows)
    assert len(want) > 20 and any(v[1] - k[1] > 3600 for k, v in want.items())
    assert fired(al.sustained_alerts(samples(spark, rows), RULE)) == want


@pytest.mark.parametrize("cuts", [[5000], [3600, 7200, 7230], [1800, 5400, 9000, 9100]])
def test_evaluations_cut_anywhere_equal_one(spark, cuts):
    rows = points(random.Random(4), 4, 110)
    got, state = {}, None
    edges = [0, *cuts, 10**9]
    for a, z in zip(edges, edges[1:]):
        new = [r for r in rows if a <= r[2] < z]
        if not new:
            continue
        alerts, state = al.advance(samples(spark, new), RULE, state)
        got |= fired(alerts)
        state = spark.createDataFrame(state.collect(), al.STATE)   # stored between evaluations
        assert state.count() == len({(r[1]["job"]) for r in rows if r[2] < z})
    assert got == plain_alerts(rows)


def test_one_long_run_over_many_cells(spark):
    rows = [("g", {"job": "x"}, 250 * k, 8) for k in range(400)]
    assert fired(al.sustained_alerts(samples(spark, rows), RULE)) == {("x", 0): (750, 250 * 399, 400, 8.0)}


@pytest.mark.parametrize("name", ["metric_increase", "metric_rate_sliding", "metric_hit_ratio", "alert_gap_reset"])
def test_no_job_runs_while_planning(spark, name):
    spark.sparkContext.setJobGroup(f"planning {name}", name)
    QUERIES[name](spark, SF001)
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"planning {name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a table's footer is Spark's own job
    assert len(ids) <= 1


def test_a_win_beyond_the_money_type_is_a_mismatch(spark):
    bets = spark.createDataFrame([("win", "50000000.00", "3.00", "0.00"), ("win", "10.00", "2.50", "25.00"), ("lost", "1.00", "2.00", "0.00")],
                                 "status string, amount string, odds string, payout string") \
        .selectExpr("status", "cast(amount as decimal(10,2)) amount", "cast(odds as decimal(6,2)) odds", "cast(payout as decimal(10,2)) payout")
    got = [(str(r.expected_payout), r.payout_ok) for r in fl.expected_payout(bets).collect()]
    assert got == [("150000000.00", False), ("25.00", True), ("0.00", True)]
