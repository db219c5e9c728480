"""Bucketed export ledger: touched buckets, runs that died at every step, folding."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from test_upsert_export import _bet, _valid
from wagerflow.operators import export as ex
from wagerflow.operators import upsert as up

IDS = [f"00000000-0000-0000-0000-{k:012d}" for k in range(40)]
AT = dt.datetime(2024, 1, 2, 10)


def later(minutes):
    return AT + dt.timedelta(minutes=minutes)


def files(spark, out):
    return spark.read.parquet(os.path.join(out, "raw"))


def test_a_run_reads_the_buckets_of_its_bets(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("pending", bet=b) for b in IDS]), root, 0)
    assert ex.run_export_once(spark, root, out, AT) == 40
    up.append_versions(_valid(spark, [_bet("win", bet=b) for b in IDS[:2]], start="2024-01-02 11:00:00"), root, 1)
    new = up.latest_versions(up.read_versions(spark, root).filter("batch_id = 1"))
    buckets = ex.touched(new)
    assert 1 <= len(buckets) <= 2
    ledger = ex.read_ledger(spark, os.path.join(out, "_ledger")).filter(F.col("bucket").isin(buckets))
    assert ledger.count() == 2   # other bets of these buckets aside: forty in 1024
    assert "PartitionFilters: [bucket#" in ledger._jdf.queryExecution().executedPlan().toString()
    assert ex.run_export_once(spark, root, out, later(5)) == 2
    assert ex.run_export_once(spark, root, out, later(10)) == 0


@pytest.mark.parametrize("step", ["write_export", "append_ledger", "fold_ledger"])
def test_a_run_that_died_is_finished_by_the_next(spark, workdir, monkeypatch, step):
    """The run dies behind ``step``; it is not retried, and the next run has another id and newer versions."""
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("pending", bet=b) for b in IDS[:6]]), root, 0)
    real = getattr(ex, step)

    def dies(*a):
        real(*a)
        raise RuntimeError("lost driver")
    monkeypatch.setattr(ex, step, dies)
    with pytest.raises(RuntimeError):
        ex.run_export_once(spark, root, out, AT)
    monkeypatch.setattr(ex, step, real)
    up.append_versions(_valid(spark, [_bet("win", bet=b) for b in IDS[4:8]], start="2024-01-02 11:00:00"), root, 1)
    assert ex.run_export_once(spark, root, out, later(5)) == 4
    got = sorted((r.batch_id, r.bet_id[-2:], r.status) for r in files(spark, out).select(
        F.col("batch_id").cast("string").alias("batch_id"), "bet_id", "status").collect())
    assert got == [("20240102T100000", f"0{k}", "pending") for k in range(6)] + [("20240102T100500", f"0{k}", "win") for k in range(4, 8)]
    assert ex.run_export_once(spark, root, out, later(10)) == 0


def test_folding_keeps_the_last_entries(spark, workdir, monkeypatch):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    ledger_root = os.path.join(out, "_ledger")
    monkeypatch.setattr(ex, "BUCKETS", 2)
    for k in range(5):
        up.append_versions(_valid(spark, [_bet(f"s{k}", bet=b) for b in IDS[:4]], start=f"2024-01-02 1{k}:00:00"), root, k)
        assert ex.run_export_once(spark, root, out, later(k)) == 4
    last = lambda: sorted(tuple(r) for r in ex.last_exported(ex.read_ledger(spark, ledger_root)).collect())
    before = last()
    assert len(ex.fold_ledger(spark, ledger_root, "20240102T100400", "fold-a", most=2)) == 2
    ledger = ex.read_ledger(spark, ledger_root)
    assert last() == before and ledger.count() == 8   # one entry per bet, and those of the batch that is kept
    assert {r.batch_id for r in ledger.select("batch_id").distinct().collect()} == {"fold-a", "20240102T100400"}
    assert ex.fold_ledger(spark, ledger_root, "20240102T100400", "fold-b", most=2) == []
    # the same content that comes again is not exported, other content is
    up.append_versions(_valid(spark, [_bet("s4", bet=IDS[0]), _bet("new", bet=IDS[1])], start="2024-01-03 00:00:00"), root, 9)
    assert ex.run_export_once(spark, root, out, later(60)) == 1


def test_a_fold_cut_off_before_removal_changes_nothing(spark, workdir, monkeypatch):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    ledger_root = os.path.join(out, "_ledger")
    for k in range(3):
        up.append_versions(_valid(spark, [_bet(f"s{k}")], start=f"2024-01-02 1{k}:00:00"), root, k)
        assert ex.run_export_once(spark, root, out, later(k)) == 1
    ledger = ex.read_ledger(spark, ledger_root)
    before = [tuple(r) for r in ex.last_exported(ledger).collect()]
    ledger.limit(2).withColumn("batch_id", F.lit("fold-x")).write.mode("append").partitionBy("bucket", "batch_id").parquet(ledger_root)
    assert [tuple(r) for r in ex.last_exported(ex.read_ledger(spark, ledger_root)).collect()] == before


def test_one_rule_for_job_and_query(spark):
    fixed = lambda df: spark.createDataFrame(df.collect(), df.schema)
    versions = up.with_row_hash(_valid(spark, [_bet("a", bet=IDS[0]), _bet("b", bet=IDS[1]), _bet("c", bet=IDS[2])], start="2024-01-02 00:00:00"))
    newer = fixed(up.with_row_hash(_valid(spark, [_bet("a2", bet=IDS[0]), _bet("b", bet=IDS[1])], start="2024-01-03 00:00:00")))
    older = fixed(up.with_row_hash(_valid(spark, [_bet("c0", bet=IDS[2])], start="2024-01-01 00:00:00")))
    ledger = ex.ledger_rows(versions)
    assert [r.status for r in ex.pending_bets(newer.unionByName(older), ledger).collect()] == ["a2"]
    flags = {r.status: (r.exported, r.newer) for r in ex.against_ledger(newer.unionByName(older), ledger).collect()}
    assert flags == {"a2": (False, True), "b": (True, True), "c0": (False, False)}
