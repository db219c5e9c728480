"""Last write wins, replay safety, compaction and the export ledger."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import records
from wagerflow.operators import export as ex
from wagerflow.operators import flatten as fl
from wagerflow.operators import upsert as up


def _bet(status, amount=10, bet="00000000-0000-0000-0000-0000000000aa", ts="2024-01-01T00:00:00"):
    return json.dumps({
        "bet_id": bet, "user": {"user_id": "00000000-0000-0000-0000-000000000001"},
        "event": {"sport": "tennis", "odds": 2}, "bet": {"amount": amount, "status": status,
                                                         "timestamp": ts},
        "metadata": {"session_id": "00000000-0000-0000-0000-000000000002", "created_at": ts}})


def _valid(spark, lines, start="2024-01-01 00:00:00"):
    v, bad = fl.flatten_bets(records(spark, lines, start=start))
    assert bad.count() == 0
    return v


def test_latest_version_wins(spark):
    v = _valid(spark, [_bet("pending"), _bet("win"), _bet("lose", bet="00000000-0000-0000-0000-0000000000bb")])
    cur = {r.bet_id[-2:]: r.status for r in up.latest_versions(v).collect()}
    assert cur == {"aa": "win", "bb": "lose"}


def test_version_log_replay_and_compaction(spark, workdir):
    root = os.path.join(workdir, "bets")
    up.append_versions(_valid(spark, [_bet("pending")]), root, 0)
    up.append_versions(_valid(spark, [_bet("win")], start="2024-01-01 01:00:00"), root, 1)
    up.append_versions(_valid(spark, [_bet("win")], start="2024-01-01 01:00:00"), root, 1)
    assert spark.read.parquet(os.path.join(root, "versions")).count() == 2
    assert [r.status for r in up.current_bets(spark, root).collect()] == ["win"]
    up.compact(spark, root, "s1")
    up.append_versions(_valid(spark, [_bet("lose")], start="2024-01-01 02:00:00"), root, 2)
    assert [r.status for r in up.current_bets(spark, root).collect()] == ["lose"]


def test_export_runs_are_incremental_and_idempotent(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("pending"), _bet(
        "win", bet="00000000-0000-0000-0000-0000000000bb")]), root, 0)
    t1 = dt.datetime(2024, 1, 2, 10, 0, 0)
    assert ex.run_export_once(spark, root, out, t1) == 2
    assert ex.run_export_once(spark, root, out, t1) == 2  # retry of the same run
    files = spark.read.parquet(os.path.join(out, "raw"))
    assert files.count() == 2 and set(files.columns) >= set(ex.EXPORT_COLUMNS)
    assert files.select("export_date").distinct().first()[0].isoformat() == "2024-01-02"
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10, 5)) == 0
    # a changed version is pending again; an identical replay is not
    up.append_versions(_valid(spark, [_bet("win")], start="2024-01-02 11:00:00"), root, 1)
    up.append_versions(_valid(spark, [_bet("win", bet="00000000-0000-0000-0000-0000000000bb")]),
                       root, 2)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10, 10)) == 1
    ledger = ex.read_ledger(spark, os.path.join(out, "_ledger"))
    cur = ex.with_exported(up.current_bets(spark, root), ledger)
    assert {r.exported: r.bets for r in ex.export_counts(cur).collect()} == {True: 2}


def test_export_projection_types(spark):
    v = _valid(spark, [_bet("win", amount="12.345")])
    row = ex.export_projection(v).first()
    assert row.amount == 12.35 and isinstance(row.odds, float) and row.exported is False
    legacy = ex.legacy_export_projection(v.withColumnRenamed("sport", "game")
                                          .withColumn("timestamp", F.col("bet_timestamp")))
    assert legacy.columns == ex.LEGACY_EXPORT_COLUMNS


def test_table_bootstrap_and_scan(spark, workdir):
    from wagerflow.schemas import BETS
    from wagerflow.sources import tables
    p = os.path.join(workdir, "bets_table")
    tables.ensure_table(spark, p, BETS)
    tables.ensure_table(spark, p, BETS)  # idempotent
    t = tables.read_table(spark, p)
    assert t.count() == 0 and t.columns == [f.name for f in BETS.fields]
    assert tables.peek(tables.not_exported(t), 5).count() == 0


def test_export_crash_between_write_and_ledger(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("pending"), _bet(
        "win", bet="00000000-0000-0000-0000-0000000000bb")]), root, 0)
    t = dt.datetime(2024, 1, 3, 9, 0, 0)
    # The run writes its files, then dies before recording them in the ledger.
    pending = ex.pending_bets(up.current_bets(spark, root), None)
    ex.write_export(ex.export_projection(pending), out, "20240103T090000", t)
    assert ex.read_ledger(spark, os.path.join(out, "_ledger")) is None
    # The scheduler retries the same run: same batch id, same directory.
    assert ex.run_export_once(spark, root, out, t) == 2
    files = spark.read.parquet(os.path.join(out, "raw"))
    assert files.count() == 2 and files.select("bet_id").distinct().count() == 2
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 3, 9, 5)) == 0


def test_views_before_any_export(spark, workdir):
    from wagerflow.sources.tables import register_views
    root = os.path.join(workdir, "bets")
    up.append_versions(_valid(spark, [_bet("pending"), _bet("win")]), root, 0)
    register_views(spark, root)
    assert spark.sql("SELECT COUNT(*) FROM bets WHERE exported = false").first()[0] == 1
    assert spark.sql("SELECT status FROM bets").first()[0] == "win"


def test_null_that_moves_is_a_change(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")

    def bet(sport, league):
        e = json.loads(_bet("win"))
        e["event"].update(sport=sport, league=league)
        return json.dumps(e)
    up.append_versions(_valid(spark, [bet("x", None)]), root, 0)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10, 0)) == 1
    up.append_versions(_valid(spark, [bet(None, "x")], start="2024-01-03 00:00:00"), root, 1)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10, 5)) == 1


def test_content_that_returns_is_exported_again(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    for i, status in enumerate(["win", "lose", "win"]):
        up.append_versions(_valid(spark, [_bet(status)], start=f"2024-01-0{i + 1} 00:00:00"), root, i)
        assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 5, 10, i)) == 1
    # an older version that arrives late changes nothing
    up.append_versions(_valid(spark, [_bet("pending")], start="2024-01-02 12:00:00"), root, 3)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 5, 11)) == 0


def test_damaged_ledger_raises(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("win")]), root, 0)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10)) == 1
    ledger = os.path.join(out, "_ledger")
    for d, _, files in os.walk(ledger):
        for f in files:
            with open(os.path.join(d, f), "wb") as h:
                h.write(b"damaged")
    up.append_versions(_valid(spark, [_bet("lose")], start="2024-01-03 00:00:00"), root, 1)
    with pytest.raises(Exception):
        ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 11))


def test_empty_run_writes_no_files(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    up.append_versions(_valid(spark, [_bet("win")]).limit(0), root, 0)
    up.append_versions(_valid(spark, [_bet("win")]), root, 1)
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10)) == 1
    before = sorted(os.listdir(out))
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 11)) == 0
    assert sorted(os.listdir(out)) == before and "_staging" not in before
    assert len(os.listdir(os.path.join(out, "raw", "export_date=2024-01-02"))) == 1


def test_runs_count_their_batches_alone(spark, workdir):
    root, out = os.path.join(workdir, "bets"), os.path.join(workdir, "export")
    bb, cc = "00000000-0000-0000-0000-0000000000bb", "00000000-0000-0000-0000-0000000000cc"
    up.append_versions(_valid(spark, [_bet("win"), _bet("win", bet=bb)]), root, 0, "run-1")
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 10)) == 2
    up.append_versions(_valid(spark, [_bet("win", bet=cc)]), root, 0, "run-2")
    assert up.current_bets(spark, root).count() == 3
    assert ex.run_export_once(spark, root, out, dt.datetime(2024, 1, 2, 11)) == 1
    up.compact(spark, root, "s1")
    up.append_versions(_valid(spark, [_bet("lose", bet=bb)], start="2024-01-05 00:00:00"), root, 0, "run-3")
    assert {r.bet_id[-2:]: r.status for r in up.current_bets(spark, root).collect()} == \
        {"aa": "win", "bb": "lose", "cc": "win"}
    up.compact(spark, root, "s2")
    assert up.current_bets(spark, root).count() == 3


@pytest.mark.parametrize("name", ["export_counts", "export_pending"])
def test_events_are_parsed_once(spark, name):
    """Current bets and ledger read the same written versions."""
    from conftest import SF001
    from wagerflow.plans import QUERIES
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "parseJson" not in plan
