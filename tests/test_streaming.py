"""Stream = batch parity, late data, restart from checkpoint, fan-out."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from wagerflow.operators import aggregates as agg
from wagerflow.operators import flatten as fl
from wagerflow.operators import upsert as up
from wagerflow.session import checkpoint_path
from wagerflow.sources.records import read_records, write_records
from wagerflow.sources.testdata import bet_records
from wagerflow.streaming import jobs


def _split_files(spark, recs, root, bounds):
    """Write records as one directory per trigger (ordered by offset)."""
    paths = []
    for i, (lo, hi) in enumerate(bounds):
        p = os.path.join(root, f"part{i}")
        write_records(recs.filter((F.col("offset") >= lo) & (F.col("offset") < hi))
                      .coalesce(1), p, mode="overwrite")
        paths.append(p)
    return paths


def _sentinel(spark):
    far = json.dumps({"game": "sentinel", "timestamp": "2099-01-01T00:00:00"})
    return spark.createDataFrame([(far, None, 0, 10**9)],
                                 "value string, timestamp timestamp, partition int, offset long") \
        .withColumn("timestamp", F.lit("2099-01-01 00:00:00").cast("timestamp"))


def _stage(src_root, paths):
    """Move one prepared batch directory's files into the watched folder."""
    import shutil
    for p in paths:
        for f in os.listdir(p):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(p, f), os.path.join(src_root, os.path.basename(p) + f))


def _push(df, src, name):
    """Deliver one batch: write it aside, then copy its files into ``src``."""
    prep = os.path.join(os.path.dirname(src), "prep", name)
    write_records(df.coalesce(1), prep, mode="overwrite")
    os.makedirs(src, exist_ok=True)
    _stage(src, [prep])


def test_game_counts_stream_equals_batch(spark, workdir):
    recs = bet_records(spark, SF001, "flat")
    prep, src = os.path.join(workdir, "prep"), os.path.join(workdir, "src")
    os.makedirs(src)
    parts = _split_files(spark, recs, prep, [(0, 300), (300, 700), (700, 10**6)])
    write_records(_sentinel(spark).coalesce(1), os.path.join(prep, "sentinel"), mode="overwrite")
    stream = read_records(spark, src, streaming=True, max_files_per_trigger=1)
    counts = agg.game_window_counts(stream)
    q = (counts.writeStream.queryName("parity_counts").outputMode("append").format("memory")
         .option("checkpointLocation", checkpoint_path(spark, "t", os.path.basename(workdir), "c"))
         .start())
    try:
        for p in parts + [os.path.join(prep, "sentinel")]:
            _stage(src, [p])
            q.processAllAvailable()
        got = spark.sql("select * from parity_counts")
        want = agg.game_window_counts(recs)
        cols = ["window_start", "game", "count"]
        assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
    finally:
        q.stop()


def test_game_counts_stream_with_restart_equals_batch(spark, workdir):
    """Three files, one per trigger, restart between them (file sink)."""
    recs = bet_records(spark, SF001, "flat")
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    ck = checkpoint_path(spark, "t", os.path.basename(workdir), "r")
    batches = [recs.filter(f"offset >= {lo} and offset < {hi}")
               for lo, hi in [(0, 400), (400, 800), (800, 10**6)]] + [_sentinel(spark)]

    def run():
        stream = read_records(spark, src, streaming=True, max_files_per_trigger=1)
        q = (agg.game_window_counts(stream).writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", ck).start(out))
        q.processAllAvailable()
        q.stop()

    for i, b in enumerate(batches):
        _push(b, src, f"b{i}")
        run()  # a fresh query per file: state and progress come from the checkpoint
    got = spark.read.parquet(out).select("window_start", "game", "count").collect()
    want = agg.game_window_counts(recs).select("window_start", "game", "count").collect()
    assert sorted(got) == sorted(want)


def test_text_lines_source(spark, workdir):
    src = os.path.join(workdir, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.txt"), "w") as f:
        f.write('{"status":"win"}\nnot json\n{"status":"lose"}\n')
    recs = read_records(spark, src, fmt="text")
    got = {r.status: r["count"] for r in agg.status_counts(recs).collect()}
    assert got == {"win": 1, "lose": 1, "invalid": 0}
    assert recs.select("partition").distinct().count() == 1 and recs.count() == 3


def test_late_rows_are_dropped_and_counted(spark, workdir):
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    mk = lambda vals, off: spark.createDataFrame(
        [(json.dumps({"game": g, "timestamp": t}), None, 0, off + i) for i, (g, t) in
         enumerate(vals)], "value string, timestamp timestamp, partition int, offset long") \
        .withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    stream = read_records(spark, src, streaming=True, max_files_per_trigger=1)
    q = (agg.game_window_counts(stream).writeStream.queryName("late_counts")
         .outputMode("append").format("memory")
         .option("checkpointLocation", checkpoint_path(spark, "t", os.path.basename(workdir), "l"))
         .start())
    try:
        _push(mk([("a", "2024-01-01T00:00:01"), ("a", "2024-01-01T00:00:31")], 0), src, "b1")
        q.processAllAvailable()
        # 00:00:03 is 28 s behind the max event time: its window closed.
        # 00:00:29 is 2 s out of order: kept.
        _push(mk([("a", "2024-01-01T00:00:03"), ("a", "2024-01-01T00:00:29"),
                  ("a", "2024-01-01T00:01:00")], 10), src, "b2")
        q.processAllAvailable()
        got = {(r.window_start.strftime("%M:%S"), r["count"])
               for r in spark.sql("select * from late_counts").collect()}
        assert ("00:00", 1) in got and ("00:20", 1) in got and ("00:30", 1) in got
        dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                      for p in q.recentProgress if p["stateOperators"])
        assert dropped == 1
    finally:
        q.stop()


def test_status_update_mode_and_restart(spark, workdir):
    from wagerflow.streaming.sinks import batch_dir_writer, fan_out
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    ck = checkpoint_path(spark, "t", os.path.basename(workdir), "s")
    mk = lambda st, off: spark.createDataFrame(
        [(json.dumps({"status": s}), None, 0, off + i) for i, s in enumerate(st)],
        "value string, timestamp timestamp, partition int, offset long")

    def run():
        stream = read_records(spark, src, streaming=True)
        q = fan_out(agg.status_counts(stream), "status_restart", [batch_dir_writer(out)],
                    mode="update", checkpoint=ck)
        q.processAllAvailable()
        q.stop()

    _push(mk(["win", "win", "lose"], 0), src, "b1")
    run()
    _push(mk(["win", "x"], 10), src, "b2")
    run()  # restart from the same checkpoint: state survives the restart
    rows = spark.read.json(out).groupBy("status").agg(F.max("count").alias("c")).collect()
    assert {r.status: r.c for r in rows} == {"win": 3, "lose": 1, "x": 1}
    # update mode: the second batch re-emits only the keys it touched
    second = spark.read.json(out + "/run=*/batch_id=1").collect()
    assert {r.status for r in second} == {"win", "x"}


def test_active_users_fan_out_writes_files(spark, workdir):
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    recs = bet_records(spark, SF001, "flat").filter("offset < 200")
    _push(recs, src, "b1")
    _push(_sentinel(spark), src, "b2")
    stream = read_records(spark, src, streaming=True, max_files_per_trigger=1)
    q = jobs.active_users_job(stream, files=out, topic=None, console=False,
                              checkpoint=checkpoint_path(spark, "t", os.path.basename(workdir),
                                                         "a"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    lines = spark.read.text(out).collect()
    want = agg.active_users(recs).count()
    assert len(lines) == want
    rec = json.loads(lines[0].value)
    assert set(rec) == {"window_start", "window_end", "active_users"}


def test_ingest_job_replay_is_idempotent(spark, workdir):
    src, bets = os.path.join(workdir, "src"), os.path.join(workdir, "bets")
    recs = bet_records(spark, SF001, "nested")
    _push(recs, src, "b1")
    for attempt in range(2):  # second run: fresh checkpoint = full replay
        ck = checkpoint_path(spark, "t", os.path.basename(workdir), f"i{attempt}")
        q = jobs.ingest_job(read_records(spark, src, streaming=True), bets, checkpoint=ck)
        q.processAllAvailable()
        q.stop()
    versions = up.read_versions(spark, bets)
    quarantine = spark.read.parquet(os.path.join(bets, "quarantine"))
    total = recs.count()
    assert versions.select("run").distinct().count() == 2
    assert versions.count() + quarantine.count() == 2 * total   # both runs keep what they read
    first = versions.filter(F.col("run") == versions.first().run).drop(*up.RUN_COLUMNS)
    assert sorted(map(str, up.current_bets(spark, bets).collect())) == sorted(map(str, up.latest_versions(first).collect()))
    from wagerflow.sources.tables import register_views
    register_views(spark, bets)
    assert spark.table("bets_quarantine").count() == quarantine.count() // 2
    counters = [p["observedMetrics"][jobs.INGEST_COUNTERS] for p in q.recentProgress
                if jobs.INGEST_COUNTERS in p.get("observedMetrics", {})]
    assert sum(c["rows"] for c in counters) == total
    assert sum(c["rejected"] for c in counters) == quarantine.count() // 2


def test_new_checkpoint_keeps_stored_bets(spark, workdir):
    """A topic that forgot its old records and a new checkpoint: nothing stored is lost or hidden."""
    bets = os.path.join(workdir, "bets")
    recs = bet_records(spark, SF001, "nested")
    ids = [r.offset for r in fl.flatten_bets(recs)[0].select(F.col("src_offset").alias("offset"), "bet_id")
           .dropDuplicates(["bet_id"]).orderBy("offset").limit(4).collect()]

    def ingest(n, part):
        src = os.path.join(workdir, f"src{n}")
        _push(recs.filter(F.col("offset").isin(part)), src, "b1")
        q = jobs.ingest_job(read_records(spark, src, streaming=True), bets,
                            checkpoint=checkpoint_path(spark, "t", os.path.basename(workdir), f"n{n}"))
        q.processAllAvailable()
        q.stop()

    ingest(0, ids[:2])
    ingest(1, ids[2:3])
    assert up.current_bets(spark, bets).count() == 3
    up.compact(spark, bets, "s1")
    ingest(2, ids[3:])
    assert up.current_bets(spark, bets).count() == 4


def test_changelog_without_its_state_is_an_error(spark, workdir):
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    recs = bet_records(spark, SF001, "flat").filter("offset < 200")
    ck = checkpoint_path(spark, "t", os.path.basename(workdir), "c")

    def run():
        q = jobs.bet_status_changelog_job(read_records(spark, src, streaming=True), out, checkpoint=ck)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    _push(recs.filter("offset < 100"), src, "b1")
    run()
    state = os.path.join(out, "state")
    os.rename(state, state + "-gone")
    _push(recs.filter("offset >= 100"), src, "b2")
    with pytest.raises(Exception, match="state of batch 0 is missing"):
        run()


def test_console_prints_every_row(spark, capsys):
    from wagerflow.streaming.sinks import console_writer
    console_writer()(spark.range(100).withColumn("x", F.lit(None).cast("string")), 7)
    lines = capsys.readouterr().out.splitlines()
    assert lines[0] == "-- batch 7" and len(lines) == 101 and '{"id":99,"x":null}' in lines


def test_remaining_jobs_run_end_to_end(spark, workdir):
    src = os.path.join(workdir, "src")
    recs = bet_records(spark, SF001, "flat").filter("offset < 300")
    _push(recs, src, "b1")
    _push(_sentinel(spark), src, "b2")
    ck = lambda n: checkpoint_path(spark, "t", os.path.basename(workdir), n)
    stream = lambda: read_records(spark, src, streaming=True, max_files_per_trigger=1)
    top = os.path.join(workdir, "top")
    hist = os.path.join(workdir, "hist")
    rows = os.path.join(workdir, "rows")
    qs = [jobs.top_games_job(stream(), sink="text", path=top, checkpoint=ck("top")),
          jobs.game_history_job(stream(), hist, checkpoint=ck("hist")),
          jobs.top_games_rows_job(stream(), rows, checkpoint=ck("rows")),
          jobs.avg_bet_job(stream(), sink="memory", checkpoint=ck("avg"))]
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    want = agg.game_window_counts(recs)
    msgs = [json.loads(r.value) for r in spark.read.text(top).collect()]
    assert len(msgs) == want.count() and set(msgs[0]) == {"game", "count"}
    h = spark.read.parquet(hist)
    assert h.count() == want.count() and {"game", "count", "event_time"} <= set(h.columns)
    assert spark.read.parquet(os.path.join(rows, "rows")).count() + \
        spark.read.parquet(os.path.join(rows, "quarantine")).count() == 301
    last = spark.sql("select * from avg_bet").collect()[-1]
    assert last.metric == "avg_bet" and last.n > 0


def test_per_record_changelog_stream_equals_batch(spark, workdir):
    recs = bet_records(spark, SF001, "flat")
    src, out_s, out_a = (os.path.join(workdir, d) for d in ("src", "status", "avg"))
    for i, (lo, hi) in enumerate([(0, 350), (350, 700), (700, 10**6)]):
        _push(recs.filter(f"offset >= {lo} and offset < {hi}"), src, f"b{i}")
    ck = lambda n: checkpoint_path(spark, "t", os.path.basename(workdir), n)
    stream = lambda: read_records(spark, src, streaming=True, max_files_per_trigger=1)
    for q in (jobs.bet_status_changelog_job(stream(), out_s, checkpoint=ck("cs")),
              jobs.avg_bet_changelog_job(stream(), out_a, checkpoint=ck("ca"))):
        q.processAllAvailable()
        q.stop()
    got = spark.read.parquet(os.path.join(out_s, "changes")).drop("run", "batch_id")
    want = agg.status_changelog(recs)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    got_a = spark.read.parquet(os.path.join(out_a, "changes")).drop("run", "batch_id")
    want_a = agg.average_changelog(recs)
    assert sorted(got_a.collect()) == sorted(want_a.select(*got_a.columns).collect())
    assert spark.read.parquet(os.path.join(out_s, "changes")).select("batch_id").distinct().count() == 3


def test_top_k_stream_equals_batch(spark, workdir):
    recs = bet_records(spark, SF001, "flat")
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "top")
    for i, (lo, hi) in enumerate([(0, 500), (500, 10**6)]):
        _push(recs.filter(f"offset >= {lo} and offset < {hi}"), src, f"b{i}")
    _push(_sentinel(spark), src, "b9")
    q = jobs.top_games_ranked_job(read_records(spark, src, streaming=True, max_files_per_trigger=1),
                                  out, checkpoint=checkpoint_path(spark, "t", os.path.basename(workdir), "k"))
    q.processAllAvailable()
    q.stop()
    cols = ["window_start", "game", "count", "rank"]
    got = spark.read.parquet(out).select(*cols).collect()
    want = agg.top_games_ranked(agg.game_window_counts(recs, window="1 hour"), 3).select(*cols).collect()
    assert sorted(got) == sorted(want)


def test_pipeline_ingest_then_export(spark, workdir):
    """records -> ingest stream (version log + quarantine) -> export runs."""
    import datetime as dt
    from wagerflow.operators import export as ex
    from wagerflow.operators import upsert as up
    recs = bet_records(spark, SF001, "nested")
    src, bets, out = (os.path.join(workdir, d) for d in ("src", "bets", "export"))
    ck = checkpoint_path(spark, "t", os.path.basename(workdir), "p")

    def ingest():
        q = jobs.ingest_job(read_records(spark, src, streaming=True), bets, checkpoint=ck)
        q.processAllAvailable()
        q.stop()

    _push(recs.filter("offset < 600"), src, "b0")
    ingest()
    n1 = jobs.export_job(spark, bets, out, dt.datetime(2024, 2, 1, 12, 0))
    assert n1 == up.current_bets(spark, bets).count() > 0
    _push(recs.filter("offset >= 600"), src, "b1")
    ingest()
    n2 = jobs.export_job(spark, bets, out, dt.datetime(2024, 2, 1, 12, 5))
    # Second run exports exactly the bets whose latest version changed.
    v = spark.read.parquet(os.path.join(bets, "versions"))
    changed = v.filter("batch_id = 1").select("bet_id").distinct().count()
    assert n2 == changed
    files = spark.read.parquet(os.path.join(out, "raw"))
    assert files.count() == n1 + n2
    assert files.select("batch_id").distinct().count() == 2
    assert ex.run_export_once(spark, bets, out, dt.datetime(2024, 2, 1, 12, 10)) == 0
    # The ad-hoc SQL of the original setup runs unchanged on the views.
    from wagerflow.sources.tables import register_views
    register_views(spark, bets, out)
    assert len(spark.sql("SELECT * FROM bets LIMIT 10").collect()) == 10
    assert spark.sql("SELECT COUNT(*) FROM bets WHERE exported = false").first()[0] == 0
    assert spark.sql("SELECT COUNT(*) FROM bets WHERE exported = true").first()[0] == \
        up.current_bets(spark, bets).count()
    assert spark.sql("SELECT COUNT(*) FROM bets_quarantine").first()[0] > 0


def test_legacy_table_ingest_and_export(spark, workdir):
    import datetime as dt
    recs = bet_records(spark, SF001, "flat")
    src, bets, out = (os.path.join(workdir, d) for d in ("src", "legacy", "export"))
    _push(recs, src, "b0")
    q = jobs.ingest_job(read_records(spark, src, streaming=True), bets, table="legacy",
                        checkpoint=checkpoint_path(spark, "t", os.path.basename(workdir), "g"))
    q.processAllAvailable()
    q.stop()
    n = jobs.export_job(spark, bets, out, dt.datetime(2024, 2, 2), layout="legacy")
    files = spark.read.parquet(os.path.join(out, "raw"))
    from wagerflow.operators.export import LEGACY_EXPORT_COLUMNS
    assert n == files.count() == recs.count() - spark.read.parquet(
        os.path.join(bets, "quarantine")).count()
    assert [c for c in files.columns if c not in ("export_date", "batch_id")] == LEGACY_EXPORT_COLUMNS
