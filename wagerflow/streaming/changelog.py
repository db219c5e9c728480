"""Per-record running aggregates on a stream (the reference's emission model).

The reference's status and average jobs emit the running value after every
record; an update-mode streaming aggregate emits once per key per
micro-batch.  ``changelog_stream`` reproduces the per-record output exactly:

* inside each micro-batch, the bucketed running aggregate of
  ``operators.ordered`` gives every row its value within the batch;
* a small state table -- one row per key with the totals of all earlier
  batches -- supplies the carry, written under ``state/run=R/batch_id=N``;
* batch N reads the state of batch N-1 of its run and overwrites only its own
  output and state directories, so a replayed batch rewrites the same result.
  A new checkpoint is a new run and starts without state.  A missing state
  for N > 0 is an error: totals never restart without a word.

The state holds one row per key (statuses), joined as a table that AQE
broadcasts when small; a global aggregate's state is a single row, read on
the driver and applied as literals.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wagerflow.operators.ordered import _combine, decimal_scale, prefix_aggregate
from wagerflow.streaming.sinks import _writer, run_id


def _fs(spark, path):
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp, jp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _total(kind: str, col: str):
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](col)


def changelog_stream(prepared: DataFrame, name: str, out_root: str, *, keys: list[str],
                     order: list[str], aggs: dict[str, tuple[str, str]],
                     finish: Callable[[DataFrame], DataFrame] | None = None,
                     checkpoint: str | None = None, trigger: dict | None = None,
                     n_buckets: int | None = None) -> StreamingQuery:
    """Start ``name``: per-record running ``aggs`` (sum/max/min) per ``keys``.

    ``prepared`` is a stream with the key, order and input columns; output
    rows (``finish`` applied) go to ``out_root/changes/run=R/batch_id=N``.
    """
    for kind, _ in aggs.values():
        if kind not in ("sum", "max", "min"):
            raise ValueError("changelog_stream supports sum, max and min")
    state_root = os.path.join(out_root, "state")
    scale = {o: decimal_scale(prepared, c) for o, (_, c) in aggs.items()}

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = f"run={run_id(batch)}"
        prev = None
        if batch_id > 0:
            prev_path = os.path.join(state_root, run, f"batch_id={batch_id - 1}")
            jp, fs = _fs(spark, prev_path)
            if not fs.exists(jp):
                raise FileNotFoundError(f"state of batch {batch_id - 1} is missing: {prev_path}")
            prev = spark.read.parquet(prev_path)
        batch = batch.persist()
        try:
            local = prefix_aggregate(batch, keys, order, aggs, n_buckets=n_buckets)
            totals = (batch.groupBy(*keys) if keys else batch.groupBy()).agg(
                *[_total(k, c).alias(o) for o, (k, c) in aggs.items()])
            if prev is None:
                out, state = local, totals
            elif not keys:
                # A global aggregate's state is one row: apply it as literals.
                row = prev.first()
                carry = {o: F.lit(row[o]) for o in aggs}
                out = local.select(*[c for c in local.columns if c not in aggs],
                                   *[_combine(k, carry[o], F.col(o), scale[o]).alias(o)
                                     for o, (k, _) in aggs.items()])
                state = totals.select(*[_combine(k, carry[o], F.col(o), scale[o]).alias(o)
                                        for o, (k, _) in aggs.items()])
            else:
                carry = prev.select(*keys, *[F.col(o).alias(f"_c_{o}") for o in aggs])
                cond = [local[k].eqNullSafe(carry[k]) for k in keys]
                out = local.join(carry, cond, "left").select(
                    *[local[c] for c in local.columns if c not in aggs],
                    *[_combine(k, F.col(f"_c_{o}"), local[o], scale[o]).alias(o)
                      for o, (k, _) in aggs.items()])
                both = totals.alias("t").join(
                    prev.alias("p"),
                    [F.col(f"t.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys], "full")
                state = both.select(
                    *[F.coalesce(F.col(f"t.{k}"), F.col(f"p.{k}")).alias(k) for k in keys],
                    *[_combine(k, F.col(f"p.{o}"), F.col(f"t.{o}"), scale[o]).alias(o)
                      for o, (k, _) in aggs.items()])
            result = finish(out) if finish else out
            (result.write.mode("overwrite")
                   .parquet(os.path.join(out_root, "changes", run, f"batch_id={batch_id}")))
            state.write.mode("overwrite").parquet(
                os.path.join(state_root, run, f"batch_id={batch_id}"))
            old, ofs = _fs(spark, os.path.join(state_root, run, f"batch_id={batch_id - 2}"))
            if ofs.exists(old):  # keep the last two states (replay needs N-1)
                ofs.delete(old, True)
        finally:
            batch.unpersist()

    return _writer(prepared, name, "append", checkpoint, trigger).foreachBatch(each).start()
