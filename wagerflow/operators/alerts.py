"""Sustained-threshold alerts: ``expr <op> threshold for <duration>``.

Gaps and islands per series: a sample is *hit* when the condition holds.  A
run is a longest row of hits in which no sample lies further from the one
before than the series can go without a value.  A run is active from its
first hit; it fires at its first hit at least ``for`` after that.  Output: one
row per firing run with label-templated text.

Runs are found in time cells and then merged.  Inside a cell, runs with
samples before and after them are whole.  Only the run that a cell begins with
and the one that it ends with can go on in another cell: they are joined along
the cells of the series, one or two rows each.  So samples are ordered inside
``(series, cell)`` only, and what an evaluation leaves open is one row per
series, which the next one takes in before its new samples.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerflow.operators import metrics as M
from wagerflow.session import written

# Cells divide hot series; a cell has two rows at most in the merge of runs.
CELL = "1 hour"
KEYS = ["alert", "metric", M.SERIES]


@dataclass(frozen=True)
class AlertRule:
    name: str
    op: str
    threshold: float
    for_: str
    severity: str
    summary: str
    description: str | None = None
    # Builds the evaluated vector (metric, series, labels, ts, value) from samples.
    expr: Callable[[DataFrame], DataFrame] | None = None


def _template(text: str, labels: Column, value: Column) -> Column:
    """Render ``{{ $labels.x }}`` / ``{{ $value }}`` placeholders."""
    parts = re.split(r"\{\{\s*(\$labels\.\w+|\$value)\s*\}\}", text)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        elif p == "$value":
            cols.append(value.cast("string"))
        else:
            cols.append(F.coalesce(labels.getItem(p.split(".", 1)[1]), F.lit("")))
    return F.concat(*cols) if cols else F.lit("")


def _points(points: DataFrame, rule: AlertRule, max_gap: str) -> DataFrame:
    """``alert, metric, series, ts, value`` with the rule's condition and times."""
    p = M.with_series(points)
    metric = F.col("metric") if "metric" in p.columns else F.lit(None).cast("string")
    hit = F.coalesce(M.comparison(F.col("value"), rule.op, rule.threshold), F.lit(False))
    return p.select(F.lit(rule.name).alias("alert"), metric.alias("metric"), M.SERIES, "ts", "value",
                    hit.cast("int").alias("_hit"), F.lit(M.seconds(rule.for_)).alias("_hold"),
                    F.lit(M.seconds(max_gap)).alias("_gap"))


def _runs(points: DataFrame) -> DataFrame:
    """The runs of each cell, of hits and of other samples: ``cell, start,
    stop, hit, samples, start_value``, whether the cell begins / ends with it,
    and the first sample that is due by the run's own start."""
    p = points.withColumn("cell", F.window("ts", CELL)["start"])
    part = Window.partitionBy(*KEYS, "cell")
    w = part.orderBy("ts")
    cut = ~((F.lag("_hit").over(w) == F.col("_hit"))
            & (F.col("ts") <= F.lag("ts").over(w) + F.make_dt_interval(secs=F.col("_gap"))))
    p = p.withColumn("_cut", F.coalesce(cut, F.lit(True)).cast("int"))
    p = p.withColumn("_run", F.sum("_cut").over(w)) \
        .withColumn("_from", F.last(F.when(F.col("_cut") == 1, F.col("ts")), ignorenulls=True).over(w)) \
        .withColumn("_last", F.max("ts").over(part))
    due = F.when(F.col("ts") >= F.col("_from") + F.make_dt_interval(secs=F.col("_hold")), F.col("ts"))
    return p.groupBy(*KEYS, "cell", "_run").agg(
        F.min("ts").alias("start"), F.max("ts").alias("stop"), F.max("_hit").alias("hit"),
        F.count(F.lit(1)).alias("samples"), F.min_by("value", "ts").alias("start_value"),
        F.min(due).alias("due"), F.min_by("value", due).alias("due_value"),
        (F.max("ts") == F.max("_last")).alias("closes"), F.max("_hold").alias("hold"), F.max("_gap").alias("gap")
    ).withColumn("opens", F.col("_run") == 1).drop("_run")


# What an evaluation leaves behind, one row per series: its last sample and,
# if that is a hit, the run that it belongs to.
STATE = (
    "alert string, metric string, series array<struct<key: string, value: string>>, hit int, active_since timestamp,"
    " last_true timestamp, samples long, firing_since timestamp, value double, hold int, gap int")
_ISLAND = [*KEYS, "active_since", "last_true", "samples", "firing_since", "value"]


def _islands(points: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(runs of hits, those of the state included where they go on; the new
    state).  Points are ``_points`` of one or more rules."""
    runs = _runs(points)
    whole = runs.filter((F.col("hit") == 1) & ~F.col("opens") & ~F.col("closes")).select(
        *KEYS, F.col("start").alias("active_since"), F.col("stop").alias("last_true"), "samples",
        F.col("due").alias("firing_since"), F.col("due_value").alias("value"))
    edge = runs.filter(F.col("opens") | F.col("closes")).select(
        *KEYS, "cell", "start", "stop", "hit", "samples", "start_value", "due", "due_value", "hold", "gap")
    if state is not None:
        edge = edge.unionByName(state.select(
            *KEYS, F.lit(None).cast("timestamp").alias("cell"), F.col("active_since").alias("start"),
            F.col("last_true").alias("stop"), "hit", "samples", F.lit(None).cast("double").alias("start_value"),
            F.col("firing_since").alias("due"), F.col("value").alias("due_value"), "hold", "gap"))
    w = Window.partitionBy(*KEYS).orderBy("stop", "start")
    goes_on = ((F.col("hit") == 1) & (F.lag("hit").over(w) == 1)
               & ~F.lag("cell").over(w).eqNullSafe(F.col("cell"))
               & (F.col("start") <= F.lag("stop").over(w) + F.make_dt_interval(secs=F.col("gap"))))
    edge = edge.withColumn("_on", F.coalesce(goes_on, F.lit(False)))
    edge = edge.withColumn("active_since", F.last(F.when(~F.col("_on"), F.col("start")), ignorenulls=True).over(w)) \
        .withColumn("_before", F.lag("stop").over(w)).withColumn("_newest", F.lead("stop").over(w).isNull())
    at = F.col("active_since") + F.make_dt_interval(secs=F.col("hold"))
    edge = edge.withColumn("_due_at", at)
    fires = (F.col("hit") == 1) & (F.col("stop") >= F.col("_due_at")) & (~F.col("_on") | (F.col("_before") < F.col("_due_at")))
    kind = F.when(~fires, "no").when(~F.col("_on"), "own").when(F.col("start") >= F.col("_due_at"), "start").otherwise("inside")
    edge = edge.withColumn("_kind", kind)
    # the first sample that is due inside a run that came from another cell: one cell of each such run is looked into
    inside = edge.filter("_kind = 'inside'").select(*KEYS, "cell", "active_since", "_due_at", F.col("stop").alias("_stop"))
    p = points.withColumn("cell", F.window("ts", CELL)["start"]).filter("_hit = 1")
    found = p.select(*KEYS, "cell", "ts", "value").alias("p").join(
        inside.alias("i"), ["alert", M.SERIES, "cell"]).filter(
        F.col("p.metric").eqNullSafe(F.col("i.metric")) & (F.col("ts") >= F.col("_due_at")) & (F.col("ts") <= F.col("_stop"))) \
        .groupBy("alert", F.col("p.metric").alias("metric"), M.SERIES, "active_since").agg(
        F.min("ts").alias("firing_since"), F.min_by("value", "ts").alias("value"))
    pieces = edge.filter("hit = 1").select(
        *KEYS, "active_since", F.col("stop").alias("last_true"), "samples",
        F.when(F.col("_kind") == "own", F.col("due")).when(F.col("_kind") == "start", F.col("start")).alias("firing_since"),
        F.when(F.col("_kind") == "own", F.col("due_value")).when(F.col("_kind") == "start", F.col("start_value")).alias("value"))
    none = lambda kind: F.lit(None).cast(kind)
    pieces = pieces.unionByName(found.select(*KEYS, "active_since", none("timestamp").alias("last_true"), F.lit(0).cast("long").alias("samples"),
                                             "firing_since", "value"))
    joined = pieces.groupBy(*KEYS, "active_since").agg(
        F.max("last_true").alias("last_true"), F.sum("samples").alias("samples"),
        F.min("firing_since").alias("firing_since"), F.min_by("value", "firing_since").alias("value"))
    newest = edge.filter("_newest").select(*KEYS, "hit", "active_since", F.col("stop").alias("last_true"), "hold", "gap")
    same = [newest[k].eqNullSafe(joined[k]) for k in ("alert", "metric")] + [newest[k] == joined[k] for k in (M.SERIES, "active_since")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    left = newest.join(joined, cond & (newest["hit"] == 1), "left").select(
        *[newest[c] for c in (*KEYS, "hit", "active_since", "last_true")],
        F.coalesce(joined["samples"], F.lit(1).cast("long")).alias("samples"), joined["firing_since"], joined["value"], newest["hold"], newest["gap"])
    return whole.select(*_ISLAND).unionByName(joined.select(*_ISLAND)), left


def _texts(islands: DataFrame, rules: list[AlertRule]) -> DataFrame:
    """The alerts of the runs that fire."""
    out = islands.filter(F.col("firing_since").isNotNull()).withColumn("labels", F.map_from_entries(M.SERIES))

    def text(field: Callable[[AlertRule], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("alert") == r.name, field(r)) for r in rules])

    labels, value = F.col("labels"), F.col("value")
    return out.select(
        "alert", text(lambda r: F.lit(r.severity)).alias("severity"), "labels", "active_since",
        "firing_since", "last_true", "samples", "value",
        text(lambda r: _template(r.summary, labels, value)).alias("summary"),
        text(lambda r: _template(r.description, labels, value) if r.description
             else F.lit(None).cast("string")).alias("description"))


def sustained_alerts(points: DataFrame, rule: AlertRule, n_buckets: int | None = None,
                     max_gap: str = M.LOOKBACK) -> DataFrame:
    """Firing alert instances of ``rule`` over ``points`` (series, labels, ts,
    value): ``alert, severity, labels, active_since, firing_since, last_true,
    samples, value, summary, description``.

    ``max_gap``: a series without a point for longer has no value at some
    evaluation in between, which ends its run (the step, for points on a
    grid; the lookback, for raw samples).  ``n_buckets`` is accepted for
    earlier callers and not used: cells divide the order.
    """
    return _texts(_islands(_points(points, rule, max_gap), None)[0], [rule])


def advance(points: DataFrame, rule: AlertRule, state: DataFrame | None = None,
            max_gap: str = M.LOOKBACK) -> tuple[DataFrame, DataFrame]:
    """One evaluation over new points only: ``(alerts, state)``.

    ``points`` are later than all that the state has seen; ``state`` is what
    the evaluation before returned (``STATE``; None at first), and the one
    returned is to be stored for the next.  An alert that goes on comes again
    under its ``active_since`` with its new ``last_true`` and ``samples``:
    the latest row of ``(alert, labels, active_since)`` counts.  Evaluations
    that cut the points anywhere give together what one gives over all.
    """
    islands, left = _islands(_points(points, rule, max_gap), state)
    return _texts(islands, [rule]), left


def rule_points(vector: DataFrame) -> DataFrame:
    """Evaluation points of a windowed vector: the value at each window end."""
    return vector.withColumnRenamed("window_end", "ts").drop("window_start")


# The reference's alert rules (name, expression, threshold,
# duration, severity, text).  Expressions are composed from metric operators
# and evaluated every 30 s.
EVAL_STEP = "30 seconds"


def _instant(metric: str, **eq: str) -> Callable[[DataFrame], DataFrame]:
    return lambda s: rule_points(M.instant_vector(M.select_series(s, metric, eq), EVAL_STEP))


def _ratio(num: str, den: str) -> Callable[[DataFrame], DataFrame]:
    return lambda s: rule_points(M.binary_op(
        M.instant_vector(M.select_series(s, num), EVAL_STEP),
        M.instant_vector(M.select_series(s, den), EVAL_STEP), "/"))


REFERENCE_RULES = [
    AlertRule("KafkaHighLag", ">", 10000, "5 minutes", "warning",
              "Kafka consumer lag is high",
              "Consumer group {{ $labels.consumergroup }} has lag of {{ $value }} messages",
              _instant("kafka_consumergroup_lag_sum")),
    AlertRule("PostgreSQLHighConnections", ">", 0.8, "5 minutes", "warning",
              "PostgreSQL connection pool is nearly full", None,
              _ratio("pg_stat_database_numbackends", "pg_settings_max_connections")),
    AlertRule("FlinkJobFailed", "==", 1, "1 minute", "critical",
              "Flink job {{ $labels.job_name }} has failed", None,
              _instant("flink_jobmanager_job_status", status="FAILED")),
    AlertRule("AirflowDAGFailed", ">", 0, "5 minutes", "warning",
              "Airflow DAG {{ $labels.dag_id }} has failed runs", None,
              lambda s: rule_points(M.increase(M.select_series(s, "airflow_dagrun_failed"),
                                               "5 minutes", EVAL_STEP))),
    AlertRule("HighCPUUsage", ">", 0.8, "5 minutes", "warning",
              "Container {{ $labels.name }} has high CPU usage", None,
              lambda s: rule_points(M.rate(M.select_series(
                  s, "container_cpu_usage_seconds_total"), "5 minutes", EVAL_STEP))),
    AlertRule("HighMemoryUsage", ">", 0.9, "5 minutes", "warning",
              "Container {{ $labels.name }} has high memory usage", None,
              _ratio("container_memory_usage_bytes", "container_spec_memory_limit_bytes")),
]


def evaluate_rules(samples: DataFrame, rules: list[AlertRule] = REFERENCE_RULES,
                   n_buckets: int | None = None) -> DataFrame:
    """All firing instances of ``rules`` over metric samples, a DataFrame or a
    ``SampleStore`` (of which each rule reads its metrics only); the points of
    all rules go through the search for runs together."""
    parts = [_points(r.expr(samples) if r.expr else samples, r, EVAL_STEP if r.expr else M.LOOKBACK)
             for r in rules]
    points = parts[0]
    for p in parts[1:]:
        points = points.unionByName(p)
    # runs and their firing samples are two reads of the points; the vectors are dearer than a written copy
    return _texts(_islands(written(points, "rule-points"), None)[0], rules)
