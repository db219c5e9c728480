"""Metric time-series analytics over samples ``(metric, labels, ts, value)``.

The dashboards and alert rules express these as query text; here they are
DataFrame operators.  A series is ``metric`` + its label set; the label set
is carried as ``series`` = sorted ``map_entries(labels)`` so it can be a
grouping / join key (maps cannot).

Window convention: ``[window_start, window_end)``, epoch aligned.  A counter
delta is computed against the previous sample of the same series *before*
windowing (so no increase is lost at window edges) and attributed to the
window of the later sample; no extrapolation to the edges.

Counters go through mergeable summaries per series and time cell
(``operators.counters``); no pass over a global order is needed.

Sliding ranges (``range`` > ``step``) are evaluated by pre-aggregating per
step first, then expanding the small step table into the ``range/step``
windows it belongs to -- the raw samples are never multiplied.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerflow.functions.exact import exact_part, exact_sum, inexact_part, total
from wagerflow.operators import counters
from wagerflow.operators.ordered import previous_value

SERIES = "series"
WINDOW = ["window_start", "window_end"]


def seconds(duration: str) -> int:
    n, unit = duration.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
            "hours": 3600, "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def with_series(samples: DataFrame) -> DataFrame:
    if SERIES in samples.columns:
        return samples
    return samples.withColumn(SERIES, F.array_sort(F.map_entries("labels")))


def label(name: str) -> Column:
    """Label value; a missing label equals the empty string."""
    return F.coalesce(F.col("labels").getItem(name), F.lit(""))


def label_or_null(name: str) -> Column:
    return F.col("labels").getItem(name)


def select_series(samples: DataFrame, metric: str, equal: dict[str, str] | None = None,
                  not_equal: dict[str, str] | None = None) -> DataFrame:
    """Instant selector ``metric{k="v", k2!="v2"}`` over samples, or over a
    ``sources.samples.SampleStore``, which resolves it on its dictionary."""
    if not isinstance(samples, DataFrame):
        return samples.select_series(metric, equal, not_equal)
    cond = F.col("metric") == F.lit(metric)
    for k, v in (equal or {}).items():
        cond = cond & (label(k) == F.lit(v))
    for k, v in (not_equal or {}).items():
        cond = cond & (label(k) != F.lit(v))
    return with_series(samples.filter(cond))


def counter_deltas(samples: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Add ``delta``: increase since the previous sample of the series; a
    drop means the counter restarted, so the new value is the increase.  The
    first sample of a series contributes 0."""
    s = with_series(samples)
    prev = previous_value(s, ["metric", SERIES], ["ts"], {"_prev": "value"}, n_buckets)
    d = F.when(F.col("_prev").isNull(), F.lit(0.0)) \
        .when(F.col("value") < F.col("_prev"), F.col("value")) \
        .otherwise(F.col("value") - F.col("_prev"))
    return prev.withColumn("delta", d).drop("_prev")


def _windowed(df: DataFrame, range_: str, step: str | None, aggs: dict[str, Column],
              merge: dict[str, Column]) -> DataFrame:
    """Aggregate per series and window.  ``aggs`` are partial aggregates per
    step bucket; ``merge`` (same names) combines them over the buckets of a
    sliding window."""
    # Labels are rebuilt from the ``series`` key after aggregating, so every
    # aggregation buffer stays fixed-width (hash aggregate, no sort).
    keys = ["metric", SERIES, F.map_from_entries(SERIES).alias("labels")]
    step = step or range_
    per_step = df.groupBy("metric", SERIES, F.window("ts", step).alias("w")).agg(
        *[e.alias(k) for k, e in aggs.items()])
    if step == range_:
        return per_step.select(*keys, F.col("w.start").alias("window_start"),
                               F.col("w.end").alias("window_end"), *aggs.keys())
    r, s = seconds(range_), seconds(step)
    if r % s:
        raise ValueError("range must be a multiple of step")
    k = F.explode(F.sequence(F.lit(0), F.lit(r // s - 1))).alias("_k")
    shifted = per_step.select("*", k).withColumn(
        "window_end", F.col("w.end") + F.make_dt_interval(secs=F.col("_k") * s))
    return (shifted.groupBy("metric", SERIES, "window_end")
                   .agg(*[m.alias(k) for k, m in merge.items()])
                   .withColumn("window_start",
                               F.col("window_end") - F.make_dt_interval(secs=F.lit(r)))
                   .select(*keys, *WINDOW, *merge.keys()))


def _cell(step: str) -> str:
    """The cell that counters are summarised over: the longest common part of
    the step and an hour, so that cells tile the steps."""
    return f"{math.gcd(seconds(step), seconds(counters.CELL))} seconds"


def increase(samples: DataFrame, range_: str = "5 minutes", step: str | None = None,
             n_buckets: int | None = None) -> DataFrame:
    """``increase(counter[range])`` per series and window -> ``value``.
    ``n_buckets`` is accepted for earlier callers and not used: cells divide
    the order."""
    cells = counters.summarize(with_series(samples), _cell(step or range_))
    return increase_of(cells, range_, step)


def increase_of(summaries: DataFrame, range_: str = "5 minutes", step: str | None = None) -> DataFrame:
    """``increase`` from counter summaries, also stored ones; their cells must
    divide the step."""
    d = counters.cell_increases(summaries)
    return _windowed(d, range_, step, {"value": F.sum("delta")}, {"value": F.sum("value")})


def rate(samples: DataFrame, range_: str = "5 minutes", step: str | None = None,
         n_buckets: int | None = None) -> DataFrame:
    """``rate(counter[range])``: increase per second of the range."""
    inc = increase(samples, range_, step)
    return inc.withColumn("value", F.col("value") / F.lit(float(seconds(range_))))


def avg_over_time(samples: DataFrame, range_: str = "5 minutes",
                  step: str | None = None) -> DataFrame:
    """``avg_over_time(gauge[range])``; the sum does not depend on the order of
    addition (see ``functions.exact``)."""
    v = F.col("value")
    s = with_series(samples)
    out = _windowed(s, range_, step,
                    {"_s": F.sum(exact_part(v)), "_f": F.sum(inexact_part(v)), "_n": F.count(v)},
                    {"_s": F.sum("_s"), "_f": F.sum("_f"), "_n": F.sum("_n")})
    return out.withColumn("value", total(F.col("_s"), F.col("_f")) / F.col("_n")).drop("_s", "_f", "_n")


# How far back an instant value may lie before the series counts as gone.
LOOKBACK = "5 minutes"


def instant_vector(samples: DataFrame, step: str = "5 minutes",
                   lookback: str = LOOKBACK) -> DataFrame:
    """Value of every series at the end of each step: its last sample within
    ``lookback`` before it, also from earlier steps; none -> no value.

    The last sample of each step (``max_by``, a partial aggregate) is carried
    into the following steps it can reach; raw samples are not multiplied.
    """
    s, keys = with_series(samples), ["metric", SERIES]
    width, back = seconds(step), seconds(lookback)
    last = s.groupBy(*keys, F.window("ts", step).alias("w")).agg(
        F.max("ts").alias("_t"), F.max_by("value", "ts").alias("value"))
    reach = F.explode(F.sequence(F.lit(0), F.lit(-(-back // width)))).alias("_k")
    seen = last.select(*keys, "_t", "value", F.col("w.end").alias("_end"), reach) \
        .withColumn("window_end", F.col("_end") + F.make_dt_interval(secs=F.col("_k") * width)) \
        .filter(F.col("_t") >= F.col("window_end") - F.make_dt_interval(secs=F.lit(back)))
    return seen.groupBy(*keys, "window_end").agg(F.max_by("value", "_t").alias("value")).select(
        *keys, F.map_from_entries(SERIES).alias("labels"),
        (F.col("window_end") - F.make_dt_interval(secs=F.lit(width))).alias("window_start"),
        "window_end", "value")


def aggregate(vector: DataFrame, fn: str = "sum", by: list[str] | None = None) -> DataFrame:
    """``sum|avg|min|max|count (vector) by (labels)`` per window."""
    by = by or []
    v = F.col("value")
    agg = {"sum": exact_sum(v), "avg": exact_sum(v) / F.count(v), "min": F.min(v),
           "max": F.max(v), "count": F.count(v)}[fn]
    out = vector.groupBy(*WINDOW, *[label(b).alias(b) for b in by]).agg(
        agg.cast("double").alias("value"))
    labels = F.create_map(*[x for b in by for x in (F.lit(b), F.col(b))]) if by else \
        F.create_map().cast("map<string,string>")
    return out.withColumn("labels", labels).withColumn(SERIES, F.array_sort(F.map_entries(
        "labels"))).drop(*by)


def _ieee_div(a: Column, b: Column) -> Column:
    """a / b with IEEE semantics for b = 0 (NaN or +/-Inf, as PromQL)."""
    return (F.when(b != 0, a / b)
             .when(a.isNull() | b.isNull(), F.lit(None))
             .when((a == 0) | F.isnan(a), F.lit(float("nan")))
             .otherwise(F.signum(a) * F.lit(float("inf"))))


def binary_op(left: DataFrame, right: DataFrame, op: str,
              on: list[str] | None = None) -> DataFrame:
    """``left <op> on(labels) right``: one-to-one per window on the matching
    labels (all labels when ``on`` is None), then the arithmetic.

    Two series of one side with the same matching labels are an error, as in
    the query language: the result would depend on which of them is taken.
    The check groups by the join keys, so it adds no shuffle to the join.
    """
    def one(side: DataFrame, name: str, v: str) -> DataFrame:
        key = [label(k).alias(f"_on_{k}") for k in on] if on is not None else [F.col(SERIES).alias("_on")]
        per = side.select(*WINDOW, *key, SERIES, "value").groupBy(
            *WINDOW, *[f"_on_{k}" for k in on or []] if on is not None else ["_on"]).agg(
            F.count(F.lit(1)).alias("_n"), F.min(SERIES).alias(f"_s{v}"), F.min("value").alias(v))
        unique = F.when(F.col("_n") > 1, F.raise_error(F.lit(
            f"several series on the {name} side have the same matching labels"))).otherwise(F.col(v))
        return per.withColumn(v, unique).drop("_n")

    keys = WINDOW + ([f"_on_{k}" for k in on] if on is not None else ["_on"])
    j = one(left, "left", "_a").join(one(right, "right", "_b").drop("_s_b"), keys)
    j = j.withColumnRenamed("_s_a", SERIES).withColumn("labels", F.map_from_entries(SERIES)) \
        .drop(*[k for k in keys if k not in WINDOW])
    a, b = F.col("_a"), F.col("_b")
    val = {"+": a + b, "-": a - b, "*": a * b, "/": _ieee_div(a, b)}[op]
    return j.withColumn("value", val).drop("_a", "_b")


def ratio_of_increases(samples: DataFrame, numerator: str, denominator: str,
                       range_: str = "5 minutes", by: list[str] | None = None,
                       with_numerator: bool = False) -> DataFrame:
    """``sum by (..) (rate(numerator[r])) / sum by (..) (rate(denominator[r]))``.

    Both counters go through one ``increase`` and one conditional sum, so the
    samples are read and ordered once.  ``with_numerator`` adds the numerator
    to the denominator: the share of one of two counters, as in a hit ratio.
    Groups that lack one of the counters have no value, as in a match.
    """
    by = by or []
    inc = increase(samples.filter(F.col("metric").isin(numerator, denominator)), range_)
    part = lambda m: exact_sum(F.when(F.col("metric") == m, F.col("value")))
    per = inc.groupBy(*WINDOW, *[label(b).alias(b) for b in by]).agg(
        part(numerator).alias("_a"), part(denominator).alias("_b"))
    labels = F.create_map(*[x for b in by for x in (F.lit(b), F.col(b))]) if by else F.create_map()
    whole = F.col("_a") + F.col("_b") if with_numerator else F.col("_b")
    return (per.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
               .select(*WINDOW, labels.cast("map<string,string>").alias("labels"),
                       _ieee_div(F.col("_a"), whole).alias("value")))


def fraction(vector: DataFrame, equal: dict[str, str]) -> DataFrame:
    """``sum(v{selector}) / sum(v)`` per window in one aggregate (the two
    sums share every input row, so no join of two vectors is needed).
    Windows without a selected series are absent, as with vector matching."""
    sel = None
    for k, v in equal.items():
        c = label(k) == F.lit(v)
        sel = c if sel is None else sel & c
    per = vector.groupBy(*WINDOW).agg(
        F.sum(F.when(sel, F.col("value"))).alias("_a"), F.sum("value").alias("_b"))
    return (per.filter(F.col("_a").isNotNull())
               .select(*WINDOW, _ieee_div(F.col("_a"), F.col("_b")).alias("value"),
                       F.create_map().cast("map<string,string>").alias("labels")))


def scalar_op(vector: DataFrame, op: str, x: float) -> DataFrame:
    """``x <op> vector`` with a scalar on the left (e.g. ``1 - vector``)."""
    v, s = F.col("value"), F.lit(float(x))
    val = {"+": s + v, "-": s - v, "*": s * v, "/": _ieee_div(s, v)}[op]
    return vector.withColumn("value", val)


def comparison(v: Column, op: str, threshold: float) -> Column:
    t = F.lit(float(threshold))
    return {">": v > t, ">=": v >= t, "<": v < t, "<=": v <= t, "==": v == t,
            "!=": v != t}[op]


def histogram_mean(samples: DataFrame, base: str, range_: str = "5 minutes",
                   step: str | None = None) -> DataFrame:
    """``rate(base_sum[r]) / rate(base_count[r])`` per label set.

    One increase over both counters, then one conditional aggregate per
    (labels, window) -- the join of the two vectors is not needed because
    both sides share the label set.  The range cancels in the ratio.
    """
    both = with_series(samples.filter(F.col("metric").isin(f"{base}_sum", f"{base}_count")))
    inc = increase(both, range_, step)
    per = inc.groupBy(SERIES, *WINDOW).agg(
        F.sum(F.when(F.col("metric") == f"{base}_sum", F.col("value"))).alias("_a"),
        F.sum(F.when(F.col("metric") == f"{base}_count", F.col("value"))).alias("_b"))
    return (per.withColumn("labels", F.map_from_entries(SERIES))
               .filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
               .withColumn("value", _ieee_div(F.col("_a"), F.col("_b")))
               .withColumn("metric", F.lit(f"{base}_mean")).drop("_a", "_b"))


def delay_histogram(df: DataFrame, delay_seconds: Column, buckets: list[float],
                    step: str = "1 minute", time_col: str = "timestamp") -> DataFrame:
    """Cumulative ``le`` buckets of a delay per step (histogram ``_bucket``),
    plus ``_sum`` and ``_count`` -- one pass, one partial aggregate."""
    d = delay_seconds
    aggs = [F.count(F.when(d <= F.lit(float(b)), 1)).alias(f"le_{b:g}") for b in buckets]
    return df.groupBy(F.window(time_col, step).alias("w")).agg(
        *aggs, F.count(d).alias("count"), exact_sum(d).alias("sum")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                *[f"le_{b:g}" for b in buckets], "count", "sum")


def consumer_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Per source partition: records after the committed offset.

    ``committed`` is ``(partition, committed_offset)``; AQE broadcasts it if
    its measured size is small."""
    j = records.join(committed, "partition", "left")
    behind = F.col("committed_offset").isNull() | (F.col("offset") > F.col("committed_offset"))
    return j.groupBy("partition").agg(F.count(F.when(behind, 1)).alias("lag"),
                                      F.max("offset").alias("end_offset"))
