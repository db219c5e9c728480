"""Counter increases from mergeable summaries.

The summary of a series over a time cell is ``(first value, last value,
increase inside)``.  Two summaries of neighbouring cells merge into one: the
increases add up, and between them comes the step from the earlier one's last
value to the later one's first (a drop means that the counter restarted, so
the later value is the step).  The merge is associative, so cells can be
summarised anywhere, stored, and joined later in pieces of any size.

Samples are ordered inside ``(series, cell)`` only: one shuffle of the samples
by those keys, which divides a hot series by time, and a second one of the
summaries, one row per series and cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["metric", "series"]
# Cells divide hot series; summaries are a row per series and cell.
CELL = "1 hour"


def step(before: Column, now: Column) -> Column:
    """Increase from one reading to the next; none before the first."""
    return F.when(before.isNull(), F.lit(0.0)).when(now < before, now).otherwise(now - before)


def summarize(samples: DataFrame, cell: str = CELL) -> DataFrame:
    """``metric, series, cell (start), first, last, inside, samples`` of samples
    ``(metric, series, ts, value)``.  Samples without a value do not count;
    those at one instant are taken by value."""
    s = samples.filter(F.col("value").isNotNull() & F.col("ts").isNotNull()) \
        .select(*KEYS, F.window("ts", cell)["start"].alias("cell"), "ts", "value")
    w = Window.partitionBy(*KEYS, "cell").orderBy("ts", "value")
    s = s.withColumn("_p", F.lag("value").over(w)).withColumn("_n", F.lead("value").over(w))
    return s.groupBy(*KEYS, "cell").agg(
        F.max(F.when(F.col("_p").isNull(), F.col("value"))).alias("first"),
        F.max(F.when(F.col("_n").isNull(), F.col("value"))).alias("last"),
        F.sum(step(F.col("_p"), F.col("value"))).alias("inside"),
        F.count(F.lit(1)).alias("samples"))


def with_seams(summaries: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Add ``seam``: the step from the last value before the cell to its first
    one (0 for the first cell of a series, or of a ``within`` group)."""
    w = Window.partitionBy(*KEYS, *(within or [])).orderBy("cell")
    return summaries.withColumn("seam", step(F.lag("last").over(w), F.col("first")))


def merge(summaries: DataFrame, cell: str) -> DataFrame:
    """Summaries of larger cells (a multiple of those given)."""
    wide = with_seams(summaries.withColumn("_wide", F.window("cell", cell)["start"]), ["_wide"])
    return wide.groupBy(*KEYS, "_wide").agg(
        F.min_by("first", "cell").alias("first"), F.max_by("last", "cell").alias("last"),
        F.sum(F.col("inside") + F.col("seam")).alias("inside"), F.sum("samples").alias("samples")
    ).withColumnRenamed("_wide", "cell")


def cell_increases(summaries: DataFrame) -> DataFrame:
    """``metric, series, ts (cell start), delta``: what each cell adds to its
    series; the step into a cell belongs to the cell of the later sample."""
    return with_seams(summaries).select(*KEYS, F.col("cell").alias("ts"),
                                        (F.col("inside") + F.col("seam")).alias("delta"))
