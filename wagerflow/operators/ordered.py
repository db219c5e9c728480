"""Order-dependent aggregates without a single-task window.

A running sum "after every record" or the previous sample of a series is a
window over the arrival order.  Partitioning that window by the key alone
puts a hot key (or, for a global average, every row) into one task.  Here the
order is cut into contiguous ranges instead:

1. one ``groupBy().count()`` of cells of the leading order column gives cut
   points with about equal row counts (a few numbers per cell on the driver);
   a value that alone is larger than a bucket is cut by the rest of the order
   (partition, offset).  The bucket id is a pure function of the row's order
   columns, so every branch of the plan and every retry agrees on it, and
   neither a hot key nor a single hot timestamp ends up in one task;
2. per bucket and key, the bucket's total (a small table: at most
   buckets x keys-per-bucket rows);
3. the carry into each bucket = prefix of those totals over earlier buckets
   (a window over the small table, at most ``n_buckets`` rows per key);
4. inside a bucket, an ordinary window partitioned by (bucket, key), whose
   size is bounded by the bucket size; the carry is joined back on
   (bucket, key) -- the big side is already partitioned that way, so only the
   small table moves (AQE broadcasts it when its measured size is small).

Supported kinds are associative: ``sum``, ``max``, ``min`` and ``last``
(last non-null value).  ``inclusive=False`` gives "strictly before" frames,
e.g. the previous value of a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerflow.session import default_parallelism

BUCKET = "_wf_bucket"
KINDS = ("sum", "max", "min", "last")


def _window_agg(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](c) if kind != "last" \
        else F.last(c, ignorenulls=True)


def _combine(kind: str, carry: Column, local: Column, scale: int | None = None) -> Column:
    if kind == "sum":
        if scale is not None:   # room for the carry digit, so that no decimal place is given up
            carry, local = (c.cast(f"decimal(37,{scale})") for c in (carry, local))
        return F.when(carry.isNull() & local.isNull(), F.lit(None)).otherwise(
            F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)))
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    return F.coalesce(local, carry)


def prefix_aggregate(df: DataFrame, keys: list[str], order: list[str],
                     aggs: dict[str, tuple[str, str]], *, inclusive: bool = True,
                     n_buckets: int | None = None, keep_bucket: bool = False,
                     materialize: bool = False) -> DataFrame:
    """Add one column per ``aggs`` entry ``out -> (kind, input column)``: the
    aggregate over all earlier rows of the same key in ``order`` (and the row
    itself when ``inclusive``).  ``order`` must be a total order per key.

    Batch only (the split points need a pass over the data).  With
    ``keep_bucket`` the bucket column stays in the output, and a later call
    with the same leading order column reuses it instead of re-sampling.

    The input feeds two branches (bucket totals and the in-bucket window)
    that Catalyst prunes differently, so an expensive input (a JSON parse)
    would be evaluated twice.  ``materialize=True`` writes the narrow
    bucketed input once with a reliable ``checkpoint()`` into the session's
    ``spark.checkpoint.dir`` (skipped when none is configured).
    """
    if df.isStreaming:
        raise ValueError("prefix_aggregate is batch-only; streams use update-mode aggregates")
    for kind, _ in aggs.values():
        if kind not in KINDS:
            raise ValueError(f"unsupported prefix kind {kind!r}")
    ranged = df if BUCKET in df.columns else with_order_buckets(df, order, n_buckets)
    if materialize and _checkpoint_dir(df.sparkSession):
        ranged = ranged.checkpoint(eager=True)
    # Join keys without NULLs: (filled value, is-null flag) per key.  The
    # in-bucket window is partitioned by exactly these columns, so the join
    # below reuses that partitioning instead of shuffling the big side again.
    types = {f.name: f.dataType for f in df.schema.fields}
    jk = [BUCKET]
    for i, k in enumerate(keys):
        ranged = (ranged.withColumn(f"_kf{i}", F.coalesce(F.col(k), _filler(types[k])))
                        .withColumn(f"_kn{i}", F.col(k).isNull()))
        jk += [f"_kf{i}", f"_kn{i}"]

    # 2. totals per (bucket, key); 'last' = value of the latest non-null row.
    tot = []
    for out, (kind, col) in aggs.items():
        c = F.col(col)
        if kind == "last":
            # A single order column keeps the buffer fixed-width (hash aggregate).
            key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
            tot.append(F.max_by(c, F.when(c.isNotNull(), key)).alias(out))
        else:
            tot.append(_window_agg(kind, c).alias(out))
    totals = ranged.groupBy(*jk).agg(*tot)

    # 3. carry = aggregate of the totals of strictly earlier buckets.
    kcols = jk[1:]
    wb = (Window.partitionBy(*kcols) if kcols else Window.partitionBy(F.lit(0))) \
        .orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*jk, *[_window_agg(kind, F.col(out)).over(wb).alias("_c_" + out)
                                 for out, (kind, _) in aggs.items()])

    # 4. local frame inside the bucket, then add the carry.
    wl = Window.partitionBy(*jk).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    local = ranged.select("*", *[_window_agg(kind, F.col(col)).over(wl).alias("_l_" + out)
                                 for out, (kind, col) in aggs.items()])
    joined = local.join(carry, jk, "left")
    passthrough = [c for c in df.columns if c != BUCKET] + ([BUCKET] if keep_bucket else [])
    return joined.select(
        *[F.col(c) for c in passthrough],
        *[_combine(kind, F.col("_c_" + out), F.col("_l_" + out), decimal_scale(df, col)).alias(out)
          for out, (kind, col) in aggs.items()])


def decimal_scale(df: DataFrame, col: str) -> int | None:
    """Decimal places of a column, None if it is not a decimal."""
    kind = df.schema[col].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else None


def _checkpoint_dir(spark) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 -- no SparkContext access (e.g. Spark Connect)
        return None


def _filler(dt: T.DataType) -> Column:
    """A non-null stand-in of the key's type (paired with an is-null flag)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.NumericType,)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(0).cast("timestamp").cast(dt)
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    if isinstance(dt, T.StructType):
        return F.struct(*[_filler(f.dataType).alias(f.name) for f in dt.fields])
    raise TypeError(f"unsupported key type {dt.simpleString()}")


ROWS_PER_BUCKET = 10_000_000
CELL = {"time": 3_600_000_000, "number": 1_000_000}   # micros / units of the leading column in a cell
_SUB = 1 << 20     # bucket ids between two cut points, for values that are cut by the rest of the order


def _position(df: DataFrame, col: str) -> tuple[Column, str]:
    """A whole number in the order of the column, and the kind of its cells."""
    c, dt = F.col(col), df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), "time"
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long"), "number"
    if isinstance(dt, T.IntegralType):
        return c.cast("long"), "number"
    return F.floor(c.cast("double")).cast("long"), "number"


def with_order_buckets(df: DataFrame, order: list[str], n_buckets: int | None = None,
                       rows_per_bucket: int = ROWS_PER_BUCKET, cell: int | None = None) -> DataFrame:
    """Add ``_wf_bucket``: the range of ``order`` the row falls in, of about equal row counts.

    The bucket count is ``max(parallelism, rows / rows_per_bucket)`` unless
    given.  One aggregate counts the rows of every value of the leading column
    and sums the counts by cell (an hour, or 10^6 units); the driver gets a
    row per cell.  Only if a cell is larger than a bucket, the same counts give
    the single values that are (fewer than there are buckets).  Cells are
    joined into buckets up to the wanted size, larger cells cut at equal
    distances, and larger values cut by the following order columns.
    """
    spark, lead, rest = df.sparkSession, order[0], [c for c in order[1:]]
    pos, kind = _position(df, lead)
    cell = cell or CELL[kind]
    tail = [_position(df, c)[0] for c in rest]
    values = df.select(pos.alias("p"), *[t.alias(f"r{i}") for i, t in enumerate(tail)]) \
        .groupBy("p").agg(F.count(F.lit(1)).alias("n"),
                          *[f(f"r{i}").alias(f"{x}{i}") for i in range(len(rest))
                            for x, f in (("lo", F.min), ("hi", F.max))])
    cells = values.where("p is not null").groupBy(F.floor(F.col("p") / cell).alias("c")).agg(
        F.sum("n").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).collect()
    cells.sort(key=lambda c: c.c)
    rows = sum(c.n for c in cells)
    n_buckets = n_buckets or max(default_parallelism(spark), -(-rows // rows_per_bucket))
    size = max(1, -(-rows // n_buckets))
    hot = {}
    if any(c.n > size for c in cells):   # values of more than a bucket: fewer than there are buckets
        hot = {v.p: v for v in values.where(F.col("n") > size).collect()}
    cuts, held = [x for p in hot for x in (p, p + 1)], 0
    for c in cells:
        if held and held + c.n > size:
            cuts.append(c.lo)
            held = 0
        if c.n > size:
            k = -(-(c.n - sum(v.n for p, v in hot.items() if c.lo <= p <= c.hi)) // size)
            cuts += [c.lo + (c.hi - c.lo + 1) * i // k for i in range(1, k)]
            cuts += [c.lo, c.hi + 1]
            held = 0
        else:
            held += c.n
    cuts = sorted(set(cuts))
    if not cuts:   # one bucket (empty input or few rows)
        return df.withColumn(BUCKET, F.lit(0).cast("long"))
    from pyspark.ml.feature import Bucketizer
    proxy = "_wf_pos"
    out = Bucketizer(splits=[float("-inf"), *map(float, cuts), float("inf")], inputCol=proxy, outputCol=BUCKET,
                     handleInvalid="keep").transform(df.withColumn(proxy, pos.cast("double")))
    sub = F.lit(0).cast("long")
    if hot:
        sub = F.when(pos.isin(list(hot)), F.coalesce(*[
            F.when(pos == p, _rest_of_order(tail, v, min(-(-v.n // size), _SUB))) for p, v in hot.items()])).otherwise(sub)
    return out.withColumn(BUCKET, F.col(BUCKET).cast("long") * _SUB + sub).drop(proxy)


def _rest_of_order(tail: list[Column], top, parts: int) -> Column:
    """Part (0 .. about ``parts``) of rows that share the leading value: equal
    ranges of the following columns, the first of them varying slowest."""
    out, left = F.lit(0).cast("long"), parts
    for i, c in enumerate(tail):
        span = top[f"hi{i}"] - top[f"lo{i}"] + 1
        k = min(left, span)
        out = out * k + F.floor((c - top[f"lo{i}"]).cast("decimal(38,0)") * k / span).cast("long")
        left = -(-left // k)
        if left <= 1:
            break
    return out


def previous_value(df: DataFrame, keys: list[str], order: list[str],
                   cols: dict[str, str], n_buckets: int | None = None,
                   keep_bucket: bool = False) -> DataFrame:
    """``lag`` by one row per key, across bucket edges: out -> input column.

    Rows whose input is NULL are skipped (the previous *non-null* value)."""
    return prefix_aggregate(df, keys, order, {o: ("last", c) for o, c in cols.items()},
                            inclusive=False, n_buckets=n_buckets, keep_bucket=keep_bucket)
