"""Queries over ``/root/testdata``-style tables (see sources.testdata).

Output hygiene shared with the oracle SQL: every computed column is aliased,
window bounds and timestamps are ISO strings, money is summed exactly and
cast to DOUBLE at the edge, counts are BIGINT.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerflow.functions.timefmt import ISO_MICROS, ISO_SECONDS
from wagerflow.operators import aggregates as agg
from wagerflow.operators import alerts as al
from wagerflow.operators import export as ex
from wagerflow.operators import flatten as fl
from wagerflow.operators import metrics as M
from wagerflow.operators import upsert as up
from wagerflow.plans.registry import ORACLE, QUERIES, query
from wagerflow.schemas import VERSION_COLUMNS
from wagerflow.session import scratch_root, written
from wagerflow.sources.samples import SampleStore
from wagerflow.sources.testdata import (
    BETS_COUNTER, STAKE_GAUGE, STAKE_SUM_COUNTER, bet_records, metric_samples,
)

__all__ = ["QUERIES", "ORACLE", "FLAGSHIP"]

FLAGSHIP = "game_window_counts"


def _iso(col: str) -> F.Column:
    return F.date_format(F.col(col), ISO_SECONDS).alias(col)


def _uuid_sql(number: str) -> str:
    return (f"regexp_replace(lpad(CAST({number} AS VARCHAR), 32, '0'), "
            r"'(.{8})(.{4})(.{4})(.{4})(.{12})', '\1-\2-\3-\4-\5')")


def _exact_sql(value: str) -> str:
    """The number as it is spelled; no digit of it is rounded away."""
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15))"


# Shared SQL fragments: the same record mapping as sources.testdata.
_FLAT_SQL = """
  SELECT event_id, ts, user_id, value,
         (event_id % 97 = 0 OR event_id % 89 = 0) AS bad,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'invalid' ELSE event_type END AS key,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 0 ELSE 1 END AS n
  FROM events"""


@query("game_window_counts", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT strftime(time_bucket(INTERVAL '10 seconds', ts), '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds',
                '%Y-%m-%dT%H:%M:%S') AS window_end,
       key AS game, CAST(sum(n) AS BIGINT) AS count
FROM r GROUP BY 1, 2, 3
""")
def q_game_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agg.game_window_counts(bet_records(spark, sf_dir, "flat"))
    return counts.select(_iso("window_start"), _iso("window_end"), "game", "count")


def _iso_window_sql(width: str) -> str:
    return (f"strftime(time_bucket(INTERVAL '{width}', ts), '%Y-%m-%dT%H:%M:%S') AS window_start, "
            f"strftime(time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}', "
            f"'%Y-%m-%dT%H:%M:%S') AS window_end")


@query("game_count_messages", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT {_iso_window_sql('10 seconds')},
       CAST(json_object('game', key, 'count', CAST(sum(n) AS BIGINT)) AS VARCHAR) AS value
FROM r GROUP BY time_bucket(INTERVAL '10 seconds', ts), key
""")
def q_game_count_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agg.game_window_counts(bet_records(spark, sf_dir, "flat"))
    msgs = agg.game_count_messages(counts)
    return msgs.select(_iso("window_start"), _iso("window_end"), "value")


@query("top_games_ranked", sql=f"""
WITH r AS ({_FLAT_SQL}),
c AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, key AS game, CAST(sum(n) AS BIGINT) AS count
      FROM r GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY count DESC, game ASC) AS rank FROM c)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       game, count, CAST(rank AS BIGINT) AS rank
FROM k WHERE rank <= 3
""")
def q_top_games_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agg.game_window_counts(bet_records(spark, sf_dir, "flat"), window="1 hour")
    top = agg.top_games_ranked(counts, k=3)
    return top.select(_iso("window_start"), _iso("window_end"), "game", "count",
                      F.col("rank").cast("long").alias("rank"))


@query("status_counts", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT key AS status, CAST(sum(n) AS BIGINT) AS count FROM r GROUP BY 1
""")
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.status_counts(bet_records(spark, sf_dir, "flat"))


@query("status_counts_nested", sql="""
SELECT CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'invalid'
            ELSE ['win', 'lose', 'pending'][event_id % 3 + 1] END AS status,
       CAST(sum(CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 0 ELSE 1 END) AS BIGINT)
         AS count
FROM events GROUP BY 1
""")
def q_status_counts_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.status_counts(bet_records(spark, sf_dir, "nested"), shape="nested")


@query("status_changelog", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset", key AS status,
       CAST(sum(n) OVER (PARTITION BY key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS count
FROM r
""")
def q_status_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.status_changelog(bet_records(spark, sf_dir, "flat"))


@query("average_bet", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT 'avg_bet' AS metric,
       CASE WHEN sum(n) > 0 THEN
         CAST(sum(CASE WHEN NOT bad THEN {_exact_sql('value')} END) AS DOUBLE) / sum(n)
       ELSE 0.0 END AS value,
       CAST(sum(n) AS BIGINT) AS n
FROM r
""")
def q_average_bet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.average_bet(bet_records(spark, sf_dir, "flat"))


@query("average_changelog", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset", 'avg_bet' AS metric,
       CASE WHEN sum(n) OVER o > 0 THEN
         CAST(sum(CASE WHEN NOT bad THEN {_exact_sql('value')} END) OVER o AS DOUBLE)
           / sum(n) OVER o
       ELSE 0.0 END AS value
FROM r WINDOW o AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)
""")
def q_average_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.average_changelog(bet_records(spark, sf_dir, "flat"))


@query("active_users_2min", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT {_iso_window_sql('2 minutes')}, CAST(count(DISTINCT user_id) AS BIGINT) AS active_users
FROM r WHERE NOT bad GROUP BY 1, 2
""")
def q_active_users_2min(spark: SparkSession, sf_dir: str) -> DataFrame:
    au = agg.active_users(bet_records(spark, sf_dir, "flat"))
    return au.select(_iso("window_start"), _iso("window_end"), "active_users")


@query("active_users_null_user", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT {_iso_window_sql('2 minutes')},
       CAST(count(DISTINCT CASE WHEN event_id % 79 = 0 THEN '<null>'
                                ELSE CAST(user_id AS VARCHAR) END) AS BIGINT) AS active_users
FROM r WHERE NOT bad GROUP BY 1, 2
""")
def q_active_users_null_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A JSON-null user is one user (count(DISTINCT) would skip it).
    au = agg.active_users(bet_records(spark, sf_dir, "flat", null_users=True))
    return au.select(_iso("window_start"), _iso("window_end"), "active_users")


@query("active_users_messages", sql=f"""
WITH r AS ({_FLAT_SQL}),
a AS (SELECT time_bucket(INTERVAL '2 minutes', ts) AS w, count(DISTINCT user_id) AS u
      FROM r WHERE NOT bad GROUP BY 1)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       CAST(json_object('window_start', strftime(w, '%Y-%m-%dT%H:%M:%S'),
                        'window_end', strftime(w + INTERVAL '2 minutes', '%Y-%m-%dT%H:%M:%S'),
                        'active_users', CAST(u AS BIGINT)) AS VARCHAR) AS value
FROM a
""")
def q_active_users_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    au = agg.active_users(bet_records(spark, sf_dir, "flat"))
    return agg.active_users_messages(au).select(_iso("window_start"), "value")


# --- ingest: typed bets table, quarantine, settlement ---------------------


_NESTED_BAD = "(event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0)"

# Typed bet rows as the oracle derives them from `events` (same mapping as
# sources.testdata.nested_value).
_BETS_SQL = f"""
  SELECT event_id, ts, {_uuid_sql('user_id')} AS bet_id, {_uuid_sql('user_id')} AS user_id,
    ['NO', 'PT', 'JP', 'BR', 'KE', 'IS', 'NZ'][user_id % 7 + 1] AS country,
    CAST(18 + user_id % 48 AS INTEGER) AS age,
    ['handset', 'laptop', 'kiosk'][user_id % 3 + 1] AS device,
    '10.20.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR)
      AS ip_address,
    event_type AS sport, event_type || ' league' AS league,
    'Side ' || CAST(event_id % 20 + 1 AS VARCHAR) || ' - Side ' || CAST(event_id % 20 + 21 AS VARCHAR)
      AS match,
    'Side ' || CAST(event_id % 40 + 1 AS VARCHAR) || ' first' AS selection,
    CAST((110 + event_id % 391) / 100.0 AS DECIMAL(6,2)) AS odds_dec,
    CAST(value AS DECIMAL(10,2)) AS amount_dec,
    ['NOK', 'JPY', 'BRL', 'KES'][event_id % 4 + 1] AS currency,
    ['win', 'lose', 'pending'][event_id % 3 + 1] AS status,
    ['shop', 'phone', 'partner'][event_id % 3 + 1] AS source,
    {_uuid_sql('user_id * 100 + dayofmonth(ts)')} AS session_id
  FROM events WHERE NOT (event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0)"""

_BETS_TYPED_SQL = f"""
  SELECT *, CAST(CASE WHEN status = 'win' THEN round(amount_dec * odds_dec, 2) ELSE 0 END
                 AS DECIMAL(10,2)) AS payout_dec
  FROM ({_BETS_SQL})"""


@query("flatten_bets", sql=f"""
SELECT bet_id, user_id, country, age, device, ip_address, sport, league, match, selection,
       CAST(odds_dec AS DOUBLE) AS odds, CAST(amount_dec AS DOUBLE) AS amount, currency, status,
       CAST(payout_dec AS DOUBLE) AS payout,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS bet_timestamp, source, session_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, false AS exported,
       event_id AS "offset"
FROM ({_BETS_TYPED_SQL})
""")
def q_flatten_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = fl.flatten_bets(bet_records(spark, sf_dir, "nested"))
    out = []
    for c in valid.columns:
        if c in ("odds", "amount", "payout"):
            out.append(F.col(c).cast("double").alias(c))
        elif c in ("bet_timestamp", "created_at"):
            out.append(F.date_format(F.col(c), ISO_MICROS).alias(c))
        elif c == "src_offset":
            out.append(F.col(c).alias("offset"))
        elif c in ("raw_event", "src_timestamp", "src_partition"):
            continue
        else:
            out.append(F.col(c))
    return valid.select(*out)


@query("rejected_by_reason", sql="""
SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT unnest(CASE
    WHEN event_id % 97 = 0 THEN ['malformed_json']
    WHEN event_id % 89 = 0 THEN ['missing:user', 'missing:event', 'missing:bet', 'missing:metadata',
                                 'missing:bet_id']
    WHEN event_id % 83 = 0 THEN ['bad_uuid:user.user_id'] END) AS reason
  FROM events)
GROUP BY 1
""")
def q_rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = fl.flatten_bets(bet_records(spark, sf_dir, "nested"))
    return fl.rejected_by_reason(bad)


@query("expected_payout", sql=f"""
SELECT status, CAST(count(*) AS BIGINT) AS bets,
       CAST(sum(CASE WHEN status = 'win' THEN round(amount_dec * odds_dec, 2) ELSE 0 END) AS DOUBLE)
         AS expected_total,
       CAST(sum(payout_dec) AS DOUBLE) AS payout_total,
       CAST(count(*) FILTER (WHERE payout_dec <> CASE WHEN status = 'win'
            THEN round(amount_dec * odds_dec, 2) ELSE 0 END) AS BIGINT) AS mismatches
FROM ({_BETS_TYPED_SQL}) GROUP BY 1
""")
def q_expected_payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = fl.flatten_bets(bet_records(spark, sf_dir, "nested"))
    chk = fl.expected_payout(valid)
    return chk.groupBy("status").agg(
        F.count(F.lit(1)).alias("bets"),
        F.sum("expected_payout").cast("double").alias("expected_total"),
        F.sum("payout").cast("double").alias("payout_total"),
        F.count(F.when(~F.col("payout_ok"), 1)).alias("mismatches"))


@query("top_games_by_sport", sql="""
SELECT CASE WHEN event_id % 89 = 0 THEN 'unknown' ELSE event_type END AS sport,
       CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN event_id % 89 = 0 THEN 0 ELSE CAST(value AS DECIMAL(10,2)) END)
            AS DOUBLE) AS total_amount
FROM events WHERE event_id % 97 <> 0 GROUP BY 1
""")
def q_top_games_by_sport(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = fl.flatten_top_games(bet_records(spark, sf_dir, "nested"))
    return rows.groupBy("sport").agg(F.count(F.lit(1)).alias("rows"),
                                     F.sum("total_amount").cast("double").alias("total_amount"))


# --- upsert and incremental export -----------------------------------------


# The first export run of the scenario happens at this (UTC) time; versions
# that arrived before it were exported then.
EXPORT_CUTOFF = _dt.datetime(2024, 1, 30, 18)
_CUTOFF_SQL = "TIMESTAMP '2024-01-30 18:00:00'"


def _bets_and_ledger(spark: SparkSession, sf_dir: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Versions of the bets (key, ``columns``, hash, arrival order), and the
    ledger of the first export run (at the cutoff), which exported the table
    as it was then.  Both read the versions: parsed and written once."""
    valid, _ = fl.flatten_bets(bet_records(spark, sf_dir, "nested"))
    versions = written(up.with_row_hash(valid).select(up.KEY, *columns, up.ROW_HASH, *VERSION_COLUMNS), "versions")
    first = versions.filter(F.col("src_timestamp") < F.lit(str(EXPORT_CUTOFF)).cast("timestamp"))
    ledger = up.latest_versions(first, columns=[up.ROW_HASH, *VERSION_COLUMNS])
    return versions, ledger


@query("latest_versions", sql=f"""
SELECT bet_id, arg_max(status, event_id) AS status,
       CAST(arg_max(amount_dec, event_id) AS DOUBLE) AS amount,
       arg_max(sport, event_id) AS sport, max(event_id) AS "offset"
FROM ({_BETS_TYPED_SQL}) GROUP BY bet_id
""")
def q_latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = fl.flatten_bets(bet_records(spark, sf_dir, "nested"))
    cur = up.latest_versions(valid, columns=["status", "amount", "sport", "src_offset"])
    return cur.select("bet_id", "status", F.col("amount").cast("double").alias("amount"),
                      "sport", F.col("src_offset").alias("offset"))


_EXPORT_STATE_SQL = f"""
  b AS ({_BETS_TYPED_SQL}),
  cur AS (SELECT bet_id, max(event_id) AS eid FROM b GROUP BY 1),
  old AS (SELECT bet_id, max(event_id) AS eid FROM b WHERE ts < {_CUTOFF_SQL} GROUP BY 1)"""


@query("export_pending", sql=f"""
WITH {_EXPORT_STATE_SQL}
SELECT b.bet_id, user_id, CAST(amount_dec AS DOUBLE) AS amount, currency, status,
       CAST(payout_dec AS DOUBLE) AS payout,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS bet_timestamp, country, age, device, ip_address,
       sport, league, match, selection, CAST(odds_dec AS DOUBLE) AS odds, source, session_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, false AS exported
FROM b JOIN cur ON b.bet_id = cur.bet_id AND b.event_id = cur.eid
LEFT JOIN old ON old.bet_id = b.bet_id
WHERE old.eid IS NULL OR old.eid <> cur.eid
""")
def q_export_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    carried = [c for c in ex.EXPORT_COLUMNS if c not in ("exported", up.KEY)]
    versions, ledger = _bets_and_ledger(spark, sf_dir, carried)
    wanted = [*carried, up.ROW_HASH, *VERSION_COLUMNS]
    rows = ex.export_projection(ex.pending_bets(up.latest_versions(versions, columns=wanted), ledger))
    return rows.select(*[F.date_format(c, ISO_MICROS).alias(c)
                         if c in ("bet_timestamp", "created_at") else F.col(c)
                         for c in rows.columns])


@query("export_counts", sql=f"""
WITH {_EXPORT_STATE_SQL}
SELECT coalesce(old.eid = cur.eid, false) AS exported, CAST(count(*) AS BIGINT) AS bets
FROM cur LEFT JOIN old ON old.bet_id = cur.bet_id GROUP BY 1
""")
def q_export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, ledger = _bets_and_ledger(spark, sf_dir, [])
    current = up.latest_versions(versions, columns=[up.ROW_HASH])
    return ex.export_counts(ex.with_exported(current, ledger))


@query("legacy_export", sql=f"""
SELECT {_uuid_sql('event_id')} AS bet_id, {_uuid_sql('user_id')} AS user_id,
       event_type AS game, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS amount,
       event_type AS status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
       false AS exported
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
""")
def q_legacy_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = fl.flatten_legacy_bets(bet_records(spark, sf_dir, "flat"))
    rows = ex.legacy_export_projection(up.latest_versions(valid, columns=ex.LEGACY_EXPORT_COLUMNS))
    return rows.withColumn("timestamp", F.date_format("timestamp", ISO_MICROS))


# --- metric time series and alerts -----------------------------------------


_SAMPLES_SQL = """
  SELECT event_type AS game, CAST(user_id % 2 AS VARCHAR) AS shard, ts,
         CAST(round(CAST(value AS DECIMAL(20,6)) * 100, 0) AS DOUBLE) AS cnt,
         CAST(round(CAST(value AS DECIMAL(20,6)) * 100, 0) AS DOUBLE) * 3 + user_id % 7 AS sm,
         value AS stake
  FROM events"""

# Reset-aware deltas of both counters per series (lag over the whole series).
_DELTAS_SQL = f"""
  s AS ({_SAMPLES_SQL}),
  l AS (SELECT *, lag(cnt) OVER w AS pc, lag(sm) OVER w AS ps FROM s
        WINDOW w AS (PARTITION BY game, shard ORDER BY ts)),
  d AS (SELECT game, shard, ts, stake,
               CASE WHEN pc IS NULL THEN 0 WHEN cnt < pc THEN cnt ELSE cnt - pc END AS dc,
               CASE WHEN ps IS NULL THEN 0 WHEN sm < ps THEN sm ELSE sm - ps END AS ds
        FROM l)"""

_HOUR_WINDOW_SQL = _iso_window_sql("1 hour")


def _labelled(df: DataFrame, *names: str) -> DataFrame:
    """Flatten label values to columns and format the window bounds."""
    cols = [M.label(n).alias(n) for n in names]
    return df.select(*cols, _iso("window_start"), _iso("window_end"), "value")


def _series(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    return M.select_series(metric_samples(spark, sf_dir, [metric]), metric)


def _counter(spark: SparkSession, sf_dir: str, metric: str = BETS_COUNTER) -> DataFrame:
    return _series(spark, sf_dir, metric)


@query("metric_increase", sql=f"""
WITH {_DELTAS_SQL}
SELECT game, shard, {_HOUR_WINDOW_SQL}, sum(dc) AS value FROM d GROUP BY ALL
""")
def q_metric_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(M.increase(_counter(spark, sf_dir), "1 hour"), "game", "shard")


@query("metric_rate", sql=f"""
WITH {_DELTAS_SQL}
SELECT game, shard, {_HOUR_WINDOW_SQL}, sum(dc) / 3600.0 AS value FROM d GROUP BY ALL
""")
def q_metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(M.rate(_counter(spark, sf_dir), "1 hour"), "game", "shard")


@query("metric_rate_sliding", sql=f"""
WITH {_DELTAS_SQL},
b AS (SELECT game, shard, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS bend,
             sum(dc) AS v FROM d GROUP BY ALL),
x AS (SELECT game, shard, bend + k * INTERVAL '15 minutes' AS wend, v
      FROM b CROSS JOIN range(0, 4) AS t(k))
SELECT game, shard, strftime(wend - INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(wend, '%Y-%m-%dT%H:%M:%S') AS window_end, sum(v) / 3600.0 AS value
FROM x GROUP BY ALL
""")
def q_metric_rate_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.rate(_counter(spark, sf_dir), "1 hour", step="15 minutes")
    return _labelled(r, "game", "shard")


@query("metric_avg_over_time", sql=f"""
WITH s AS ({_SAMPLES_SQL})
SELECT game, shard, {_HOUR_WINDOW_SQL},
       CAST(sum({_exact_sql('stake')}) AS DOUBLE) / count(*) AS value
FROM s GROUP BY ALL
""")
def q_metric_avg_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _series(spark, sf_dir, STAKE_GAUGE)
    return _labelled(M.avg_over_time(g, "1 hour"), "game", "shard")


_LAST_SQL = f"""
  s AS ({_SAMPLES_SQL}),
  v AS (SELECT game, shard, time_bucket(INTERVAL '1 hour', ts) AS w, arg_max(stake, ts) AS v
        FROM s GROUP BY ALL)"""


@query("metric_instant_sum", sql=f"""
WITH {_LAST_SQL}
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CAST(sum({_exact_sql('v')}) AS DOUBLE) AS value
FROM v GROUP BY ALL
""")
def q_metric_instant_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = M.instant_vector(_series(spark, sf_dir, STAKE_GAUGE), "1 hour", lookback="1 hour")
    return _labelled(M.aggregate(vec, "sum"))


@query("metric_instant_avg", sql=f"""
WITH {_LAST_SQL}
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CAST(sum({_exact_sql('v')}) AS DOUBLE) / count(*) AS value
FROM v GROUP BY ALL
""")
def q_metric_instant_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = M.instant_vector(_series(spark, sf_dir, STAKE_GAUGE), "1 hour", lookback="1 hour")
    return _labelled(M.aggregate(vec, "avg"))


@query("metric_sum_by", sql=f"""
WITH {_DELTAS_SQL}
SELECT game, {_HOUR_WINDOW_SQL}, sum(dc) / 3600.0 AS value FROM d GROUP BY ALL
""")
def q_metric_sum_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum(rate(c[1h])) by (game): rate is linear, so the sum of increases is
    # divided once (exact for integer counters, fewer float operations).
    inc = M.aggregate(M.increase(_counter(spark, sf_dir), "1 hour"), "sum", by=["game"])
    return _labelled(inc.withColumn("value", F.col("value") / 3600.0), "game")


_SHARE_SQL = f"""
  {_DELTAS_SQL},
  inc AS (SELECT game, time_bucket(INTERVAL '1 hour', ts) AS w, sum(dc) AS v FROM d GROUP BY ALL),
  a AS (SELECT w, sum(v) AS a FROM inc WHERE game = 'error' GROUP BY w),
  b AS (SELECT w, sum(v) AS b FROM inc GROUP BY w),
  r AS (SELECT w, CASE WHEN b <> 0 THEN a / b WHEN a = 0 THEN 'NaN'::DOUBLE
                       ELSE sign(a) * 'Infinity'::DOUBLE END AS ratio
        FROM a JOIN b USING (w))"""


def _error_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum(rate(c{game="error"})) / sum(rate(c)): the range cancels, and both
    # sums come from the same increases in one aggregate.
    inc = M.increase(_counter(spark, sf_dir), "1 hour")
    return M.fraction(inc, {"game": "error"})


@query("metric_ratio", sql=f"""
WITH {_SHARE_SQL}
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end, ratio AS value FROM r
""")
def q_metric_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(_error_share(spark, sf_dir))


@query("metric_complement", sql=f"""
WITH {_SHARE_SQL}
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end, 1.0 - ratio AS value
FROM r
""")
def q_metric_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(M.scalar_op(_error_share(spark, sf_dir), "-", 1.0))


@query("metric_histogram_mean", sql=f"""
WITH {_DELTAS_SQL},
h AS (SELECT game, shard, time_bucket(INTERVAL '1 hour', ts) AS w, sum(ds) AS a, sum(dc) AS b
      FROM d GROUP BY ALL)
SELECT game, shard, strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CASE WHEN b <> 0 THEN a / b WHEN a = 0 THEN 'NaN'::DOUBLE
            ELSE sign(a) * 'Infinity'::DOUBLE END AS value
FROM h
""")
def q_metric_histogram_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    hm = M.histogram_mean(metric_samples(spark, sf_dir, [STAKE_SUM_COUNTER, BETS_COUNTER]),
                          "wager_stake", "1 hour")
    return _labelled(hm, "game", "shard")


# Alert rule on the derived stake gauge (same shape as the reference rules).
STAKE_RULE = al.AlertRule("HighStake", ">", 30.0, "1 hour", "warning",
                          "Stake on {{ $labels.game }} shard {{ $labels.shard }} is high")


@query("sustained_alerts", sql=f"""
WITH s AS ({_SAMPLES_SQL}),
g AS (SELECT *, stake > 30 AS hit,
             max(CASE WHEN NOT stake > 30 THEN ts END)
               OVER (PARTITION BY game, shard ORDER BY ts ROWS UNBOUNDED PRECEDING) AS lf
      FROM s),
i AS (SELECT game, shard, lf, min(ts) AS active_since, max(ts) AS last_true,
             count(*) AS samples FROM g WHERE hit GROUP BY ALL),
f AS (SELECT g.game, g.shard, g.lf, min(g.ts) AS firing_since, arg_min(g.stake, g.ts) AS value
      FROM g JOIN i ON g.game = i.game AND g.shard = i.shard
                   AND g.lf IS NOT DISTINCT FROM i.lf
      WHERE g.hit AND g.ts >= i.active_since + INTERVAL '1 hour' GROUP BY ALL)
SELECT 'HighStake' AS alert, 'warning' AS severity, i.game, i.shard,
       strftime(active_since, '%Y-%m-%dT%H:%M:%S.%f') AS active_since,
       strftime(firing_since, '%Y-%m-%dT%H:%M:%S.%f') AS firing_since,
       strftime(last_true, '%Y-%m-%dT%H:%M:%S.%f') AS last_true,
       CAST(samples AS BIGINT) AS samples, value,
       'Stake on ' || i.game || ' shard ' || i.shard || ' is high' AS summary
FROM i JOIN f ON i.game = f.game AND i.shard = f.shard AND i.lf IS NOT DISTINCT FROM f.lf
""")
def q_sustained_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(al.sustained_alerts(_series(spark, sf_dir, STAKE_GAUGE), STAKE_RULE,
                                           max_gap="365 days"))


def _alert_rows(a: DataFrame) -> DataFrame:
    return a.select("alert", "severity", M.label("game").alias("game"),
                    M.label("shard").alias("shard"),
                    *[F.date_format(c, ISO_MICROS).alias(c)
                      for c in ("active_since", "firing_since", "last_true")],
                    "samples", "value", "summary")


@query("consumer_lag", sql="""
WITH r AS (SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id AS o, ts FROM events),
c AS (SELECT p, max(o) AS co FROM r WHERE ts < TIMESTAMP '2024-01-30 18:00:00' GROUP BY p)
SELECT r.p AS "partition", CAST(count(*) FILTER (WHERE c.co IS NULL OR r.o > c.co) AS BIGINT) AS lag,
       max(r.o) AS end_offset
FROM r LEFT JOIN c ON r.p = c.p GROUP BY 1
""")
def q_consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = bet_records(spark, sf_dir, "flat")
    committed = (recs.filter(F.col("timestamp") < F.lit("2024-01-30 18:00:00").cast("timestamp"))
                     .groupBy("partition").agg(F.max("offset").alias("committed_offset")))
    return M.consumer_lag(recs.select("partition", "offset"), committed)


# --- nested (producer-shape) variants of the stream aggregates --------------

_NESTED_KEY_SQL = f"""
  SELECT event_id, ts, value,
         (event_id % 97 = 0 OR event_id % 89 = 0) AS bad,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'invalid' ELSE event_type END AS sport,
         CASE WHEN event_id % 83 = 0 THEN 'abc'
              ELSE {_uuid_sql('user_id')} END AS uid,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 0 ELSE 1 END AS n
  FROM events"""


@query("game_window_counts_nested", sql=f"""
WITH r AS ({_NESTED_KEY_SQL})
SELECT {_iso_window_sql('10 seconds')}, sport AS game, CAST(sum(n) AS BIGINT) AS count
FROM r GROUP BY 1, 2, 3
""")
def q_game_window_counts_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agg.game_window_counts(bet_records(spark, sf_dir, "nested"), shape="nested")
    return counts.select(_iso("window_start"), _iso("window_end"), "game", "count")


@query("average_bet_nested", sql=f"""
WITH r AS ({_NESTED_KEY_SQL})
SELECT 'avg_bet' AS metric,
       CASE WHEN sum(n) > 0 THEN
         CAST(sum(CASE WHEN NOT bad THEN {_exact_sql('value')} END) AS DOUBLE) / sum(n)
       ELSE 0.0 END AS value,
       CAST(sum(n) AS BIGINT) AS n
FROM r
""")
def q_average_bet_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.average_bet(bet_records(spark, sf_dir, "nested"), shape="nested")


@query("active_users_nested", sql=f"""
WITH r AS ({_NESTED_KEY_SQL})
SELECT {_iso_window_sql('2 minutes')}, CAST(count(DISTINCT uid) AS BIGINT) AS active_users
FROM r WHERE NOT bad GROUP BY 1, 2
""")
def q_active_users_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    au = agg.active_users(bet_records(spark, sf_dir, "nested"), shape="nested")
    return au.select(_iso("window_start"), _iso("window_end"), "active_users")


@query("metric_binary_op", sql=f"""
WITH {_DELTAS_SQL},
a AS (SELECT game, time_bucket(INTERVAL '1 hour', ts) AS w, sum(ds) AS a FROM d GROUP BY ALL),
b AS (SELECT game, time_bucket(INTERVAL '1 hour', ts) AS w, sum(dc) AS b FROM d GROUP BY ALL)
SELECT game, strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CASE WHEN b <> 0 THEN a / b WHEN a = 0 THEN 'NaN'::DOUBLE
            ELSE sign(a) * 'Infinity'::DOUBLE END AS value
FROM a JOIN b USING (game, w)
""")
def q_metric_binary_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum by (game) (increase(stake_sum[1h])) / on(game) sum by (game) (increase(stake_count[1h]))
    samples = metric_samples(spark, sf_dir, [STAKE_SUM_COUNTER, BETS_COUNTER])
    return _labelled(M.ratio_of_increases(samples, STAKE_SUM_COUNTER, BETS_COUNTER, "1 hour", by=["game"]), "game")


@query("status_changelog_nested", sql="""
WITH r AS (
  SELECT event_id,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'invalid'
              ELSE ['win', 'lose', 'pending'][event_id % 3 + 1] END AS status,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 0 ELSE 1 END AS n
  FROM events)
SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset", status,
       CAST(sum(n) OVER (PARTITION BY status ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS count
FROM r
""")
def q_status_changelog_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.status_changelog(bet_records(spark, sf_dir, "nested"), shape="nested")


# --- selectors, vector arithmetic, lookback ---------------------------------


@query("metric_selector", sql=f"""
WITH s AS ({_SAMPLES_SQL})
SELECT game, shard, {_HOUR_WINDOW_SQL}, CAST(sum({_exact_sql('stake')}) AS DOUBLE) / count(*) AS value
FROM s WHERE shard = '1' AND game <> 'error' GROUP BY ALL
""")
def q_metric_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    # avg_over_time(stake{shard="1", game!="error", host=""}[1h]): no sample has a host
    g = M.select_series(metric_samples(spark, sf_dir, [STAKE_GAUGE]), STAKE_GAUGE,
                        equal={"shard": "1", "host": ""}, not_equal={"game": "error"})
    return _labelled(M.avg_over_time(g, "1 hour"), "game", "shard")


@query("metric_vector_sum", sql=f"""
WITH s AS ({_SAMPLES_SQL}),
v AS (SELECT game, shard, time_bucket(INTERVAL '1 hour', ts) AS w,
             arg_max(stake, ts) + arg_max(cnt, ts) AS v FROM s GROUP BY ALL)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CAST(sum({_exact_sql('v')}) AS DOUBLE) AS value
FROM v GROUP BY w
""")
def q_metric_vector_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum(stake + stake_count): matched series by series, then added up
    a, b = (M.instant_vector(_series(spark, sf_dir, m), "1 hour", lookback="1 hour").drop("metric")
            for m in (STAKE_GAUGE, BETS_COUNTER))
    return _labelled(M.aggregate(M.binary_op(a, b, "+"), "sum"))


@query("metric_hit_ratio", sql=f"""
WITH {_DELTAS_SQL},
i AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, sum(ds) AS hit, sum(dc) AS miss FROM d GROUP BY ALL)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       CASE WHEN hit + miss <> 0 THEN hit / (hit + miss) ELSE 'NaN'::DOUBLE END AS value
FROM i
""")
def q_metric_hit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum(rate(hit)) / (sum(rate(hit)) + sum(rate(miss))) with two metric names
    samples = metric_samples(spark, sf_dir, [STAKE_SUM_COUNTER, BETS_COUNTER])
    return _labelled(M.ratio_of_increases(samples, STAKE_SUM_COUNTER, BETS_COUNTER, "1 hour", with_numerator=True))


@query("metric_one_minus_avg_rate", sql=f"""
WITH {_DELTAS_SQL},
i AS (SELECT shard, game, time_bucket(INTERVAL '1 hour', ts) AS w, sum(dc) / 3600.0 AS r FROM d
      WHERE game = 'error' GROUP BY ALL)
SELECT strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end,
       round(1.0 - avg(r), 9) AS value
FROM i GROUP BY w
""")
def q_metric_one_minus_avg_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 1 - avg(rate(count{game="error"}[1h]))
    c = M.select_series(metric_samples(spark, sf_dir, [BETS_COUNTER]), BETS_COUNTER, equal={"game": "error"})
    out = M.scalar_op(M.aggregate(M.rate(c, "1 hour"), "avg"), "-", 1.0)
    return _labelled(out.withColumn("value", F.round("value", 9)))


@query("metric_instant_lookback", sql=f"""
WITH s AS ({_SAMPLES_SQL}),
g AS (SELECT DISTINCT time_bucket(INTERVAL '15 minutes', ts) + (k + 1) * INTERVAL '15 minutes' AS t
      FROM s, range(0, 5) AS r(k)),
v AS (SELECT g.t, s.game, s.shard, arg_max(s.stake, s.ts) AS v
      FROM g JOIN s ON s.ts < g.t AND s.ts >= g.t - INTERVAL '1 hour' GROUP BY ALL)
SELECT strftime(t, '%Y-%m-%dT%H:%M:%S') AS window_end, CAST(count(*) AS BIGINT) AS series,
       CAST(sum({_exact_sql('v')}) AS DOUBLE) AS value
FROM v GROUP BY t
""")
def q_metric_instant_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sum(stake) every 15 minutes; a series counts for an hour after its last sample
    vec = M.instant_vector(_series(spark, sf_dir, STAKE_GAUGE), "15 minutes", lookback="1 hour")
    both = M.aggregate(vec, "sum").select("window_end", "value").join(
        M.aggregate(vec, "count").select("window_end", F.col("value").cast("long").alias("series")), "window_end")
    return both.select(_iso("window_end"), "series", "value")


@query("metric_store_selector", sql=f"""
WITH s AS ({_SAMPLES_SQL})
SELECT game, shard, {_HOUR_WINDOW_SQL}, CAST(sum({_exact_sql('stake')}) AS DOUBLE) / count(*) AS value
FROM s WHERE game <> 'error' AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00' GROUP BY ALL
""")
def q_metric_store_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    # avg_over_time(stake{game!="error"}[1h]) of some days, from a store that holds all metrics and days
    store = SampleStore(spark, f"{scratch_root(spark)}/samples-{uuid.uuid4().hex[:12]}")
    store.append(metric_samples(spark, sf_dir), "events")
    g = store.select_series(STAKE_GAUGE, not_equal={"game": "error"},
                            start=_dt.datetime(2024, 1, 10), stop=_dt.datetime(2024, 1, 12, 6))
    return _labelled(M.avg_over_time(g, "1 hour"), "game", "shard")


@query("metric_vector_difference", sql=f"""
WITH s AS ({_SAMPLES_SQL}),
v AS (SELECT game, shard, time_bucket(INTERVAL '1 hour', ts) AS w, arg_max(sm, ts) - arg_max(cnt, ts) AS d,
             arg_max(sm, ts) * arg_max(cnt, ts) AS p FROM s GROUP BY ALL)
SELECT game, shard, strftime(w, '%Y-%m-%dT%H:%M:%S') AS window_start,
       strftime(w + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S') AS window_end, d AS value, p AS product
FROM v
""")
def q_metric_vector_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    # stake_sum - stake_count and stake_sum * stake_count, matched series by series
    a, b = (M.instant_vector(_series(spark, sf_dir, m), "1 hour", lookback="1 hour").drop("metric")
            for m in (STAKE_SUM_COUNTER, BETS_COUNTER))
    keys = ["window_start", "window_end", M.SERIES]
    product = M.binary_op(a, b, "*").select(*keys, F.col("value").alias("product"))
    both = M.binary_op(a, b, "-").join(product, keys)
    return both.select(M.label("game").alias("game"), M.label("shard").alias("shard"), _iso("window_start"), _iso("window_end"),
                       "value", "product")


# --- alerts -------------------------------------------------------------------


def _islands_sql(points: str, gap: str, hold: str, condition: str) -> str:
    """Firing islands of ``points`` (series, t, v), from the rule's words: the
    condition holds at every point without a gap for at least ``hold``."""
    return f"""
  p AS ({points}),
  o AS (SELECT *, coalesce({condition}, false) AS hit, lag(t) OVER w AS pt, lag(coalesce({condition}, false)) OVER w AS ph
        FROM p WINDOW w AS (PARTITION BY series ORDER BY t)),
  b AS (SELECT *, sum(CASE WHEN pt IS NULL OR NOT ph OR NOT hit OR t - pt > INTERVAL '{gap}' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY series ORDER BY t) AS island FROM o),
  f AS (SELECT series, island, min(t) AS active_since, max(t) AS last_true, count(*) AS samples
        FROM b WHERE hit GROUP BY ALL HAVING max(t) - min(t) >= INTERVAL '{hold}')
  SELECT f.series, f.active_since, min(b.t) AS firing_since, f.last_true, f.samples, arg_min(b.v, b.t) AS value
  FROM f JOIN b USING (series, island) WHERE b.t >= f.active_since + INTERVAL '{hold}'
  GROUP BY ALL"""


@query("alert_gap_reset", sql=f"""
WITH r AS (WITH s AS ({_SAMPLES_SQL}),
{_islands_sql("SELECT game || '/' || shard AS series, ts AS t, stake AS v FROM s", "90 minutes", "2 hours", "v > 10")})
SELECT split_part(series, '/', 1) AS game, split_part(series, '/', 2) AS shard,
       strftime(active_since, '%Y-%m-%dT%H:%M:%S.%f') AS active_since,
       strftime(firing_since, '%Y-%m-%dT%H:%M:%S.%f') AS firing_since,
       strftime(last_true, '%Y-%m-%dT%H:%M:%S.%f') AS last_true, CAST(samples AS BIGINT) AS samples, value
FROM r
""")
def q_alert_gap_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = al.AlertRule("Stake", ">", 10.0, "2 hours", "warning", "high")
    a = al.sustained_alerts(_series(spark, sf_dir, STAKE_GAUGE), rule, max_gap="90 minutes")
    return _alert_rows(a).drop("alert", "severity", "summary")


# The six rules' metrics from events: gauge readings and counters of `value`.
_RULE_METRICS = {
    "kafka_consumergroup_lag_sum": ("consumergroup", 1000), "pg_stat_database_numbackends": ("instance", 1),
    "pg_settings_max_connections": ("instance", 0), "flink_jobmanager_job_status": ("job_name", 0),
    "airflow_dagrun_failed": ("dag_id", 1), "container_cpu_usage_seconds_total": ("name", 10),
    "container_memory_usage_bytes": ("name", 1), "container_spec_memory_limit_bytes": ("name", 0),
}
_RULE_CONSTANT = {"pg_settings_max_connections": 25.0, "flink_jobmanager_job_status": 1.0,
                  "container_spec_memory_limit_bytes": 25.0}


def _rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the rules' metrics, two series each (by user)."""
    base = metric_samples(spark, sf_dir, [STAKE_GAUGE])
    who = F.col("labels").getItem("shard")
    samples = [F.struct(
        F.lit(m).alias("metric"),
        F.create_map(F.lit(label), who, *([F.lit("status"), F.lit("FAILED")] if "status" in m else [])).alias("labels"),
        (F.lit(_RULE_CONSTANT[m]) if m in _RULE_CONSTANT else F.floor("value") * k).cast("double").alias("value"))
        for m, (label, k) in _RULE_METRICS.items()]
    return base.select("ts", F.explode(F.array(*samples)).alias("s")).select("ts", "s.*")


def _rules_sql() -> str:
    instant = lambda v: f"""SELECT g.series, g.t, arg_max({v}, e.ts) AS v FROM g JOIN e ON e.series = g.series
      AND e.ts < g.t AND e.ts >= g.t - INTERVAL '5 minutes' GROUP BY ALL"""  # noqa: E731
    counter = lambda k, per: f"""SELECT g.series, g.t, sum(d.d) * {k} / {per} AS v FROM g JOIN d ON d.series = g.series
      AND d.ts < g.t AND d.ts >= g.t - INTERVAL '5 minutes' GROUP BY ALL"""  # noqa: E731
    rules = [("KafkaHighLag", instant("e.v * 1000"), "5 minutes", "v > 10000"),
             ("PostgreSQLHighConnections", instant("e.v / 25.0"), "5 minutes", "v > 0.8"),
             ("FlinkJobFailed", instant("1.0"), "1 minute", "v = 1"),
             ("AirflowDAGFailed", counter(1, 1), "5 minutes", "v > 0"),
             ("HighCPUUsage", counter(10, 300.0), "5 minutes", "v > 0.8"),
             ("HighMemoryUsage", instant("e.v / 25.0"), "5 minutes", "v > 0.9")]
    parts = [f"""SELECT '{name}' AS alert, series, strftime(active_since, '%Y-%m-%dT%H:%M:%S') AS active_since,
       strftime(firing_since, '%Y-%m-%dT%H:%M:%S') AS firing_since, strftime(last_true, '%Y-%m-%dT%H:%M:%S') AS last_true,
       CAST(samples AS BIGINT) AS samples, round(CAST(value AS DOUBLE), 9) AS value
FROM (WITH {_islands_sql(points, '30 seconds', hold, cond)})""" for name, points, hold, cond in rules]
    return f"""
WITH e AS (SELECT CAST(user_id % 2 AS VARCHAR) AS series, ts, floor(value) AS v FROM events),
l AS (SELECT *, lag(v) OVER (PARTITION BY series ORDER BY ts) AS p FROM e),
d AS (SELECT series, ts, CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END AS d FROM l),
g AS (SELECT DISTINCT series, time_bucket(INTERVAL '30 seconds', ts) + (k + 1) * INTERVAL '30 seconds' AS t
      FROM e, range(0, 11) AS r(k))
""" + "\nUNION ALL\n".join(parts)


@query("alert_rules", sql=_rules_sql())
def q_alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = SampleStore(spark, f"{scratch_root(spark)}/samples-{uuid.uuid4().hex[:12]}")
    store.append(_rule_samples(spark, sf_dir), "events")
    a = al.evaluate_rules(store)
    who = F.coalesce(*[M.label_or_null(k) for k in ("consumergroup", "instance", "job_name", "dag_id", "name")])
    return a.select("alert", who.alias("series"), *[_iso(c) for c in ("active_since", "firing_since", "last_true")],
                    "samples", F.round("value", 9).alias("value"))


# --- ingest metrics and result tables -------------------------------------------


@query("delay_histogram", sql=f"""
SELECT {_iso_window_sql('1 hour')},
       CAST(count(*) FILTER (WHERE value <= 1) AS BIGINT) AS le_1, CAST(count(*) FILTER (WHERE value <= 5) AS BIGINT) AS le_5,
       CAST(count(*) FILTER (WHERE value <= 30) AS BIGINT) AS le_30, CAST(count(value) AS BIGINT) AS count,
       CAST(sum({_exact_sql('value')}) AS DOUBLE) AS sum
FROM events GROUP BY 1, 2
""")
def q_delay_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stake stands for the seconds between a bet and its ingestion
    g = metric_samples(spark, sf_dir, [STAKE_GAUGE])
    h = M.delay_histogram(g, F.col("value"), [1, 5, 30], "1 hour", time_col="ts")
    return h.select(_iso("window_start"), _iso("window_end"), "le_1", "le_5", "le_30", "count", "sum")


@query("game_history", sql=f"""
WITH r AS ({_FLAT_SQL})
SELECT key AS game, CAST(sum(n) AS BIGINT) AS count,
       strftime(time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds', '%Y-%m-%dT%H:%M:%S') AS event_time
FROM r GROUP BY 1, 3
""")
def q_game_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = agg.game_history(agg.game_window_counts(bet_records(spark, sf_dir, "flat")))
    return hist.select("game", "count", _iso("event_time"))


@query("top_games_rows", sql="""
SELECT CASE WHEN event_id % 89 = 0 THEN 'unknown' ELSE event_type END AS sport,
       CASE WHEN event_id % 89 <> 0 THEN event_type || ' league' END AS league,
       CASE WHEN event_id % 89 = 0 THEN 0.0 ELSE CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) END AS total_amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM events WHERE event_id % 97 <> 0
""")
def q_top_games_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = fl.flatten_top_games(bet_records(spark, sf_dir, "nested"))
    return rows.select("sport", "league", F.col("total_amount").cast("double").alias("total_amount"),
                       F.date_format("timestamp", ISO_MICROS).alias("timestamp"))
