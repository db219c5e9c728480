"""Schemas of the data model (events, bets table, results, metric samples)."""

from pyspark.sql import types as T

# Kafka-like record: every source yields these four columns.
RECORD = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Bets table column types and varchar limits.
ODDS_TYPE = T.DecimalType(6, 2)
MONEY_TYPE = T.DecimalType(10, 2)
VARCHAR_LIMITS = {
    "country": 5, "device": 50, "ip_address": 50, "sport": 50, "league": 100,
    "match": 150, "selection": 150, "currency": 10, "status": 20, "source": 50,
}

BETS = T.StructType([
    T.StructField("bet_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("country", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("device", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("sport", T.StringType()),
    T.StructField("league", T.StringType()),
    T.StructField("match", T.StringType()),
    T.StructField("selection", T.StringType()),
    T.StructField("odds", ODDS_TYPE),
    T.StructField("amount", MONEY_TYPE),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("payout", MONEY_TYPE),
    T.StructField("bet_timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("exported", T.BooleanType(), False),
    T.StructField("raw_event", T.StringType()),
])

BET_COLUMNS = [f.name for f in BETS.fields]

# Version coordinates kept next to every stored bet row (arrival order).
VERSION_COLUMNS = ["src_timestamp", "src_partition", "src_offset"]

QUARANTINE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

TOP_GAMES = T.StructType([
    T.StructField("sport", T.StringType(), False),
    T.StructField("league", T.StringType()),
    T.StructField("total_amount", MONEY_TYPE),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("raw_event", T.StringType()),
])

LEGACY_BETS = T.StructType([
    T.StructField("bet_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("game", T.StringType(), False),
    T.StructField("amount", MONEY_TYPE, False),
    T.StructField("status", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType()),
])

METRIC_SAMPLE = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])
