"""Table scans and target bootstrap (the bets table and result tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, location: str, *, fmt: str = "parquet",
               options: dict[str, str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Scan a table.  ``fmt="jdbc"`` reads a database table (``location`` is
    the table name; url/user/password in ``options``; the JDBC driver jar
    must be on the classpath).  Filters and projections applied afterwards
    are pushed into the scan by Catalyst."""
    r = spark.read.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "jdbc":
        return r.option("dbtable", location).load()
    return r.load(location)


def not_exported(bets: DataFrame) -> DataFrame:
    """``WHERE exported = false``."""
    return bets.filter(~F.col("exported"))


def peek(df: DataFrame, n: int = 10) -> DataFrame:
    """Ad-hoc look at a few rows (``SELECT ... LIMIT n``)."""
    return df.limit(n)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet") -> None:
    """Create an empty table with ``schema`` if nothing exists at ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        spark.createDataFrame([], schema).write.format(fmt).save(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(os.fspath(path))
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def register_views(spark: SparkSession, bets_root: str, export_root: str | None = None) -> None:
    """Temp views for ad-hoc SQL: ``bets`` (current version per bet, with
    ``exported`` derived from the export ledger) and ``bets_quarantine``.

    ``SELECT * FROM bets LIMIT 10`` and ``SELECT COUNT(*) FROM bets WHERE
    exported = false`` then run as they would against the database table.
    """
    from wagerflow.operators.export import read_ledger, with_exported
    from wagerflow.operators.upsert import ROW_HASH, current_bets
    from wagerflow.schemas import BET_COLUMNS
    ledger = read_ledger(spark, os.path.join(export_root, "_ledger")) if export_root else None
    bets = with_exported(current_bets(spark, bets_root), ledger)
    bets.select(*BET_COLUMNS, ROW_HASH).createOrReplaceTempView("bets")
    q = os.path.join(bets_root, "quarantine")
    if table_exists(spark, q):
        # a run with a new checkpoint may have read the same records again
        spark.read.parquet(q).dropDuplicates(["timestamp", "partition", "offset"]) \
            .createOrReplaceTempView("bets_quarantine")
