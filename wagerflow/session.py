"""Session helpers: sane defaults, UTC time semantics, shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every wagerflow job relies on.  Event times are UTC instants; the
# session zone decides how zone-less ISO strings are read, so it is pinned.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",   # the last value of a repeated key counts
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "wagerflow",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or return) a session with wagerflow's defaults.

    ``master`` is left to spark-submit on a cluster; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


PARSE_CONF = ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys")


def ensure_parse_conf(spark: SparkSession) -> None:
    """Set what record parsing relies on, in sessions that others built."""
    for key in PARSE_CONF:
        if spark.conf.get(key, None) != DEFAULT_CONF[key]:
            spark.conf.set(key, DEFAULT_CONF[key])


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; under the warehouse where none is named."""
    return checkpoint_root(spark, fallback=spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared checkpoint folder and read back: for
    inputs that a plan reads several times and that are dear to compute.  The
    folder is the one the session names; set under the warehouse if unset."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Only when it is unset -- as in tests -- is ``fallback``
    installed.  A machine-local temp folder is never chosen silently.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not root:
        if fallback is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; pass a shared folder as fallback")
        root = fallback
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def checkpoint_path(spark: SparkSession, *parts: str, fallback: str | None = None) -> str:
    return os.path.join(checkpoint_root(spark, fallback), *parts)


def default_parallelism(spark: SparkSession) -> int:
    """Bucket count for order-dependent operators: the shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
