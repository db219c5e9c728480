import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wagerflow.session import checkpoint_root, get_session
    s = get_session("local[4]", conf={"spark.sql.shuffle.partitions": "4"})
    # Tests own their checkpoint folder; a cluster names a shared one instead.
    checkpoint_root(s, fallback=tempfile.mkdtemp(prefix="wf-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="wf-test-", dir="/tmp")


def records(spark, values, start="2024-01-01 00:00:00", step_s=1, partition=0):
    """Kafka-like records from literal JSON lines (arrival order = list order)."""
    import datetime as dt
    t0 = dt.datetime.fromisoformat(start)
    rows = [(v, t0 + dt.timedelta(seconds=i * step_s), partition, i)
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "value string, ts_ntz timestamp_ntz, partition int, offset long")
    from pyspark.sql import functions as F
    return df.select("value", F.col("ts_ntz").cast("timestamp").alias("timestamp"),
                     "partition", "offset")
