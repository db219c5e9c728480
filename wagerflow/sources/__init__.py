"""Sources: every reader yields Kafka-like records (value, timestamp, partition, offset)."""

from wagerflow.sources.records import read_records, records_from_lines  # noqa: F401
from wagerflow.sources.testdata import (  # noqa: F401
    bet_records, load_table, metric_samples,
)
