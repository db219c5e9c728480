"""Shared helpers of the corpus operators: reading tables, Arrow text batches, vectorised word fingerprints.

Word fingerprints are computed for a whole Arrow batch at once: a polynomial over the bytes of each word (prefix sums
modulo 2^64), then a non-linear mix.  Nothing loops over words in Python.  Two fingerprints that must not collide at
corpus scale (50-word windows, shingle sets) are built from two independent 64-bit values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

U = np.uint64
SLICE_BYTES = 1 << 20   # bytes of text that one vectorised step takes (a longer text is one step of its own)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GOLD = U(0xBF58476D1CE4E5B9)
_SILVER = U(0x94D049BB133111EB)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
NOT_ALNUM = np.zeros(256, bool)   # bytes outside [0-9A-Za-z] and non-ASCII
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


# --- tables -------------------------------------------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; set (to a folder under the warehouse) only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


# --- Arrow batches ------------------------------------------------------------------------------------------------

def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive row ranges of about slice_bytes; a null counts as empty."""
    col = pc.fill_null(column, "") if column.null_count else column
    col = col.cast(pa.large_binary())
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + slice_bytes, "right")) - 1)
        j = min(j, n)
        yield i, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _GOLD
    x = (x ^ (x >> U(27))) * _SILVER
    return x ^ (x >> U(31))


class _Powers:
    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            out = np.full(max(n, 1 << 16), self.base, np.uint64)
            out[0] = 1
            self.values = np.multiply.accumulate(out)
        return self.values[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


class Words:
    """The words of some rows: ``hash`` (64-bit), ``start`` / ``end`` (bytes in the slice), ``first[r]`` .. ``first[r+1]``
    the words of row r."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray, fold: np.ndarray | None = None):
        text = raw if fold is None else fold[raw]
        inside = ~gaps[text]
        before = np.empty(len(text) + 1, bool)
        before[0] = False
        before[1:] = inside
        cut = np.zeros(len(text) + 1, bool)
        cut[offsets] = True
        start = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
        after = np.empty(len(text), bool)
        if len(text):
            after[:-1] = inside[1:]
            after[-1] = False
        end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.start, self.end = start, end
        self.first = np.searchsorted(start, offsets)
        self.hash = self._hashes(text, start, end)

    @staticmethod
    def _hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        i = 0
        while i < len(start):   # pieces of a very long text, cut between words
            j = max(i + 1, int(np.searchsorted(end, start[i] + SLICE_BYTES, "right")))
            lo, hi = start[i], end[j - 1]
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE_CODES[text[lo:hi]] * _DOWN.upto(hi - lo), out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = (sums[e] - sums[s]) * _UP.upto(hi - lo)[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its row."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of every k consecutive values of ``h`` (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = 1 << 20
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        part = h[lo:hi + k - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _DOWN.upto(len(part)), out=sums[1:])
        out[lo:hi] = (sums[k:] - sums[:-k]) * _UP.upto(len(part))[:hi - lo]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    if len(x) < w:
        return x[:0]
    m, span = x, 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = w - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def annotate(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.StructArray], into: str, kind: str) -> DataFrame:
    """``df`` plus one struct column ``into`` of type ``kind``, computed per Arrow batch; an input column of that name
    is replaced, all others pass unchanged."""
    rest = df.drop(into)
    names = [*rest.columns, *[c for c in df.columns if c.lower() == into.lower()]]
    # by position: mapInArrow cannot take columns whose names have dots
    given = df.select(*named(names)).toDF(*[f"c{i}" for i in range(len(names))])
    keep = len(rest.columns)
    schema = T.StructType([*rest.schema.fields, T.StructField(into, T.StructType.fromDDL(kind))])

    def run(batches):
        for b in batches:
            out = fn(b.rename_columns(names))
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], out], names=[*names[:keep], into])
    return given.mapInArrow(run, schema)


def struct(**columns) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def named(columns: list[str]) -> list[Column]:
    """Columns by their names, whatever characters these have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def scratch_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores added until no column of ``df`` has that name (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _spaced(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\f\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def word_array(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` of a text (null: none), by Spark functions."""
    return F.array_remove(F.split(_spaced(text), " "), "")


def n_words(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")
