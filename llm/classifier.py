"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader (proximal).

Features of a text are its words (lower-cased), its pairs of consecutive words (a word that repeats the one before is
one feature of its own, whatever the word) and the last two bytes of each word, hashed to ``2**bits`` weights.  The
value of a feature is its share of the words.  Weights are learned per coordinate with FTRL in a few shards, each in its
own task, and averaged; scoring is one sparse dot product per text.  Only the text is a feature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.textops import LOWER, SPACES, U, Words, annotate, lists, mix, struct, text_slices

BITS = 18
MAX_TRAIN = 20_000     # labelled rows that are used at most (those with the smallest hashes)
SHARDS, EPOCHS = 4, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0, 0.001
SCALE = 8.0            # times a feature's share of the words
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_KINDS = [U(0x8CB92BA72F3D8DD7), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)]


def features(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight index) of every feature occurrence, and the words of every row."""
    w = Words(raw, offsets, SPACES, LOWER)
    row, h = w.rows(), w.hash
    paired = np.flatnonzero(w.room() >= 2)
    a, b = h[paired], h[paired + 1]
    pair = np.where(a == b, _KINDS[1], mix(a * _KINDS[1] + b))
    tail = raw[w.end - 1].astype(np.uint64) + np.where(w.end - w.start > 1, raw[np.maximum(w.end - 2, 0)], 0).astype(np.uint64) * U(256)
    index = np.concatenate([mix(h + _KINDS[0]), mix(pair), mix(tail * _KINDS[2] + _KINDS[2])]) >> U(64 - bits)
    return np.concatenate([row, row[paired], row]), index.astype(np.int64), w.counts


def held_out(doc_id: Column) -> Column:
    """A null id is in the held-out part: it is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after ``epochs`` passes over (indices, values, label)."""
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(epochs):
        for index, value, label in examples:
            index, value = np.append(index, size), np.append(value, 1.0)
            p = 1 / (1 + np.exp(-np.clip(w[index] @ value, -35, 35)))
            g = (p - label) * value
            step = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - step * w[index]
            n[index] += g * g
            zi = z[index]
            w[index] = -np.sign(zi) * np.maximum(np.abs(zi) - L1, 0) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
    return w


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_train: int = MAX_TRAIN, shards: int = SHARDS) -> np.ndarray:
    """Averaged weights from labelled rows outside the held-out fold; zeros where there are none.

    Labels other than 0 and 1 and labels without a document are not used; equal labels of one doc_id count once, a doc_id
    labelled both 0 and 1 gives an example of each.  Rows with the same doc_id are examples each, in the order of a hash of
    the doc_id, then doc_id, label and a hash of the text, so the weights do not depend on how the rows are spread.  Null and
    empty texts are examples of the bias alone; texts of any length count whole; other columns are not used, whatever their
    names.  Empty tables give zeros.
    """
    known = labels.where("quality in (0, 1)").where(~held_out(F.col("doc_id"))) \
        .select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("label")).distinct()
    picked = known.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(max_train)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).join(F.broadcast(picked), F.col("doc_id") == F.col("labelled"))   # max_train rows

    def extract(batches):
        for b in batches:
            for i, raw, offsets in text_slices(b.column(1)):
                n = len(offsets) - 1
                row, index, words = features(raw, offsets, bits)
                key, count = np.unique(row << bits | index, return_counts=True)
                r = key >> bits
                value = count * SCALE / np.maximum(words[r], 1)
                first = np.searchsorted(r, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), b.column(2).slice(i, n), lists(key & ((1 << bits) - 1), first, pa.int32()),
                     lists(value, first, pa.float64()), b.column(3).slice(i, n)], names=["doc_id", "label", "index", "value", "tie"])

    def learn(t: pa.Table) -> pa.Table:
        t = t.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("label", "ascending"), ("tie", "ascending")])
        examples = [(np.array(i, np.int64), np.array(v), int(y)) for i, v, y in
                    zip((x.values for x in t["index"]), (x.values for x in t["value"]), t["label"].to_pylist())]
        w = ftrl(examples, 1 << bits)
        at = np.flatnonzero(w)
        return pa.table({"index": pa.array(at, pa.int32()), "weight": pa.array(w[at])})

    found = rows.select("doc_id", "text", "label", "tie") \
        .mapInArrow(extract, "doc_id long, label int, index array<int>, value array<double>, tie long")
    parts = found.withColumn("order", F.xxhash64("doc_id", F.lit(1))).withColumn("shard", F.pmod("order", F.lit(shards))) \
        .groupBy("shard").applyInArrow(learn, "index int, weight double")
    mean = parts.groupBy("index").agg(F.collect_list("weight").alias("w"))   # as many as shards
    weights = np.zeros((1 << bits) + 1)
    got = mean.select("index", F.aggregate(F.sort_array("w"), F.lit(0.0), lambda a, x: a + x).alias("w")).toArrow()   # at most 2**bits + 1 rows
    weights[got["index"].to_numpy()] = got["w"].to_numpy() / shards
    return weights


def score(docs: DataFrame, weights: np.ndarray, into: str = "quality_score") -> DataFrame:
    """``docs`` plus a struct (score from 0 to 1, predicted).  A null or empty text scores the bias alone; equal
    texts score alike; texts of any length are scored whole; a column named like ``into`` is replaced, others pass
    unchanged; an empty table gives an empty result."""
    bits = (len(weights) - 1).bit_length() - 1

    def fn(b: pa.RecordBatch) -> pa.StructArray:
        out = np.zeros(b.num_rows)
        for i, raw, offsets in text_slices(b.column("text")):
            row, index, words = features(raw, offsets, bits)
            sums = np.bincount(row, weights[index], minlength=len(words))
            logit = weights[-1] + sums * SCALE / np.maximum(words, 1)
            out[i:i + len(words)] = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
        return struct(score=pa.array(out), predicted=pa.array((out >= THRESHOLD).astype(np.int32)))
    return annotate(docs, fn, into, "score double, predicted int")


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score(docs, train(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                                   "quality_score.score", "quality_score.predicted")
