import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import classifier as M
from llm.textops import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = M.contract(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    test = [(r, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == y for r, y in test]) > 0.9
    good, bad = ([r.score for r, y in test if y == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95   # area under the curve
    assert [tuple(r) for r in M.contract(docs.repartition(5), labels).orderBy("doc_id").collect()] == \
        [tuple(r) for r in sorted(rows)]


def test_features_by_hand():
    raw = np.frombuffer("a b b bAx".encode(), np.uint8)
    row, index, words = M.features(raw, np.array([0, 6, 9]))
    assert words.tolist() == [3, 1] and len(index) == 3 + 1 + 2 + 3 + 1   # words, pairs inside a row, word ends
    assert M.features(np.frombuffer(b"c c", np.uint8), np.array([0, 3]))[1][2] == index[5]   # a repeated word: one feature


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "good words here"), (3, "good words here"), (4, "x " * 30000), (None, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Score", F.lit(1)).withColumn("labelled", F.lit(2))
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (4, None), (99, 1), (None, 0)], "doc_id long, quality int")
    w = M.train(docs, labels)
    out = M.score(docs, w)
    assert out.columns == [*docs.columns, "quality_score"]
    got = [r.quality_score.score for r in out.collect()]
    assert len(got) == 7 and len({round(s, 12) for s in got[:3]}) == 1
    assert got[3] == got[4] > got[5]
    assert {r.score for r in M.contract(docs, labels.limit(0)).collect()} == {0.5}
    assert M.contract(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("limit", [1, 2])
def test_training_sample_is_bounded(spark, limit):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    assert (M.train(docs, labels, max_train=limit)[:-1] != 0).sum() <= 2 * limit


def plain_ftrl(examples, epochs):
    """Weights by feature, one coordinate at a time; the feature -1 is the bias."""
    z, n, w = {}, {}, {}
    for _ in range(epochs):
        for features, y in examples:
            x = {**features, -1: 1.0}
            p = 1 / (1 + math.exp(-sum(w.get(i, 0.0) * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / M.ALPHA * w.get(i, 0.0)
                n[i] = old + g * g
                w[i] = 0.0 if abs(z[i]) <= M.L1 else \
                    -(z[i] - math.copysign(M.L1, z[i])) / ((M.BETA + math.sqrt(n[i])) / M.ALPHA + M.L2)
    return w


def plain_features(text):
    row, index, words = M.features(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
    return {i: c * M.SCALE / max(1, int(words[0])) for i, c in Counter(index.tolist()).items()}


def test_weights_and_scores_equal_a_plain_program(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    docs = docs.unionByName(docs.limit(40).withColumn("text", F.concat(F.lit("other "), "text")))   # repeated ids, other texts
    shards = M.SHARDS
    rows = docs.join(labels, "doc_id").where("quality in (0, 1)").select(
        "doc_id", "text", "quality", F.xxhash64("doc_id", F.lit(1)).alias("o"), F.xxhash64("text").alias("t")).collect()
    rows = sorted((r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5), key=lambda r: (r.o, r.doc_id, r.quality, r.t))
    mean = Counter()
    for shard in range(shards):
        for i, v in plain_ftrl([(plain_features(r.text), r.quality) for r in rows if r.o % shards == shard], M.EPOCHS).items():
            mean[i] += v / shards
    w = M.train(docs, labels)
    want = np.zeros(len(w))
    for i, v in mean.items():
        want[i] = v
    assert len(rows) > 40 and np.count_nonzero(want) > 100
    assert np.allclose(w, want, rtol=1e-7, atol=1e-10)
    for r in M.score(docs, w).select("text", "quality_score.score").collect():
        logit = want[-1] + sum(v * want[i] for i, v in plain_features(r.text).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-8)
    assert np.array_equal(w, M.train(docs.repartition(7), labels))
