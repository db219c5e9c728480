"""Filter audit: streams in any file order against a plain program, replayed batches, hot texts, edge cases."""

import random
from collections import Counter
from itertools import permutations

import pytest

from llm import filter_audit as A

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, key string, mask string, good string, id string"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def expected(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic), by the contract, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, source in rows:
        t = text or ""
        for c in "\t\n\x0b\f\r":
            t = t.replace(c, " ")
        words = [w for w in t.split(" ") if w]
        fails = set()
        t = text or ""
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if i is not None and any(j is not None and j < i and (x or "") == t for j, x, _ in rows) else set()
        docs.append((source or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for step, letter in enumerate(order, 1):
            for part in {d[0] for d in docs}:
                own = [d for d in docs if d[0] == part]
                gone = [bool(d[1] & set(order[:step - 1])) for d in own]
                fails = [letter in d[1] for d in own]
                removed = [f and not g for f, g in zip(fails, gone)]
                shapley[part, letter] += sum(removed)
                out[part, order, step] = [sum(not f and not g for f, g in zip(fails, gone)), sum(removed),
                                          sum(f and g for f, g in zip(fails, gone)), sum(d[1] == {letter} for d in own),
                                          sum(r and d[2] for r, d in zip(removed, own)), sum(r and d[3] for r, d in zip(removed, own))]
    return {k: tuple(v) + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def run(spark, workdir, rows, labels, files=4, schema=SCHEMA):
    path = f"{workdir}/docs.parquet"
    pad = len(schema.split(",")) - 5
    chunks = [rows[k::files] for k in range(files)]
    for chunk in chunks:
        spark.createDataFrame([(i, t, "en", s, 1, *["x"] * pad) for i, t, s in chunk], schema).coalesce(1).write.mode("append").parquet(path)
    got = A.contract(spark, path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len({(r.part, r.filter_order, r.step) for r in got}) == len(got)
    return {(r.part, r.filter_order, r.step): tuple(r[f] for f in FIGURES) for r in got}


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def test_smaller_ids_arrive_later(spark, workdir):
    rng = random.Random(1)
    texts = [words(rng, 250), words(rng, 250) + " $", words(rng, 20), "SHOUT " * 260, "", words(rng, 300, 5), words(rng, 220, 9) + " %|"]
    rows = [(i, rng.choice(texts), rng.choice(("a", "a", "b", None, ""))) for i in range(60)]
    rows += [(7, texts[0], "b"), (7, texts[0], "a"), (None, texts[0], "a"), (None, None, "b"), (3, None, None), (200, words(rng, 30_000, 20_000), "long")]
    rng.shuffle(rows)
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1))) for i in range(0, 60, 2)] + [(4, 1, 0), (None, 1, 1)]
    assert run(spark, workdir, rows, labels) == expected(rows, labels)


def test_descending_ids_are_retracted_batch_by_batch(spark, workdir, monkeypatch):
    rows = [(i, "one text", "p" + str(i % 2)) for i in range(12, 0, -1)]
    path = f"{workdir}/docs.parquet"
    for k in range(4):
        spark.createDataFrame([(i, t, s) for i, t, s in rows[3 * k:3 * k + 3]], "doc_id long, text string, source string").coalesce(1) \
            .write.mode("append").parquet(path)
    labels = A.label_flags(spark.createDataFrame([(1, 1, 0), (12, 0, 1)], "doc_id long, quality int, toxic int"))
    stream = A.file_stream(spark, path, batches=4)
    got = {(r.part, r["mask"], r.good, r.toxic): r.n for r in A.counters(stream, labels).collect()}
    a = A.BIT["A"]
    assert got == {("p1", a, True, False): 1, ("p1", a | A.E, False, False): 5, ("p0", a | A.E, False, True): 1, ("p0", a | A.E, False, False): 5}


def test_state_is_gathered_again(spark, workdir, monkeypatch):
    monkeypatch.setattr(A, "GATHER", 2)
    rng = random.Random(2)
    rows = [(i, f"text {rng.randrange(6)}", "s") for i in range(20, 0, -1)] + [(5, "text 1", "t"), (5, "text 1", "s")]
    path = f"{workdir}/docs.parquet"
    for k in range(0, len(rows), 4):
        spark.createDataFrame(rows[k:k + 4], "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(path)
    no_labels = A.label_flags(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = {(r.part, r["mask"]): r.n for r in A.counters(A.file_stream(spark, path, batches=6), no_labels, f"{workdir}/audit").collect()}
    want = Counter((s, A.BIT["A"] | (A.E if any(j < i and x == t for j, x, _ in rows) else 0)) for i, t, s in rows)
    assert got == want


def test_empty_table(spark, workdir):
    assert run(spark, workdir, [], [(1, 1, 1)], files=1) == {}


def test_string_ids_and_no_labels(spark, workdir):
    rows = [(i, t, "s") for i, t in (("b", "x"), ("a", "x"), ("c", "#"))]
    path = f"{workdir}/docs.parquet"
    spark.createDataFrame(rows, "doc_id string, text string, source string").write.parquet(path)
    got = A.contract(spark, path, spark.createDataFrame([], "doc_id string, quality int, toxic int")).collect()
    want = expected(rows, [])
    assert {(r.part, r.filter_order, r.step): tuple(r[f] for f in FIGURES) for r in got} == want


def test_a_replayed_batch_counts_once(spark, workdir, monkeypatch):
    """The first run dies after its second micro-batch was written and before it was committed; the next goes on there."""
    rows = [(i, f"text {i % 3}", "s") for i in range(12, 0, -1)]
    path = f"{workdir}/docs.parquet"
    for k in range(4):
        spark.createDataFrame(rows[3 * k:3 * k + 3], "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(path)
    no_labels = A.label_flags(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    log, calls = A.log_changes, []

    def dies(batch, path):
        log(batch, path)
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
    monkeypatch.setattr(A, "log_changes", dies)
    stream = A.file_stream(spark, path, batches=4)
    with pytest.raises(Exception, match="lost driver"):
        A.counters(stream, no_labels, f"{workdir}/audit").collect()
    got = {r["mask"]: r.n for r in A.counters(stream, no_labels, f"{workdir}/audit").collect()}
    a = A.BIT["A"]
    assert len(calls) == 5 and calls[1] == calls[2] and got == {a: 3, a | A.E: 9}
