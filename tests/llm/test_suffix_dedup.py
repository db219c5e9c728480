"""Suffix-array dedup: the sort against Python's, whole results against a plain program, crowded anchors, edge cases."""

import hashlib
import random

import numpy as np
import pytest

from llm import suffix_dedup as S
from llm_fixtures import docs_of  # noqa: F401


def expected(rows, window=S.WINDOW):
    """rows (doc_id, text): by the contract, every window looked up in a dictionary."""
    key = lambda i: S.NO_ID if i is None else i
    least = {}
    for i, text in rows:
        t = (text or "").encode()
        for s in range(len(t) - window + 1):
            w = t[s:s + window]
            least[w] = min(least.get(w, key(i)), key(i))
    out = []
    for i, text in rows:
        t = (text or "").encode()
        gone = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if least[t[s:s + window]] < key(i):
                gone[s:s + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("shallow", [8, 16, 48])
def test_deep_shallow_order(shallow):
    rng = random.Random(shallow)
    for kind in range(6):
        parts = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(3)] if kind < 3 else [rng.randbytes(70) for _ in range(3)]
        text = b"".join(rng.choice(parts)[:rng.randint(20, 60)] for _ in range(40)) + b"a" * 130 * (kind % 2) + b"\0" * 60 + bytes(range(255, 190, -1))
        starts = np.array(sorted(rng.sample(range(len(text) - 49), min(900, len(text) - 49))))
        order, classes = S.deep_shallow(np.frombuffer(text, np.uint8), starts, 50, shallow)
        cut = [text[s:s + 50] for s in order.tolist()]
        assert cut == sorted(text[s:s + 50] for s in starts.tolist()) and sorted(order.tolist()) == starts.tolist()
        assert all((a == b) == (x == y) for a, b, x, y in zip(cut, cut[1:], classes, classes[1:]))


def test_blind_trie_keeps_order():
    rng = random.Random(4)
    trie, given = S.BlindTrie(5), [bytes(rng.choice(b"\0\1\xff") for _ in range(5)) for _ in range(300)]
    for i, g in enumerate(given):
        trie.add(int.from_bytes(g), i)
    assert [sorted({given[i] for i in leaf}) for leaf in trie.leaves()] == [[g] for g in sorted(set(given))]


def corpus(rng, n):
    words = ["".join(rng.choice("abcdeéß文") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [say(rng.randint(5, 40)) for _ in range(12)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(passages) if rng.random() < 0.3 else say(rng.randint(1, 20)) for _ in range(rng.randint(0, 8)))
        rows.append((i, text))
    return rows


def test_against_a_plain_program(spark, docs_of):
    rng = random.Random(11)
    rows = corpus(rng, 120)
    rows += [(500 + i, rows[rng.randrange(120)][1]) for i in range(15)]                       # copies
    rows += [(600 + i, rows[rng.randrange(120)][1].replace("a", "b", 1)) for i in range(15)]  # near copies
    rng.shuffle(rows)
    assert result(S.dedupe_bytes(docs_of(rows))) == expected(rows)


@pytest.mark.parametrize("crowd", [0, 3])
def test_crowded_anchors(spark, docs_of, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    rng = random.Random(12)
    rows = corpus(rng, 60) + [(100 + i, rng.choice("xyz") * rng.randint(1, 60) + "a passage that every document repeats, word by word. " * 2 +
                               str(rng.random())) for i in range(40)]
    assert result(S.dedupe_bytes(docs_of(rows))) == expected(rows)


def test_edges(spark, docs_of):
    base = "0123456789" * 5
    rows = [(1, base), (2, base), (3, "x" + base[:49]), (4, "x" + base + "y"), (5, None), (6, ""), (7, base[:49]), (7, base[:49]), (8, "z" * 5000),
            (9, "z" * 5001 + "q"), (10, base + base), (None, "of no id " * 8), (11, "of no id " * 8), (12, "é" * 40), (13, "x" + "é" * 40), (14, base),
            (14, base + "tail"), (15, "no match " + "".join(chr(300 + i) for i in range(200)) * 30), (16, "Z" * 30 + "".join(chr(300 + i) for i in range(200)))]
    rows += [(20, "same id, other text " * 4), (20, "another text with same id, other text " * 3), (20, "same id, other text " * 4)]
    assert result(S.dedupe_bytes(docs_of(rows))) == expected(rows)


def test_small_shards_and_stretches(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "TEXT", 200)
    monkeypatch.setattr(S, "STRETCH", 5)
    rows = corpus(random.Random(13), 50) + [(99, "ab" * 300), (98, "b" + "ab" * 200)]
    assert result(S.dedupe_bytes(docs_of(rows))) == expected(rows)


def test_empty_table_clashing_columns_and_text_ids(spark):
    schema = "doc_id string, text string, key string, a string, bucket string, rep string, spans string, n string, digest string"
    assert S.dedupe_bytes(spark.createDataFrame([], schema)).collect() == []
    rows = [("3", "one and the same text that is longer than fifty bytes in all", *["x"] * 7), ("12", "one and the same text that is longer than fifty bytes in all", *["x"] * 7)]
    got = {r.doc_id: (r.n_removed, r.spans, r.kept) for r in S.dedupe_bytes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {3: (0, [], None), 12: (60, [(0, 60)], bytearray())}


def test_kept_bytes_and_spans(spark, docs_of):
    common = "this sentence stands in both documents, word by word, letter by letter"
    (r,) = S.dedupe_bytes(docs_of([(1, common), (2, "Before. " + common + " After.")])).where("doc_id = 2").collect()
    assert r.kept == b"Before.  After." and r.spans == [(8, 8 + len(common))]


def test_crowded_stretches_stay_whole(monkeypatch):
    """A passage of many documents gives a row per stretch and document, not one per window."""
    monkeypatch.setattr(S, "CROWD", 0)
    pa = S.pa
    passage, window, n = ("a passage that every document repeats, word by word, and then once more, " * 3).encode(), 50, 300
    pieces = [passage[i:i + 80] for i in range(0, 120, 20)]
    rows = sorted((b, p, d, d, 20 * b, True) for b, p in enumerate(pieces) for d in range(n))
    names = ["bucket", "piece", "doc_id", "key", "start", "alone"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i:i + 77]]) for i in range(0, len(rows), 77)]
    found = [r for b in S._sort_buckets(window)(batches) for r in b.to_pylist()]
    assert sorted((r["doc_id"], r["start"], r["stop"]) for r in found) == sorted((d, 20 * b, 20 * b + 80) for b in range(6) for d in range(1, n))
    left = [r for b in S._first_windows(window)(batches) for r in b.to_pylist()]
    assert len(left) == 6 * 31 and all(r["doc_id"] == 0 and r["piece"] == passage[r["start"]:r["stop"]] for r in left)
