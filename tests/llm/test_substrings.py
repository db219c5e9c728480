import hashlib
import re

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401
from llm import substrings as M
from llm.textops import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=50):
    """docs: (doc_id, text); a null doc_id is the smallest."""
    rank = lambda d: (d is not None, d)
    least = {}
    texts = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in texts:
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            least[x] = min(least.get(x, rank(d)), rank(d))
    out = []
    for d, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < rank(d):
                gone.update(range(k, k + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()], key=repr)


def test_matches_brute_force_on_documents(spark):
    docs = table(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(M.contract(docs)) == want
    assert any(0 < r[2] < r[1] for r in want) and any(r[2] == 0 for r in want)


def edges():
    rng = np.random.default_rng(5)
    w = [f"w{i}é" for i in rng.integers(0, 10 ** 9, 900)]
    a, b, c, d = (" ".join(w[i:i + 120]) for i in (0, 150, 300, 450))
    return [(1, a), (2, f"x {a}\ty"), (3, f"{a} {b}"), (4, f"{b} {a} {b}"), (5, " ".join(w[60:109])), (6, " ".join(w[60:110])),
            (7, None), (8, ""), (9, f"{c} {c}"), (10, f"{c} {d}"), (10, f"{d}"), (11, d), (11, d), (None, d), (None, c),
            (12, "r " * 400), (13, "r " * 49), (14, "r " * 55), (15, a.replace(" ", "\n")), (16, a[:-4] + " " + b[5:])]


def test_edges(spark, docs_of):
    rows = edges()
    assert got(M.contract(docs_of(rows).withColumnRenamed("source", "digest"))) == brute(rows)


def test_factors_and_kept_text(spark, docs_of):
    rows = edges()
    out = {r.doc_id: r for r in M.dedupe_substrings(docs_of(rows[:4])).collect()}
    assert [(f.start, f.words, f.reference) for f in out[2].factors] == [(1, 120, 1)]
    assert out[2].kept_text == "x y" and out[1].kept_text is None
    assert {f.reference for f in out[4].factors} == {1, 3}


def test_empty(spark, docs_of):
    assert got(M.contract(docs_of([]))) == []


def verbatim(rows, out):
    """Every factor stands in its reference at its place, and no factor could go one word further with it unnoticed."""
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(WORD.findall(t or ""))
    for d, fs in out:
        for f in fs or []:
            assert f.words >= 50
            part = lambda w, s: w[s:s + f.words]
            assert any(len(part(w, f.start)) == f.words and part(w, f.start) == part(r, f.place)
                       for w in texts[d] for r in texts[f.reference])


def test_factors_stand_in_their_reference(spark, docs_of):
    rng = np.random.default_rng(7)
    w = [f"w{i}" for i in range(400)]
    j = " ".join
    # documents 1 and 2 share parts in another order; 3 has a stretch that document 1 holds in two pieces only
    rows = [(1, j(w[:80] + ["x"] + w[40:120])), (2, j(w[60:130])), (3, j(w[:125])), (4, j(w[:60] + w[:60] + w[30:110])),
            (5, j(["y", *w[:51], "z", *w[70:130]])), (6, j(w[:200])), (7, j(w[100:200])), (None, j(w[150:220])), (-5, j(w[140:210]))]
    for _ in range(30):
        a, b, c = rng.integers(0, 300, 3)
        rows.append((len(rows) + 10, j(w[a:a + 90] + w[b:b + 60] + w[c:c + 70])))
    out = [(r.doc_id, r.factors) for r in M.dedupe_substrings(docs_of(rows)).collect()]
    verbatim(rows, out)
    assert got(M.contract(docs_of(rows))) == brute(rows)
    assert sum(len(f or []) for _, f in out) > 30


def test_factors_of_documents_stand_in_their_reference(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = [(r.doc_id, r.factors) for r in M.dedupe_substrings(docs).collect()]
    verbatim(rows, out)
    assert any(f for _, f in out)


def test_kept_text_only_where_asked(spark, docs_of):
    plain = M.dedupe_substrings(docs_of(edges()), texts=False)
    assert "kept_text" not in plain.columns and "kept_text" not in plain._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("at,source,place,want", [
    ([], [], [], []), ([3], [1], [0], [(3, 50, 1, 0)]),
    ([4, 3, 5, 9], [1, 1, 2, 2], [8, 7, 0, 4], [(3, 51, 1, 7), (5, 50, 2, 0), (9, 50, 2, 4)]),
    ([3, 4, 5], [1, 1, 1], [7, 2, 3], [(3, 50, 1, 7), (4, 51, 1, 2)])])
def test_greedy_factors(at, source, place, want):
    assert M.greedy_factors(np.array(at, int), np.array(source, int), np.array(place, int), 50) == want
