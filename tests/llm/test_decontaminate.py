import hashlib
import re

import pytest

from llm_fixtures import docs_of  # noqa: F401
from llm import decontaminate as M
from llm.textops import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r)[:6] for r in df.collect()], key=repr)


def test_matches_brute_force_on_tables(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    a = [(r.doc_id, r.text) for r in docs.collect()]
    b = [(r.item_id, r.text) for r in bench.collect()]
    want = brute(a, b)
    assert got(M.contract(docs, bench)) == want
    assert any(r[5] for r in want)


CASES = [(1, "One two three"), (2, None), (3, ""), (4, "x " * 5000 + "a b c d e f g h i j k tail"), (4, "x one-two;THREE"),
         (5, "a b c d e f g h i k j"), (None, "é one TWO three é"), (6, "one two"), (6, "one two")]
ITEMS = [(1, "one two three"), (2, "a b c d e f g h i j k"), (2, "a b c d e f g h i j k"), (3, None), (4, " .. "), (None, "É")]


@pytest.mark.parametrize("block", [8 << 20, 8])
def test_edges_and_blocks(spark, docs_of, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(CASES).withColumnRenamed("source", "n_hit")
    out = M.match_benchmark(docs, bench, block_bytes=block)
    rows = [(r.doc_id, r.contamination.n_words, r.contamination.n_hit, len(r.contamination.items)) for r in out.collect()]
    assert sorted(rows, key=repr) == sorted([r[:4] for r in brute(CASES, ITEMS)], key=repr)
    longest = {r.contamination.longest for r in out.where("doc_id = 4").collect()}
    assert 11 in longest
    assert M.decontaminate(docs, bench, block_bytes=block).columns == docs.columns


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(M.contract(docs_of([]), bench)) == []
    assert got(M.contract(docs_of(CASES), bench.limit(0))) == brute(CASES, [])


def plain_longest(text, items):
    """Longest run of document words, from the start of an occurring window, that stands in an item with that window."""
    w, best = words(text), 0
    for _, t in items:
        x = words(t)
        n = min(10, len(x))
        for k in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[k:k + n]:
                    m = n
                    while p + m < len(w) and k + m < len(x) and w[p + m] == x[k + m]:
                        m += 1
                    best = max(best, m)
    return best


def test_longest_follows_every_item(spark, docs_of):
    w = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(w[:10]) + " x"), (2, " ".join(w[:12])), (3, " ".join(w[3:30])), (4, " ".join(w[2:14] + w[:25])), (5, "w1 w2 w3")]
    texts = [" ".join(w[:12]), " ".join(w), "y " + " ".join(w[:11]) + " x", " ".join(w[5:20] + w[:9]), " ".join(w[2:14] + w[:40]),
             " ".join(w[1:4]), " ".join(w[:9]), ""]
    rows = list(enumerate(texts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (8 << 20, 60):
        out = M.match_benchmark(docs_of(rows), bench, block_bytes=block)
        assert {r.doc_id: r.contamination.longest for r in out.collect()} == {d: plain_longest(t, items) for d, t in rows}
    assert plain_longest(texts[0], items) == 12


def test_longest_on_few_words(spark, docs_of):
    import random
    random.seed(3)
    some = lambda n: " ".join(random.choices("ab", k=n))
    items = [(i, some(random.randrange(1, 40))) for i in range(25)] + [(99, " ".join("c" * 30))]
    rows = [(i, some(random.randrange(0, 60))) for i in range(40)] + [(99, " ".join("c" * 25))]
    out = M.match_benchmark(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r.contamination.longest for r in out.collect()} == {d: plain_longest(t, items) for d, t in rows}


def test_three_blocks_are_three_passes(spark, docs_of):
    """No task holds the index of more than one block: one Python step in the plan, whatever the benchmark's size."""
    bench = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i}") for i in range(30)], "item_id long, text string")
    docs = docs_of([(i, f"x a{i} b{i} c{i} d{i} y") for i in range(30)])
    out = M.match_benchmark(docs, bench, block_bytes=150)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, r.contamination.n_hit, tuple(r.contamination.items)) for r in out.collect()} == {(i, 4, (str(i),)) for i in range(30)}


def test_worker_memory(spark, docs_of, monkeypatch):
    """A batch of 6 MB of text is searched in a few dozen MB beside it, with the same hits."""
    import tracemalloc

    import pyarrow as pa
    w = [f"v{i}" for i in range(900)]
    text = " ".join(w[i * 37 % 900] for i in range(400))
    texts = [f"{text} {i}" if i % 50 else "a b c d e f g h i j k" for i in range(3600)]
    bench = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, " ".join(w))], "item_id long, text string")
    step = []
    monkeypatch.setattr(M, "annotate", lambda df, fn, into, kind: step.append(fn) or df)
    M.match_benchmark(docs_of([]), bench)
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert batch.nbytes > 6e6
    step[0](batch.slice(0, 2))
    tracemalloc.start()
    out = step[0](batch).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x["n_hit"] for x in out] == [0 if i % 50 else 10 for i in range(3600)]
    assert peak < 50e6, peak
