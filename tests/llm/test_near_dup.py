import re

import numpy as np
import pytest

from llm_fixtures import docs_of  # noqa: F401
from llm import near_dup as M
from llm.textops import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r)[:4] for r in df.collect()], key=repr)


def test_matches_brute_force_on_documents(spark):
    docs = table(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(M.contract(docs)) == want
    assert any(not r[3] for r in want)


def edges():
    rng = np.random.default_rng(3)
    w = [f"w{i}" for i in rng.integers(0, 10 ** 9, 400)]
    rows = [(i, None) for i in (90, 91)] + [(92, ""), (93, " \n"), (94, "One"), (95, "one "), (96, "one two"), (97, "two one"),
            (None, "ONE"), (None, "é e"), (98, "a b c"), (98, "a b c"), (98, "A  B\tC"), (99, "r " * 3000), (89, "r " * 4)]
    for i in range(30):   # a chain: neighbours are similar, the ends are not
        rows.append((i + 1, " ".join(w[4 * i:4 * i + 120])))
    for i in range(40):   # near copies with two words changed
        x = list(w[250:390])
        x[int(rng.integers(140))] = "new"
        x[int(rng.integers(140))] = f"new{i}"
        rows.append((200 + i, " ".join(x)))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_edges_and_small_blocks(spark, docs_of, block):
    rows = edges()
    out = M.near_duplicates(docs_of(rows).withColumnRenamed("source", "component_id"), block=block)
    assert got(out) == brute(rows)
    assert M.keep_one_of_each(docs_of(rows)).where("doc_id = 98").count() == 2


def test_empty(spark, docs_of):
    assert got(M.contract(docs_of([]))) == []


def test_signature_estimates_similarity_and_fills():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = np.sort(base[:300]), np.sort(base[100:])
    row, h = np.repeat([0, 1, 2], [300, 300, 2]), np.concatenate([a, b, base[:2]])
    sig = M.superminhash(row, h, 4, 120)
    assert (sig[:3] != 0xFFFFFFFFFFFFFFFF).all() and (sig[3] == 0xFFFFFFFFFFFFFFFF).all()
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.15
    # every element offers one value to each slot: a one-element set has all levels once
    one = M.superminhash(np.array([0]), base[:1], 1, 16)[0] >> np.uint64(32)
    assert sorted(one.tolist()) == list(range(16))


def test_blocks_find_exact_links():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)) for _ in range(25)]
    group = np.arange(25)
    want = {(i, j) for i in range(25) for j in range(25) if i != j
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    assert set(M.links_between(sets, group, group, group, 60)) == want


@pytest.mark.parametrize("pairs", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(i, 60 - i) for i in range(25)] + [(5, 99), (99, 98), (7, 98)],
                                   [(0, i) for i in range(1, 40)] + [(41, i) for i in range(42, 50)] + [(49, 39)]])
def test_components(spark, pairs):
    node = lambda i: bytes([i])
    links = spark.createDataFrame([(node(a), node(b)) for a, b in pairs], "a binary, b binary").repartition(7)
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {(x, find(x)) for x in parent if find(x) != x}
    got = [(r.node[0], r.label[0]) for r in M.components(links).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_one_of_each_with_null_and_repeated_ids(spark, docs_of):
    text = lambda stem: " ".join(f"{stem}{i}" for i in range(60))
    near = lambda stem: text(stem) + " end"
    rows = [(None, text("a")), (None, near("a")),                            # no id in the group: one of them
            (1, text("b")), (None, near("b")),                               # the numbered one
            (2, text("c")), (2, text("d")), (3, near("d")), (1, near("c")),  # 1 stands for c, 2 for d
            (None, text("e")), (4, text("f")), (4, near("f")),                # both rows of 4
            (None, None), (5, ""), (5, "")]
    got = [(r.doc_id, r.text) for r in M.keep_one_of_each(docs_of(rows)).collect()]
    assert len(got) == len(set(got))
    a = {(None, text("a")), (None, near("a"))}
    assert len(a & set(got)) == 1
    assert set(got) - a == {(1, text("b")), (1, near("c")), (2, text("d")), (None, text("e")), (4, text("f")), (4, near("f")),
                            (None, None), (5, "")}


def test_one_python_step_per_task(spark, docs_of, monkeypatch):
    """Links that Python found are written before Python groups them: a task never holds two workers."""
    plans, plain = [], M.components
    monkeypatch.setattr(M, "components", lambda links: plans.append(links._jdf.queryExecution().optimizedPlan().toString()) or plain(links))
    w = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w[:50] + [f"x{i}"])) for i in range(5)] + [(9, " ".join(w[:20]))]
    out = {r.doc_id: r.component_id for r in M.near_duplicates(docs_of(rows)).collect()}
    assert out == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 9: 9}
    assert len(plans) == 2 and not any("InArrow" in p for p in plans)
