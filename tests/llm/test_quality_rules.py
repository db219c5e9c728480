import math
import re

import pytest
from pyspark.sql import functions as F

from llm import quality_rules as M
from llm.textops import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {x for x in wins if wins.count(x) > 1} if len(wins) < 400 else {x for x, n in __import__("collections").Counter(wins).items() if n > 1}
    rep = {j for i, x in enumerate(wins) if x in twice for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep)


def row(r):
    return tuple(r)[:6] + (r.base_failed,)


def test_counts_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in M.contract(docs, table(spark, SF, "labels")).collect()}
    for r in docs.collect():
        want = counts(r.text)
        assert tuple(got[r.doc_id])[1:6] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[r.doc_id].base_failed == failed and not (failed and got[r.doc_id].kept)


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x", "a b c\na b c\n\n a b c\n", "é # € <b>| 100% &", "a\x0bb\x0cc\rd",
         "w " * 4000, " ".join(f"w{i}" for i in range(6000)), "one\n\none\n", "a b c x a b c y a b c"]


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, None if i % 2 else "en") for i, t in enumerate(TEXTS)] + [(None, "a b", None), (3, "a", "en")],
                                 "doc_id long, text string, lang string").withColumn("kept", F.lit(1)).withColumn("cut_symbols", F.lit(2))
    labels = spark.createDataFrame([(0, 1), (0, 1), (None, 1), (3, None), (77, 0)], "doc_id long, quality int")
    out = M.apply_rules(docs, labels)
    assert out.columns == [*docs.columns, "quality_rules"]
    got = {r.doc_id: r.quality_rules for r in out.collect()}
    for i, t in enumerate(TEXTS):
        assert tuple(got[i])[:5] == counts(t), t
    assert out.count() == len(TEXTS) + 2
    assert M.contract(docs.limit(0), labels).collect() == [] and M.contract(docs, labels.limit(0)).count() == len(TEXTS) + 2


@pytest.mark.parametrize("n,k,p", [(1, 0, 0.02), (300, 0, 0.02), (300, 5, 0.02), (300, 6, 0.02), (5000, 80, 0.02), (5000, 99, 0.02),
                                   (40, 1, 0.3), (1000, 1000, 0.02), (900, 100, 0.2)])
def test_binomial_tail(spark, n, k, p):
    want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
    got = spark.range(1).select(M.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
    assert got == pytest.approx(want, rel=1e-9)


def test_large_tail_is_bounded_from_above(spark, monkeypatch):
    exact = spark.range(1).select(M.binomial_tail(F.lit(9000), F.lit(500_000), 0.02).alias("x")).first().x
    monkeypatch.setattr(M, "TERMS", 40)
    bound = spark.range(1).select(M.binomial_tail(F.lit(9000), F.lit(500_000), 0.02).alias("x")).first().x
    assert exact <= bound <= 2 * exact


def test_cutoffs_follow_the_fixed_sequence(spark):
    rows = [("a", 1, x / 1000) for x in range(1000)] + [("a", 0, 5.0)] * 50          # good ones spread over 0..1
    rows += [("b", 1, 0.0)] * 100 + [("b", 0, 5.0)] * 50                              # too few for a proof
    rows += [("c", 1, 0.0)] * 2000 + [("c", 0, 0.95)] * 50 + [("c", 0, 0.3)] * 50     # most lenient with the full gain
    df = spark.createDataFrame(rows, "stratum string, quality int, symbols double") \
        .select("*", *[F.lit(0.0).alias(r) for r in M.RULES if r != "symbols"])
    got = {r.stratum: r for r in M.cutoffs(df).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"].symbols == 1.0 and got["c"].symbols == 0.25 and got["c"].lines is None


def test_rules_reject_bad_and_keep_good(spark):
    clean = lambda i: " ".join(f"w{i}x{j}" for j in range(80))
    rows = [(i, clean(i), "en") for i in range(900)] + [(1000 + i, clean(i).replace(" ", "### "), "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(800)] + [(1000 + i, 0) for i in range(30)], "doc_id long, quality int")
    kept = {r.doc_id for r in M.good_documents(docs, labels).collect()}
    assert kept == set(range(900))


def test_plan_is_native_and_computes_counts_once(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    plan = M.good_documents(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("sort_array(") == 2   # of windows and of places: nothing is duplicated by the optimizer
