import pytest
from pyspark.sql import functions as F

from llm import mixing as M
from llm.textops import table

SF = "/root/testdata/sf0.001"


def fill(sizes, weights, cap=3):
    """Clamp and reshare until nothing is above its cap."""
    total, full, target = sum(sizes), set(), {}
    while len(full) < len(sizes):
        rest = total - sum(cap * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = {i: rest * weights[i] / w for i in range(len(sizes)) if i not in full}
        above = {i for i, t in target.items() if t > cap * sizes[i]}
        if not above:
            break
        full |= above
    return [cap * sizes[i] if i in full else target[i] for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1000], [1, 2, 3, 4, 5, 6000, 7], [0, 5], [100, 1, 1, 1], [0, 0], [7],
                                   [3, 3, 3, 3, 900]])
def test_water_fill(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame([(f"s{i}", s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))],
                               "source string, source_size long, weight double")
    got = [r.target for r in M.water_fill(df).orderBy("source").collect()]
    assert got == pytest.approx(fill(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))


def check(rows):
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in by)
    sizes = [sum(r.size for r in by[s]) for s in names]
    for s, n, want in zip(names, sizes, fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])):
        assert {r.source_size for r in by[s]} == {n}
        assert [r.target for r in by[s]] == pytest.approx([want] * len(by[s]))
        assert abs(sum(r.taken for r in by[s]) - want) <= 1


def test_documents(spark):
    docs = table(spark, SF, "documents")
    a, b = (sorted(M.contract(d).collect()) for d in (docs, docs.repartition(7)))
    assert a == b and len(a) == docs.count()
    check(a)


def test_edges(spark):
    rows = [(1, "a b c", None), (2, None, None), (3, "", "é"), (3, "x y", "é"), (3, "x y", "é"), (None, "q", "Z"), (None, "q r", "Z"),
            (4, "w " * 5000, "a"), (5, " \t\r\n\x0b\x0c  ", "\U0001F600"), (6, "one", "�")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("taken", F.lit("x")) \
        .withColumn("order_", F.lit(1)).withColumn("level", F.lit(2))
    out = M.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "order_", "level", "size", "source_size", "target", "taken"]
    got = out.collect()
    assert len(got) == len(rows)
    check(got)
    assert {r.doc_id: r.size for r in got}[5] == 1


def test_empty(spark):
    assert M.contract(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    zero = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in M.contract(zero).collect()} == {(0.0, 0)}


def test_sample(spark):
    docs = table(spark, SF, "documents")
    plan = {r.doc_id: r for r in M.mix(docs).collect()}
    rows = M.sample(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        words, whole = r.text.split(), plan[r.doc_id].text
        assert r.taken == len(words) > 0 and whole.startswith(r.text) and words == whole.split()[:r.taken]
        assert r.n_chars == len(r.text)
    assert set(by) == {d for d, r in plan.items() if r.taken}
    for d, some in by.items():
        assert sum(r.taken for r in some) == plan[d].taken
        assert sorted(r.repeat for r in some) == list(range(len(some))) and sum(r.taken < r.size for r in some) <= 1
    assert len(rows) > len(by)
    assert M.sample(docs.limit(0)).collect() == []


def test_any_extra_column_name(spark):
    names = ("part before whole words s_ c_ of_ at_ before_ whole_ part_ run_ order_ cell_ s capacity total full rest level clamped final "
             "weight place repeat").split()
    rows = [(i, "a b c " * i, f"s{i % 3}") for i in range(1, 12)]
    plain = {r.doc_id: r.taken for r in M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], ["doc_id", "text", "source", *names])
    out = M.mix(docs)
    assert out.columns == ["doc_id", "text", "source", *names, "size", "source_size", "target", "taken"]
    got = out.collect()
    assert {r.doc_id: r.taken for r in got} == plain and {tuple(r[n] for n in names) for r in got} == {tuple(range(len(names)))}
    taken = {}
    for r in M.sample(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert taken == {k: v for k, v in plain.items() if v}


def test_a_weight_of_zero_takes_nothing(spark):
    rows = [("a", 100, 0.0), ("b", 40, 5.0), ("c", 30, 1.0), ("d", 0, 2.0), ("e", 9, 0.0)]
    got = {r.source: r.target for r in M.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight double")).collect()}
    # 179 words: b stops at 120, the rest goes to c
    assert got == {"a": 0.0, "b": 120.0, "c": 59.0, "d": 0.0, "e": 0.0}
    none = M.water_fill(spark.createDataFrame([("a", 5, 0.0)], "source string, source_size long, weight double")).collect()
    assert [r.target for r in none] == [0.0]


def test_null_ids_are_spread_over_cells(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "s") for i in range(500)], "doc_id long, text string, source string")
    plan = M.mix(docs)
    check(plan.collect())
    assert "null " in plan._jdf.queryExecution().optimizedPlan().toString()
