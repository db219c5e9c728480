import re

from llm_fixtures import docs_of  # noqa: F401
import corpus_pipeline as P
from pyspark.sql import functions as F

from llm import mixing, secret_scan
from llm.textops import stored, table
from test_decontaminate import brute as benchmark_hits
from test_mixing import check as check_mix
from test_near_dup import brute as groups  # three-word shingles
from test_quality_rules import counts
from test_secret_scan import base

SF = "/root/testdata/sf0.01"


def five_word_groups(rows):
    """doc_ids kept: smallest of each group linked at 0.8 on five-word shingles."""
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if x]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y, key=lambda k: rows[k][0])] = min(x, y, key=lambda k: rows[k][0])
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = {}
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        after = {r.doc_id: r for r in docs.collect()}
        out[name] = (before, after)
        if name != "mixing":
            assert docs.columns == columns and docs.count() == len(after)

    before, after = out["quality rules"]
    failed = {d for d, r in before.items() if (c := counts(r.text))[0] < 50 or 100 * c[4] > 50 * c[0]}
    gone = set(before) - set(after)
    assert failed <= gone and all("#" in texts[d] or "$" in texts[d] or "|" in texts[d] or "!" in texts[d] for d in gone - failed)
    before, after = out["near duplicates"]
    assert set(after) == five_word_groups([(d, r.text) for d, r in sorted(before.items())]) and len(after) < len(before)
    before, after = out["benchmark decontamination"]
    hit = {r[0] for r in benchmark_hits([(d, r.text) for d, r in before.items()],
                                        [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]) if r[5]}
    assert hit and set(after) == set(before) - hit
    before, after = out["secret scans"]
    assert set(after) == set(before)
    for d, r in before.items():
        spans = [(s, k, e) for s, k, e in base(r.text)]
        assert after[d].text == secret_scan._masked(r.text, spans, "[secret]") and after[d].n_chars == len(after[d].text)
    check_mix(list(out["mixing"][1].values()))
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_and_null_documents(spark, docs_of):
    for rows in ([], [(1, None), (None, ""), (2, "a"), (2, "a"), (None, "w " * 60)]):
        docs = docs_of(rows).withColumn("extra", F.lit("x")).withColumn("secrets_", F.lit(1)).withColumn("a.b c", F.lit(2))
        for name, stage in P.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= len(rows)
