"""Registered queries: what SQL can express equals its oracle on whole tables."""

import duckdb
import pytest

from llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


def test_every_operator_has_one_query():
    assert sorted(QUERIES) == sorted({*QUERIES}) and [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    names = sorted(d[0] for d in result.description)
    assert names == sorted(df.columns)
    at = [[d[0] for d in result.description].index(n) for n in names]
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted(([norm(r[i]) for i in at] for r in result.fetchall()), key=repr)
    assert sorted(([norm(r[n]) for n in names] for r in df.collect()), key=repr) == want
