"""Summarise the final physical plan of every registered query -> PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
Runs each query (noop write) so the AQE plan is final, then counts exchanges
by kind, join strategies, aggregate operators, windows and Python nodes, and
lists the scans' read schema and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "hash-exch": r"Exchange hashpartitioning",
    "range-exch": r"Exchange rangepartitioning",
    "single-exch": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "SHJ": r"ShuffledHashJoin",
    "HashAgg": r"HashAggregate\(",
    "SortAgg": r"SortAggregate\(",
    "ObjAgg": r"ObjectHashAggregate\(",
    "Window": r"\bWindow \[",
    "GroupLimit": r"WindowGroupLimit",
    "Python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
    "reused": r"ReusedExchange",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from wagerflow.plans import QUERIES
    from wagerflow.session import get_session
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    rows = []
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        c = Counter({k: len(re.findall(p, final)) for k, p in PATTERNS.items()})
        scans = set(re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution()
                               .executedPlan().toString()))
        pushed = set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan))
        rows.append((name, c, sorted(scans), sorted(pushed)))
    spark.stop()
    cols = list(PATTERNS)
    out = ["| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, c, _, _ in rows:
        out.append(f"| `{name}` | " + " | ".join(str(c[k]) for k in cols) + " |")
    out.append("")
    out.append("Scans (read schema; pushed filters):")
    out.append("")
    for name, _, scans, pushed in rows:
        out.append(f"- `{name}`: {', '.join(scans) or '-'}; {', '.join(pushed) or '-'}")
    print("\n".join(out))


if __name__ == "__main__":
    main()
