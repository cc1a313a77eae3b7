"""Write PLANS.md: the physical shape of every registered query at one scale.

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
For each query (of the coupon library): shuffles, joins by strategy, Python stages, windows with a
partial group limit, and what reaches the parquet scans (pushed filters,
read schema). Built from the executed plan, without running the query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cupola.plans.catalog import QUERIES  # noqa: E402
from cupola.session import checkpoint_dir, get_spark  # noqa: E402

NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "Window", "WindowGroupLimit", "Expand", "Generate", "FlatMapCoGroupsInPandas", "ArrowEvalPython",
         "BatchEvalPython", "InMemoryTableScan", "Scan ExistingRDD"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    checkpoint_dir(spark)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` at `{sf_dir}` (local[8], AQE on; counts are for the plan")
    print("before adaptive re-planning). Scans of `tables/<id>` folders under the checkpoint folder are "
          "intermediate tables written once by `materialise` and read back.\n")
    print("| query | shuffles | joins | aggregates | windows | python | scans: pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = {n: len(re.findall(rf"\b{re.escape(n)}\b", plan)) for n in NODES}
        shuffles = c["Exchange"]
        joins = ", ".join(f"{c[j]} {j}" for j in ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
                                                   "BroadcastNestedLoopJoin", "CartesianProduct"] if c[j])
        aggs = ", ".join(f"{c[a]} {a}" for a in ["HashAggregate", "ObjectHashAggregate", "SortAggregate"] if c[a])
        wins = f"{c['Window']}" + (f" ({c['WindowGroupLimit']} group-limit)" if c["WindowGroupLimit"] else "")
        py = ", ".join(f"{c[p]} {p}" for p in ["FlatMapCoGroupsInPandas", "ArrowEvalPython", "BatchEvalPython"]
                       if c[p]) or "-"
        pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]\n]*)\]", plan) if m})
        print(f"| `{name}` | {shuffles} | {joins or '-'} | {aggs or '-'} | {wins} | {py} | "
              f"{'; '.join(pushed) or '-'} |")


if __name__ == "__main__":
    main()
