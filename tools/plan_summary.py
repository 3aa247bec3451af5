"""Summarise every registered query's physical plan.

Usage: python tools/plan_summary.py [sf_dir] > docs/PLANS.md

For each query: shuffles, join strategies and aggregate operators, once as
planned for the local tables and once with broadcasting disabled (the shape
the plan takes when every loan-sized table is far above any broadcast
threshold).  AQE is off here so the static plan is shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bookshift.plans.catalog import QUERIES  # noqa: E402
from bookshift.session import get_session  # noqa: E402

OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window", "Generate"]


def summarise(plan: str) -> str:
    shuffles = len(re.findall(r"^\s*[:+\- ]*Exchange hashpartitioning|^\s*[:+\- ]*Exchange rangepartitioning|"
                              r"^\s*[:+\- ]*Exchange SinglePartition|^\s*[:+\- ]*Exchange RoundRobin", plan, re.M))
    single = len(re.findall(r"Exchange SinglePartition", plan))
    parts = [f"{shuffles} shuffles" + (f" ({single} single-partition)" if single else "")]
    for op in OPS:
        n = len(re.findall(rf"(?<![A-Za-z]){op}(?![A-Za-z])", plan))
        if n:
            parts.append(f"{op} x{n}")
    return ", ".join(parts)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16, extra={"spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf}` (AQE off, static plans). 'no broadcast' sets "
          "`spark.sql.autoBroadcastJoinThreshold=-1`; only the row offsets of `row_sequence` are still broadcast.\n")
    print("| query | local plan | no broadcast |")
    print("| --- | --- | --- |")
    for name, fn in QUERIES.items():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        local = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        big = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(f"| {name} | {summarise(local)} | {summarise(big)} |")
    spark.stop()


if __name__ == "__main__":
    main()
