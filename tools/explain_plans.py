"""Print the physical plan of registered queries and a one-line summary each.

    python tools/explain_plans.py [sf_dir] [query ...]  > plans.txt

The summary counts what matters at scale: shuffles (Exchange), broadcasts,
sort-merge joins, partial aggregates, Python evaluation, and whether filters
reached the scan (PartitionFilters / PushedFilters) with a pruned ReadSchema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    # An adaptive plan prints the final plan, then the initial one: count the final only.
    plan = plan.split("== Initial Plan ==")[0]
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", plan)),
        "broadcast_exchanges": plan.count("BroadcastExchange"),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "partial_aggs": len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "partial_sort_aggs": len(re.findall(r"SortAggregate\(key=\[[^\]]*\], functions=\[partial_", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
        "partition_filters": len(re.findall(r"PartitionFilters: \[[^\]]+\]", plan)),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
    }


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in args if not a.startswith("/")]
    from daybook.queries import QUERIES
    from daybook.session import local_session

    spark = local_session()
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        df.collect()  # run this very plan so adaptive execution shows its final form
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"=== {name}: {summary(plan)}")
        print(plan)


if __name__ == "__main__":
    main()
