"""Print the static physical plan shape of every registered query.

Usage: python tests/plan_report.py [sf_dir]
AQE is off for the report (its runtime re-planning is not visible up front),
and so are broadcasts, as at cluster scale.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "nested_loop": plan.count("NestedLoopJoin"),
    }


def main() -> None:
    from histdim.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["hash_exchanges", "reused", "broadcast_joins", "sort_merge_joins", "windows",
            "group_limits", "nested_loop"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, q in E.queries().items():
        if name in E._llm_queries()[0]:
            continue
        s = shape(q(spark, sf)._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
