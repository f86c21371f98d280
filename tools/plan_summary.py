"""Summarise the physical plans of registered queries, as first planned and as
AQE ran them: shuffles, broadcasts, join strategies, windows,
scans with their pushed filters and read columns. Writes PLANS.md.

    python tools/plan_summary.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwatch.plans import catalog  # noqa: E402
from ledgerwatch.session import get_session  # noqa: E402

DEFAULT = ["fraud_report", "fraud_report_day", "rule3_flagged", "rule4_flagged", "candidates",
           "scd2_clients", "scd2_three_batches", "append_absent_tx", "delta_filter", "load_gate"]


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ops = {
        "shuffle exchanges": sum(1 for x in lines if re.search(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", x)),
        "broadcasts": sum(1 for x in lines if "BroadcastExchange" in x),
        "broadcast hash joins": sum(1 for x in lines if "BroadcastHashJoin" in x),
        "sort-merge joins": sum(1 for x in lines if "SortMergeJoin" in x),
        "shuffled hash joins": sum(1 for x in lines if "ShuffledHashJoin" in x),
        "nested-loop joins": sum(1 for x in lines if "NestedLoopJoin" in x),
        "window operators": sum(1 for x in lines if re.search(r"\bWindow \[", x)),
        "hash aggregates": sum(1 for x in lines if "HashAggregate" in x),
        "python (Arrow) operators": sum(1 for x in lines if re.search(r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas", x)),
    }
    scans = []
    for x in lines:
        m = re.search(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", x)
        if m:
            table = os.path.basename(m.group(2).split(",")[0]).replace(".parquet", "")
            scans.append((table, m.group(1).count(",") + 1, m.group(3) or "-"))
    return {"ops": ops, "scans": scans}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `tools/plan_summary.py` on `{sf}`: the plan as first built and as AQE ran it.",
           "Scans list the table, the number of columns read and the filters pushed into Parquet.", ""]
    for name in names:
        df = catalog.QUERIES[name](spark, sf)
        initial = df._jdf.queryExecution().executedPlan().toString()
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        out += [f"## {name}", ""]
        for when, plan in (("Initial", initial), ("Final", final)):
            s = summarise(plan.replace("\u0000", "\\0"))
            out += [f"{when}: " + ", ".join(f"{k}: {v}" for k, v in s["ops"].items() if v), ""]
            out += [f"- scan `{table}`: {ncols} columns, pushed: {pushed[:160]}" for table, ncols, pushed in s["scans"]]
            out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
