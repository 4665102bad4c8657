"""Summarise the executed (AQE final) physical plan of every registered query.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Per query: shuffles, joins, partial aggregates / group limits, scans with
their pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    final = []
    in_final = False
    for ln in lines:
        if "== Final Plan ==" in ln:
            in_final = True
            continue
        if "== Initial Plan ==" in ln:
            in_final = False
        if in_final or "isFinalPlan" not in plan:
            final.append(ln)
    text = "\n".join(final) if final else plan
    exchanges = len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|"
                               r"RoundRobinPartitioning)", text))
    bcast = len(re.findall(r"BroadcastExchange", text))
    joins = sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                  r"BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?"
                                  r"(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti)?",
                                  text)))
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    pushed = sorted({m for s in scans for m in re.findall(r"PushedFilters: \[[^\]]*\]", s)})
    schema = sorted({m for s in scans for m in re.findall(r"ReadSchema: struct<[^>]*>", s)})
    flags = []
    if "partial_" in text:
        flags.append("partial agg")
    if re.search(r"WindowGroupLimit[^\n]*Partial", text):
        flags.append("partial group limit")
    if "TakeOrderedAndProject" in text:
        flags.append("top-k")
    if "PythonUDF" in text or "EvalPython" in text:
        flags.append("PYTHON")
    if "Subquery" in text:
        flags.append("scalar subquery")
    return {"exchanges": exchanges, "broadcasts": bcast,
            "joins": ", ".join(" ".join(x for x in j if x) for j in joins) or "-",
            "flags": ", ".join(flags) or "-", "pushed": "; ".join(pushed) or "-",
            "schema": "; ".join(schema) or "-"}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from clickwin.plans.queries import QUERIES
    from clickwin.session import get_spark
    spark = get_spark("local[8]", 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    print(f"# Executed plans at {sf_dir}\n")
    print("Generated by `tools/plan_summary.py`: AQE final plans after execution.\n")
    print("| query | shuffles | broadcasts | joins | notes | pushed filters | read schema |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | {s['flags']} "
              f"| {s['pushed']} | {s['schema']} |")


if __name__ == "__main__":
    main(sys.argv)
