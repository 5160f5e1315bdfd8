"""Summarise the physical plans of registered queries (run after a change to a job).

    python tools/plan_report.py /root/testdata/sf0.01 > PLANS.md

For each query: shuffle and broadcast stages (AQE query stages), join strategies, window and
aggregate operators, whole-stage codegen stages, Python evaluation nodes, and per scan the pushed
filters and the columns read.  Each query's own plan is executed once first, so the report shows
the final adaptive plan (with AQE's runtime decisions).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.plans import catalog  # noqa: E402
from pricelake.session import get_spark  # noqa: E402

OPS = ["ShuffleQueryStage", "BroadcastQueryStage", "Exchange", "BroadcastExchange",
       "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "Window", "WindowGroupLimit", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "TakeOrderedAndProject", "Generate", "Union"]


def summarise(plan: str) -> dict:
    if "== Final Plan ==" in plan:
        tree = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    else:
        tree = plan.split("\n\n")[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    # a root has no branch mark in front of it
    counts = {op: len(re.findall(rf"(?m)(?:^|[-+] )(?:\* )?{op}\b", tree)) for op in OPS}
    counts = {k: v for k, v in counts.items() if v}
    details = {}
    for body in re.split(r"\n(?=\(\d+\) )", plan):
        m = re.match(r"\((\d+)\) ", body)
        if m and m.group(1) in ids:
            details[m.group(1)] = body
    codegen = len({c for b in details.values() for c in re.findall(r"\[codegen id : (\d+)\]", b)})
    python_nodes = len(re.findall(r"\b(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|"
                                  r"MapInPandas|MapInArrow|PythonUDF)\b", plan))
    scans = []
    for _, body in sorted(details.items(), key=lambda kv: int(kv[0])):
        if not re.match(r"\(\d+\) Scan (parquet|csv|json|text)", body):
            continue
        loc = re.search(r"Location: \w+ \[(?:file:)?([^\]]*)\]", body)
        pushed = re.search(r"PushedFilters: (\[[^\n]*\])", body)
        schema = re.search(r"ReadSchema: struct<([^\n]*)>", body)
        scans.append((os.path.basename(loc.group(1)) if loc else "?",
                      pushed.group(1) if pushed else "[]",
                      len(schema.group(1).split(",")) if schema else 0))
    return {"ops": counts, "scans": scans, "codegen": codegen, "python": python_nodes}


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered price queries\n")
    print(f"Input `{sf}`; final adaptive plans after one execution. `ShuffleQueryStage` = a "
          "shuffle; `BroadcastQueryStage` = a broadcast AQE chose from a measured size (there "
          "are no broadcast hints in the code). Scans list the table folder, pushed filters and the "
          "number of columns read. Python evaluation nodes (UDF / pandas operators) are counted "
          "to show that no row of these queries leaves the JVM. The training-data queries are not listed; "
          "all of them but `op3_mix` run Arrow code in Python workers.\n")
    for n in names:
        df = catalog.QUERIES[n](spark, sf)
        df._jdf.queryExecution().toRdd().count()     # run THIS plan, so AQE finalises it
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(plan)
        ops = ", ".join(f"{k} {v}" for k, v in s["ops"].items())
        print(f"## {n}\n\n- operators: {ops}")
        print(f"- whole-stage codegen stages: {s['codegen']}; Python evaluation nodes: {s['python']}")
        for table, pushed, ncols in s["scans"]:
            print(f"- scan `{table}`: {ncols} columns, pushed {pushed}")
        print()


if __name__ == "__main__":
    main(sys.argv)
