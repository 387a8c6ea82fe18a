"""Write PLANS.md: per query, the shape of the physical plan Spark chose.

Counts shuffle stages, exchanges reused across branches, broadcast stages,
WindowGroupLimit (map-side and final top-n), sort-merge vs broadcast joins,
Python UDF nodes, and lists each Parquet scan's read columns and pushed
filters. The DataFrame itself is executed (``collect``), so its own
query execution holds AQE's final plan (``isFinalPlan=true``).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = {"gbt_train_score", "gbt_tune", "gbt_bagging", "feature_importance", "distil_train"}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ledgerline.catalog import REGISTRY
    from ledgerline.session import get_session
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan metadata
    print("# Physical plans of the registered queries\n")
    print(f"Input `{sf}`, local[8], AQE on; final adaptive plans. Generated by `tools/plan_report.py`.\n")
    print("| query | shuffle stages | reused exchanges | broadcast stages | WindowGroupLimit | SMJ | BHJ | Python UDF | scans (columns read · pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(REGISTRY):
        if name in SKIP:
            continue
        df = REGISTRY[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        ex = plan.count("ShuffleQueryStage")
        reused = plan.count("ReusedExchange")
        bc = plan.count("BroadcastQueryStage")
        wgl = plan.count("WindowGroupLimit")
        smj = plan.count("SortMergeJoin")
        bhj = plan.count("BroadcastHashJoin")
        py = "yes" if ("BatchEvalPython" in plan or "ArrowEvalPython" in plan) else "no"
        scans = []
        for sc in re.findall(r"FileScan parquet [^\n]*", plan):
            rs = re.search(r"ReadSchema: struct<(.*?)>(?:,|$)", sc)
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", sc)
            loc = re.search(r"\[file:([^\],]+)", sc)
            tbl = os.path.basename(loc.group(1)) if loc else "?"
            tbl = re.sub(r"-[0-9a-f]{32}$", "", tbl)
            ncols = len(re.findall(r"(?:^|,)[^,:]+:", rs.group(1))) if rs and rs.group(1) else 0
            scans.append(f"{tbl}: {ncols} · {pf.group(1)[:60] if pf and pf.group(1) else '–'}")
        print(f"| {name} | {ex} | {reused} | {bc} | {wgl} | {smj} | {bhj} | {py} | {'<br>'.join(sorted(set(scans)))} |")


if __name__ == "__main__":
    main()
