"""Write PLANS.md: the executed physical plan shape of the headline
queries (exchanges, join strategies, Parquet scans with their read schema
and pushed filters).

Usage: python scripts/plan_report.py [sf_dir]"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import bench  # noqa: E402
from demandkit.plans import context, registry  # noqa: E402
from demandkit.session import build_session  # noqa: E402


def shape(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"\bExchange\b", plan)),
        "broadcast_hash_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "nested_loop_joins": plan.count("BroadcastNestedLoopJoin"),
        "cartesian": plan.count("CartesianProduct"),
        # A scan is one line of the plan.
        "scans": [m for line in plan.splitlines() if "FileScan parquet" in line for m in re.findall(
            r"(\w+)\.parquet[^\]]*\].*?PushedFilters: \[(.*?)\], ReadSchema: struct<([^>]*)>", line)],
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("demandkit-plans", shuffle_partitions=16)
    qs = registry.query_callables()
    lines = ["# Physical plans of the headline queries", "",
             f"Executed (AQE final) plans at `{sf}`; regenerate with `python scripts/plan_report.py`.",
             "Only the plan after the last checkpoint is shown: checkpointed inputs (daily series,",
             "encoder maps, per-pair totals, numbered frames) appear as `Scan ExistingRDD`.", "",
             "| query | exchanges | BHJ | SMJ | BNLJ (1-row) | cartesian |", "|---|---|---|---|---|---|"]
    details = []
    for name in bench.HEADLINE:
        context.reset()
        df = qs[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan.split("== Initial Plan ==")[0])
        lines.append(f"| {name} | {s['exchanges']} | {s['broadcast_hash_joins']} | {s['sort_merge_joins']} | "
                     f"{s['nested_loop_joins']} | {s['cartesian']} |")
        for table, pushed, schema in s["scans"]:
            details.append(f"| {name} | {table} | `{schema}` | `{pushed}` |")
    lines += ["", "## Parquet scans", "", "| query | table | read schema | pushed filters |", "|---|---|---|---|",
              *details, ""]
    (ROOT / "PLANS.md").write_text("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
