"""Write docs/PLANS.md: the executed physical plan (operator chain) of every registered query.

Usage: python tools/plan_report.py [/root/testdata/sf0.01]
Each query is executed (noop sink) so the adaptive plan shown is the final one.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FLAGS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "Window", "Expand",
         "MapInPandas", "SortAggregate", "TakeOrderedAndProject")


def chain(plan: str) -> list[str]:
    nodes = []
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-]*(\*\(\d+\) )?([A-Z][A-Za-z]+)(?: ([A-Za-z]+))?", line)
        if m:
            name = m.group(2) + (f" {m.group(3)}" if m.group(3) in ("parquet", "json", "text", "SinglePartition",
                                                                     "hashpartitioning", "rangepartitioning",
                                                                     "LeftOuter", "LeftSemi", "LeftAnti", "Inner")
                                   else "")
            nodes.append(name)
    return nodes


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    from ledgerline.plans import registry
    from ledgerline.session import build_session
    spark = build_session("local[8]", "plans", 8, extra={"spark.ui.showConsoleProgress": "false"})
    out = ["# Executed physical plans", "",
           f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on). One line per query: the",
           "operator chain of the final adaptive plan, root first. Shuffles are `Exchange`; a",
           "`SinglePartition` exchange only ever follows a partial aggregate (one row per task) or",
           "feeds a window over already-aggregated rows.", ""]
    for name, fn in registry.queries().items():
        df = fn(spark, sf_dir)
        try:
            df.collect() if name not in ("enriched_documents",) else df.limit(0).collect()
        except Exception as e:  # keep going: the report shows the failure
            out.append(f"- **{name}**: failed: {e!r}"[:300])
            continue
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        nodes = [n for n in chain(plan) if n not in ("AdaptiveSparkPlan", "Project", "Filter", "ColumnarToRow",
                                                       "InputAdapter", "WholeStageCodegen", "ResultQueryStage",
                                                       "ShuffleQueryStage", "BroadcastQueryStage")]
        shuffles = sum(1 for n in nodes if n.startswith("Exchange"))
        out.append(f"- **{name}** ({shuffles} shuffle{'s' if shuffles != 1 else ''}): " + " → ".join(nodes))
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
