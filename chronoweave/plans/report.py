"""Static plan report for the catalog (``python -m chronoweave.plans.report``):
per query the shuffle / reuse / broadcast / scan counts of the physical plan
(AQE off, so the plan is the one Catalyst chose before runtime re-planning)."""
from __future__ import annotations

import re
import sys

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas",
         "SortAggregate", "ObjectHashAggregate", "Exchange SinglePartition")


def plan_stats(df) -> dict:
    p = df._jdf.queryExecution().executedPlan().toString()
    return {
        "exchanges": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p)),
        "reused": p.count("ReusedExchange"),
        "broadcasts": p.count("BroadcastExchange"),
        "scans": len(re.findall(r"ReadSchema:", p)),
        "flags": [f for f in FLAGS if f in p],
    }


def report(spark, sf_dir: str, names=None, flagship: str = "silver_long") -> str:
    from .catalog import QUERIES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = ["| query | exchanges | reused | broadcasts | scans | notes |", "|---|---|---|---|---|---|"]
        for n in names or sorted(QUERIES):
            st = plan_stats(QUERIES[n](spark, sf_dir))
            lines.append(f"| {n} | {st['exchanges']} | {st['reused']} | {st['broadcasts']} | {st['scans']} | "
                         f"{', '.join(st['flags'])} |")
        flag = QUERIES[flagship](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return "\n".join(lines), flag


def main() -> None:
    import os
    sys.path.insert(0, os.getcwd())
    from ..config import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    table, plan = report(spark, sf)
    print(table)
    print("\n```\n" + plan + "\n```")


if __name__ == "__main__":
    main()
