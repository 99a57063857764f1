"""Print the shape of the physical plan of the headline queries (as
Markdown) -- exchanges, joins, aggregates, windows and scan pushdown.

usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from roadlens.plans.catalog import load_all  # noqa: E402
from roadlens.session import build_session  # noqa: E402

KEYS = (
    "Scan ExistingRDD",
    "Exchange",
    "ReusedExchange",
    "BroadcastHashJoin",
    "SortMergeJoin",
    "ShuffledHashJoin",
    "HashAggregate",
    "SortAggregate",
    "ObjectHashAggregate",
    "WindowGroupLimit",
    "Window [",
    "Generate",
    "FileScan",
    "TransformWithStateInPandas",
)


def shorten(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r"\[plan_id=\d+\]", "", line)
    line = line.replace("ENSURE_REQUIREMENTS, ", "")
    if "FileScan" in line:
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        return f"FileScan parquet [{cols.group(1) if cols else ''}] PushedFilters: [{pushed.group(1) if pushed else ''}]"
    return line[:160]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan, before runtime changes
    reg = load_all()
    print("# Physical plan shapes\n")
    print(f"Static plans (AQE off, so runtime coalescing and broadcast conversion are not shown) on `{sf}`,")
    print("generated by `scripts/show_plans.py`. Only exchanges, joins, aggregates, windows and scans are listed.\n")
    # Row stages that a query materialises (checkpoint) before its own plan.
    from roadlens.operators import detect as DT
    from roadlens.operators import sessions as SS
    from roadlens.plans.queries_batch import TEST_LIMIT_KMH
    from roadlens.sources import testmap as TM

    stages = {
        "trip_sessions": ("row stage, materialised", lambda: SS.session_fragments(TM.telemetry_light(spark, sf))),
        "detect_events": (
            "row stage (changed rows of it are materialised)",
            lambda: DT.rule_conditions(TM.telemetry_light(spark, sf), TEST_LIMIT_KMH, keep_bucket=True),
        ),
    }
    for name in HEADLINE:
        if name.startswith("stream_"):
            continue
        parts = []
        if name in stages:
            label, build = stages[name]
            parts.append((label, build()))
        parts.append(("after the checkpoint" if name in stages else None, reg[name][0](spark, sf)))
        print(f"## {name}\n")
        for label, df in parts:
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = [shorten(l.strip().lstrip(":+- ").strip()) for l in plan.splitlines() if any(k in l for k in KEYS)]
            n_ex = sum(1 for l in lines if l.startswith("Exchange"))
            print(f"{label}: " if label else "", end="")
            print(f"{n_ex} exchanges.\n\n```")
            for l in lines:
                print(l)
            print("```\n")


if __name__ == "__main__":
    main()
