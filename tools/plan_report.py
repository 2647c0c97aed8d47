"""Summarise the physical plan of every registered batch query as a markdown table.

    python tools/plan_report.py [sf_dir] > PLANS.md

Plans are taken in their at-scale shape: the static broadcast bound is off
(at 100 TB no table side is estimated small; AQE may still broadcast at run
time from measured sizes).  Queries that write as part of their plan
(topic and upsert sinks) and the stream twins are left out.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsemart.plans.catalog import QUERIES  # noqa: E402
from pulsemart.session import get_session  # noqa: E402

WRITES = {"cdc_route", "upsert_table", "upsert_documents"}
COUNTED = [
    ("scans", r"FileScan parquet"),
    ("hash shuffles", r"[+-] Exchange hashpartitioning"),
    ("reused shuffles", r"ReusedExchange"),
    ("single-partition shuffles", r"[+-] Exchange SinglePartition"),
    ("hash agg", r"\bHashAggregate\("),
    ("object hash agg", r"ObjectHashAggregate\("),
    ("sort agg", r"SortAggregate\("),
    ("sort-merge joins", r"SortMergeJoin"),
    ("broadcast joins", r"BroadcastHashJoin"),
    ("windows", r"\bWindow \["),
    ("generators", r"\bGenerate "),
    ("python", r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
]


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    print("| query | " + " | ".join(name for name, _ in COUNTED) + " |")
    print("| --- |" + " --- |" * len(COUNTED))
    for name, fn in QUERIES.items():
        if name in WRITES:
            continue
        df = fn(spark, sf_dir)          # sets the session options; planning happens below
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")   # the static plan, before run-time changes
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(pattern, plan))) for _, pattern in COUNTED]
        print(f"| {name} | " + " | ".join(counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
