"""Summarise the final physical plan of registered queries: data shuffles,
broadcasts, checkpoint scans, and the columns and pushed filters of each
Parquet scan (the table in the README's "Plans" section).

    python tools/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonelake.plans.registry import QUERIES  # noqa: E402
from zonelake.session import local_session  # noqa: E402

HEADLINE = [
    "customer_landing",
    "consent_filter",
    "customer_trusted",
    "accelerometer_trusted",
    "step_trainer_trusted",
    "customer_curated",
    "device_readings_with_owner",
    "ml_curated",
]


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[(.*?)\], ReadSchema", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "checkpoint_scans": plan.count("Scan ExistingRDD"),
        "parquet_scans": [
            {"columns": [re.sub(r"#\d+L?$", "", c) for c in cols.split(",")], "pushed": pushed} for cols, pushed in scans
        ],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or HEADLINE
    spark = local_session(partitions=16)
    for name in names:
        df = QUERIES[name](spark, sf_dir)  # eager steps (counts, materialisations) run here
        print(name, summarise(df._jdf.queryExecution().executedPlan().toString()))


if __name__ == "__main__":
    main()
