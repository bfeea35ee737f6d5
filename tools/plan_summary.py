"""Summarise the physical plan of each race analysis (markdown table).

usage: python tools/plan_summary.py [sf_dir]

Counts shuffle exchanges (hash / range), broadcasts, window and sort-aggregate
nodes in the executed plan, and checks that the session scope reached the
Parquet scans as a pushed filter.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitwall.plans import catalog  # noqa: E402
from pitwall.session import session  # noqa: E402

ANALYSES = ["lap_time", "max_speed", "pit_intervals", "rpm_zones", "drs_overtakes", "gap_timeline", "gap_summary",
            "overtake_totals", "position_change", "sector_loss", "drs_correlation", "stint_length"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    print("| analysis | hash exchanges | range exchanges | broadcasts | Window nodes | scans with scope pushed |")
    print("|---|---|---|---|---|---|")
    for name in ANALYSES:
        df = catalog.QUERIES[name](spark, sf)
        text = df._jdf.queryExecution().explainString(mode)
        tree = text.split("\n\n")[0]
        nodes = re.findall(r"(Exchange|BroadcastExchange|Window|Scan parquet)", tree)
        hashx = len(re.findall(r"Arguments: hashpartitioning\(", text))
        rangex = len(re.findall(r"Arguments: rangepartitioning\(", text))
        scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?PushedFilters: \[([^\]]*)\]", text)
        scoped = sum(1 for s in scans if "session_key" in s or "meeting_key" in s)
        print(f"| {name} | {hashx} | {rangex} | {nodes.count('BroadcastExchange')} | {nodes.count('Window')} | "
              f"{scoped}/{len(scans)} |")


if __name__ == "__main__":
    main()
