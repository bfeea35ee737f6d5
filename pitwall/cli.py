"""Command-line entry point (S10), e.g. under spark-submit:

    spark-submit pitwall/cli.py ingest  --raw hdfs:///f1/raw --curated hdfs:///f1/transformed/f1_2025
    python -m pitwall run max_speed --base /data/f1 --out /data/f1/results   (same CLI)
    spark-submit pitwall/cli.py landing --raw hdfs:///f1/raw
    spark-submit pitwall/cli.py run lap_time --base hdfs:///f1 --format parquet --out hdfs:///f1/results \
        --param meeting_key=1268 --param team=Ferrari

Session sizing (S11) comes from spark-submit / --conf; shuffle partitions are
coalesced at run time by AQE.
"""

from __future__ import annotations

import argparse
import ast
import os
import sys

if __package__ in (None, ""):     # run as a script (spark-submit pitwall/cli.py): make the package importable.
    # Only the driver needs it; executors run no Python (there are no UDFs).
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitwall.plans.jobs import JOBS, run
from pitwall.session import session
from pitwall.sources.ingest import ingest, landed_files
from pitwall.sources.lake import Lake


def _param(s: str):
    k, _, v = s.partition("=")
    try:
        return k, ast.literal_eval(v)
    except (ValueError, SyntaxError):
        return k, v


def main(argv=None, stop: bool = True) -> int:
    p = argparse.ArgumentParser(prog="pitwall")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--raw", required=True)
    i.add_argument("--curated", required=True)
    i.add_argument("--partition-telemetry", action="store_true", help="partition telemetry tables by session_key")
    i.add_argument("--replace", choices=("table", "partitions"), default="table", help="partitions: only the sessions of the raw tables, where partitioned")
    i.add_argument("--on-loss", choices=("report", "fail", "ignore"), default="report", help="values without a form of their declared type")
    lnd = sub.add_parser("landing")
    lnd.add_argument("--raw", required=True)
    r = sub.add_parser("run")
    r.add_argument("job", choices=sorted(JOBS))
    r.add_argument("--base", required=True, help="lake base (curated zone below transformed/f1_2025)")
    r.add_argument("--zone", default="transformed/f1_2025")
    r.add_argument("--format", default="parquet")
    r.add_argument("--out", help="output base for path formats")
    r.add_argument("--option", action="append", default=[], help="writer option key=value (e.g. database=f1)")
    r.add_argument("--param", action="append", default=[], help="analysis parameter key=value")
    a = p.parse_args(argv)

    spark = session(app=f"pitwall-{a.cmd}")
    if a.cmd == "ingest":
        parts = None
        if a.partition_telemetry:
            from pitwall.sources.catalog import HEAVY
            parts = {stem: ["session_key"] for stem in HEAVY}
        lost: dict = {}
        written = ingest(spark, a.raw, a.curated, partition_by=parts, on_loss=a.on_loss, replace=a.replace, report=lost.__setitem__)
        for stem, cols in written.items():
            print(f"{stem}: {len(cols)} columns" + (f", lost values {lost[stem]}" if stem in lost else ""))
    elif a.cmd == "landing":
        print(f"{landed_files(spark, a.raw).count()} files landed")
    else:
        params = dict(_param(s) for s in a.param)
        opts = dict(_param(s) for s in a.option)
        tables = Lake(spark, a.base, a.zone).tables()
        for name, target in run(tables, a.job, fmt=a.format, base=a.out, options=opts, show=True, **params).items():
            print(f"{name} -> {target}")
    if stop:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
