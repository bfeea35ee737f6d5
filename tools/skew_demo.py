"""One key holding a third of all rows: plain window versus the split strategy.

usage: python tools/skew_demo.py [sf_dir] [car_data|laps]

Car telemetry of the driver data, with every third sample re-assigned to one
driver. A centred rolling average (+-8 samples) per (driver, session) runs with
each strategy; printed are the largest number of rows any single task handled
in the window stage and the wall time. Both results are compared for equality.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pitwall.operators.series import Series, rolling  # noqa: E402
from pitwall.session import session  # noqa: E402
from pitwall.sources.testdata import LazyTables  # noqa: E402
from tools.stage_times import summarize  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="pitwall-eventlog-")
    spark = session(master="local[8]", shuffle_partitions=16,
                    conf={"spark.sql.adaptive.coalescePartitions.enabled": "false",
                          "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    table = sys.argv[2] if len(sys.argv) > 2 else "car_data"
    src = LazyTables(spark, sf)[table]
    if table == "laps":      # time order = lap number; the original driver keeps the order total
        src = src.withColumns({"date": F.col("lap_number"), "speed": F.col("st_speed"), "rpm": F.col("driver_number")})
        third = F.col("lap_number") % 3 == 0
    else:
        third = F.unix_micros(F.col("date").cast("timestamp")) % 3 == 0
    skewed = src.withColumns({"driver_number": F.when(third, F.lit(0).cast("bigint")).otherwise(F.col("driver_number")),
                              "session_key": F.when(third, F.lit(0)).otherwise(F.col("session_key"))})
    n = skewed.count()
    hot = skewed.filter("driver_number = 0 AND session_key = 0").count()
    spark.sparkContext.setJobGroup("warm-up", "warm-up")
    Series(("driver_number", "session_key"), ("date", "speed", "rpm"), strategy="window").apply(
        skewed, smoothed=rolling("avg", "speed", 8, 8)).write.format("noop").mode("overwrite").save()
    print(f"rows={n} hot_key_rows={hot} ({hot / n:.0%})")
    results = {}
    for strategy in ("window", f"split:{max(hot // 32, 64)}"):
        spark.sparkContext.setJobGroup(strategy, strategy)
        t0 = time.perf_counter()
        out = Series(("driver_number", "session_key"), ("date", "speed", "rpm"), strategy=strategy).apply(
            skewed, smoothed=rolling("avg", "speed", 8, 8))
        # the window output is consumed, so the partition id is that of the window stage's task
        per_task = (out.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count("smoothed").alias("n"), F.sum("smoothed").alias("s"))
                    .agg(F.max("n")).first()[0])
        dt = time.perf_counter() - t0
        results[strategy] = out
        print(f"{strategy:12s} largest task: {per_task} rows   wall: {dt:.1f}s")
    a, b = results.values()
    spark.sparkContext.setJobGroup("compare", "compare")
    print("equal results:", a.exceptAll(b.select(a.columns)).count() == 0 and b.count() == a.count())
    spark.stop()
    for group, st in summarize(log_dir).items():
        if group and group not in ("compare", "warm-up"):
            print(f"{group:12s} longest task: {st['max_task_ms']} ms   task time: {st['task_ms']} ms   "
                  f"tasks: {st['tasks']}")


if __name__ == "__main__":
    main()
