"""Ingest round trip: messy headers, missing droppable columns, bad values, reruns overwrite."""
import os

import pytest
from pyspark.sql import functions as F

from pitwall.sources.ingest import ingest, landed_files, normalize_names
from pitwall.sources.lake import Lake
from pitwall.sources.sinks import write_collection


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_normalize_collision_fails(spark):
    df = spark.createDataFrame([(1, 2)], ["Gap To-Leader", "gap_to.leader"])
    with pytest.raises(ValueError):
        normalize_names(df)


def test_ingest_round_trip(spark, tmp_dir):
    raw, cur = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "transformed", "f1_2025")
    os.makedirs(raw)
    # messy headers; 'n_gear' missing (droppable column absent); 'Brake' upper case
    _write(f"{raw}/car_data_race_only_2025.csv",
           "Session Key,driver-number,Date,Speed,RPM,throttle,DRS,Brake\n"
           "9158,16,2025-07-27T13:03:10.100Z,301,11000,99,12,0\n9158,16,2025-07-27T13:03:10.400Z,0,10900,0,8,100\n")
    # lapped marker and null in gap_to_leader
    _write(f"{raw}/intervals_race_only_2025.csv",
           "session_key,driver_number,date,gap_to_leader\n9158,16,2025-07-27T13:03:10Z,0.0\n"
           "9158,44,2025-07-27T13:03:11Z,+1 LAP\n9158,1,2025-07-27T13:03:12Z,\n")
    written = ingest(spark, raw, cur, stems=("car_data_race_only_2025", "intervals_race_only_2025"))
    assert written["car_data_race_only_2025"] == ["session_key", "driver_number", "date", "speed", "rpm",
                                                  "throttle", "drs"]
    lake = Lake(spark, tmp_dir)
    car = lake.table("car_data")
    assert dict(car.dtypes)["date"] == "timestamp" and dict(car.dtypes)["speed"] == "int"
    gaps = sorted((r.driver_number, r.gap_to_leader, r.gap_to_leader_marker) for r in lake.table("intervals").collect())
    assert gaps == [(1, None, None), (16, 0.0, None), (44, None, "+1 LAP")]
    # rerun replaces the table
    ingest(spark, raw, cur, stems=("car_data_race_only_2025",))
    assert lake.table("car_data").count() == 2
    assert landed_files(spark, raw).count() == 2
    with pytest.raises(FileNotFoundError):
        landed_files(spark, os.path.join(tmp_dir, "transformed"))


def test_write_collection_overwrites(spark, tmp_dir):
    df = spark.range(3)
    write_collection(df, "f1_test", fmt="json", base=tmp_dir)
    write_collection(spark.range(2), "f1_test", fmt="json", base=tmp_dir)
    assert spark.read.json(os.path.join(tmp_dir, "f1_test")).count() == 2


def test_stream_ingest_is_incremental(spark, tmp_dir):
    from pitwall.streaming.landing import stream_ingest
    raw, cur = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "cur")
    os.makedirs(raw)
    cols = ["session_key", "driver_number", "date", "position"]
    _write(f"{raw}/position_race_only_2025_a.csv", "session_key,driver_number,date,position\n1,16,2025-01-01T00:00:00Z,5\n")
    ck = os.path.join(tmp_dir, "ck")
    stream_ingest(spark, raw, cur, "position_race_only_2025", cols, checkpoint=ck)
    _write(f"{raw}/position_race_only_2025_b.csv", "session_key,driver_number,date,position\n1,16,2025-01-01T00:00:05Z,3\n")
    stream_ingest(spark, raw, cur, "position_race_only_2025", cols, checkpoint=ck)
    got = spark.read.parquet(f"{cur}/position_race_only_2025.stream.parquet")
    assert sorted(r.position for r in got.collect()) == [3, 5]


def test_stream_goes_on_in_a_new_application(spark, tmp_dir, monkeypatch):
    """The default checkpoint follows spark.checkpoint.dir itself, whatever folder the application's context has."""
    from pitwall.streaming import landing
    from pitwall.streaming.landing import stream_ingest
    monkeypatch.setattr(landing, "configured", lambda spark: os.path.join(tmp_dir, "shared"))
    raw, cur = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "transformed", "f1_2025")
    os.makedirs(raw)
    cols = ["session_key", "driver_number", "date", "position"]
    head = "session_key,driver_number,date,position\n"
    _write(f"{raw}/position_race_only_2025_a.csv", head + "1,16,2025-01-01T00:00:00Z,5\n")
    stream_ingest(spark, raw, cur, "position_race_only_2025", cols)
    _write(f"{raw}/position_race_only_2025_b.csv", head + "1,16,2025-01-01T00:00:05Z,3\n")
    stream_ingest(spark.newSession(), raw, cur, "position_race_only_2025", cols)
    assert sorted(r.position for r in Lake(spark, tmp_dir).table("position").collect()) == [3, 5]
    # a batch table beside it keeps its rows
    batch = os.path.join(tmp_dir, "batch")
    os.makedirs(batch)
    _write(f"{batch}/position_race_only_2025.csv", head + "2,16,2025-01-01T00:00:00Z,9\n2,16,2025-01-01T00:00:01Z,8\n")
    ingest(spark, batch, cur, stems=("position_race_only_2025",))
    assert sorted(r.position for r in Lake(spark, tmp_dir).table("position").collect()) == [3, 5, 8, 9]


def test_stream_refuses_another_column_order(spark, tmp_dir):
    from pyspark.errors import StreamingQueryException

    from pitwall.streaming.landing import stream_ingest
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _write(f"{raw}/position_race_only_2025_a.csv", "driver_number,session_key,date,position\n16,1,2025-01-01T00:00:00Z,5\n")
    with pytest.raises(StreamingQueryException):
        stream_ingest(spark, raw, os.path.join(tmp_dir, "cur"), "position_race_only_2025",
                      ["session_key", "driver_number", "date", "position"], checkpoint=os.path.join(tmp_dir, "ck"))


def test_whole_numbers_written_with_a_fraction(spark):
    from pitwall.sources.ingest import apply_types, losses
    df = spark.createDataFrame([("310.0", "1"), ("310", "x"), ("310.5", ""), (None, None), (" 7 ", "2.50")], "n string, d string")
    types = {"n": "int", "d": "double"}
    assert [tuple(r) for r in apply_types(df, types).collect()] == [(310, 1.0), (310, None), (None, None), (None, None), (7, 2.5)]
    assert {r.column: r.lost for r in losses(df, types).collect()} == {"n": 1, "d": 1}


def test_partitioned_telemetry_prunes_by_session(spark, tmp_dir):
    raw, cur = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "transformed", "f1_2025")
    os.makedirs(raw)
    _write(f"{raw}/position_race_only_2025.csv", "session_key,driver_number,date,position\n"
           "1,16,2025-01-01T00:00:00Z,5\n2,16,2025-01-02T00:00:00Z,3\n3,44,2025-01-03T00:00:00Z,1\n")
    ingest(spark, raw, cur, stems=("position_race_only_2025",),
           partition_by={"position_race_only_2025": ["session_key"]})
    from pitwall.operators.scope import scope_to_session
    sessions = spark.createDataFrame([(2, 1266)], "session_key int, meeting_key int")
    df = scope_to_session(Lake(spark, tmp_dir).table("position"), sessions)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_key" in plan and "session_key#" in plan
    assert [r.position for r in df.collect()] == [3]
    assert len(os.listdir(f"{cur}/position_race_only_2025.parquet")) >= 3      # one directory per session


def _raw(tmp_dir, stem, lines):
    import os
    os.makedirs(f"{tmp_dir}/raw", exist_ok=True)
    with open(f"{tmp_dir}/raw/{stem}.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_lost_values_are_reported_or_refused(spark, tmp_dir):
    from pitwall.sources.ingest import LostValues, ingest
    stem = "pit_race_only_2025"
    _raw(tmp_dir, stem, ["Date,Driver Number,Lap Number,Pit Duration,Meeting Key,Session Key",
                         "2025-01-01T00:00:00,16,3,2.5,1,2", "2025-01-01T00:00:10,x16,,abc,1,2", "2025-01-01T00:00:20,44.0,5,,1,2"])
    got = {}
    with pytest.warns(UserWarning, match="became null"):
        ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cur", [stem], report=got.__setitem__)
    assert got[stem]["driver_number"] == 1 and "lap_number" not in got[stem]
    with pytest.raises(LostValues) as e:
        ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/no", [stem], on_loss="fail")
    assert e.value.lost == got[stem] and not os.path.exists(f"{tmp_dir}/no")
    ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/quiet", [stem], on_loss="ignore")
    assert spark.read.parquet(f"{tmp_dir}/quiet/{stem}.parquet").count() == 3


def test_types_are_inferred_from_all_values(spark, tmp_dir):
    from pitwall.sources.infer import inferred, inferred_types
    rows = [("1", "2.50", "1e3", "2024-01-01", "2024-01-01T10:00:00", "true", "", "x", "12345678901", "+1 LAP", "1" * 30, "-0.001"),
            (" -7", ".5", "2", "2024-02-30", "2024-01-01 10:00", "FALSE", None, "1", "3", "4", "0", "12")]
    df = spark.createDataFrame(rows, [f"c{k}" for k in range(12)])
    got = {r["column"]: (r["type"], r["nearest"], r["lost"]) for r in inferred(df).collect()}
    assert got == {"c0": ("int", "int", 0), "c1": ("decimal(2,1)", "number", 0), "c2": ("double", "double", 0), "c3": ("string", "date", 1),
                   "c4": ("timestamp", "timestamp", 0), "c5": ("boolean", "boolean", 0), "c6": ("string", None, 0), "c7": ("string", "int", 1),
                   "c8": ("bigint", "bigint", 0), "c9": ("string", "int", 1), "c10": ("decimal(30,0)", "number", 0), "c11": ("decimal(5,3)", "number", 0)}
    assert inferred_types(df)["c1"] == "double" and inferred_types(df, None)["c11"] == "decimal(5,3)" and "c3" not in inferred_types(df)
    assert inferred(df.limit(0)).select("type").distinct().collect()[0][0] == "string"


def test_one_session_replaced_leaves_the_others(spark, tmp_dir):
    import os
    from pyspark.sql import functions as F
    from pitwall.sources.ingest import write_parquet
    path = f"{tmp_dir}/laps.parquet"
    write_parquet(spark.range(300).select((F.col("id") % 3).alias("session_key"), "id"), path, ["session_key"], replace="partitions")
    files = lambda: {f"{d}/{f}": (os.path.getsize(f"{d}/{f}"), os.path.getmtime(f"{d}/{f}")) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    write_parquet(spark.range(10).select(F.lit(1).alias("session_key"), (F.col("id") + 1000).alias("id")), path, ["session_key"], replace="partitions")
    after = files()
    assert {k: v for k, v in before.items() if "session_key=1/" not in k} == {k: v for k, v in after.items() if "session_key=1/" not in k}
    got = {r[0]: (r[1], r[2]) for r in spark.read.parquet(path).groupBy("session_key").agg(F.count("id"), F.min("id")).collect()}
    assert got == {0: (100, 0), 1: (10, 1000), 2: (100, 2)}
    with pytest.raises(ValueError):
        write_parquet(spark.range(1), f"{tmp_dir}/x", replace="partitions")


def test_printed_previews(spark, monkeypatch):
    from pitwall.plans import jobs
    shown = []
    monkeypatch.setattr(jobs, "preview", lambda df: shown.append(df.columns))
    monkeypatch.setattr(jobs, "outputs", lambda tables, job, **kw: {"c": spark.range(2).select(
        F.lit("n").alias("full_name"), F.lit(0.123456).alias("drs_speed_correlation"), F.lit(1.0).alias("avg_speed"), F.lit(1.0).alias("avg_speed_when_drs_on"),
        F.lit(1.0).alias("avg_speed_when_drs_off"), F.lit(1).alias("drs_activations"), F.lit(1).alias("total_samples"))})
    for job in ("sector_loss", "drs_correlation", "lap_time"):
        jobs.run({}, job, fmt="noop", show=True)
    assert len(shown) == 2 and "correlation" in shown[1]


def test_scope_prunes_partitions_at_run_time(spark, tmp_dir):
    """No key comes to the driver: the sessions side prunes the partitioned fact while the query runs; same rows."""
    from pitwall.operators.scope import race_sessions, scope_to_session
    from pitwall.session import SCOPE
    spark.range(2000).select((F.col("id") % 20).cast("int").alias("session_key"), "id").write.partitionBy("session_key").parquet(f"{tmp_dir}/fact")
    spark.range(20).select(F.col("id").cast("int").alias("session_key"), (F.col("id") % 4 + 1260).alias("meeting_key"),
                           F.lit("Race").alias("session_name")).write.parquet(f"{tmp_dir}/sessions")
    fact, sessions = spark.read.parquet(f"{tmp_dir}/fact"), race_sessions(spark.read.parquet(f"{tmp_dir}/sessions"), 1262)
    want = sorted(r.id for r in scope_to_session(fact, sessions).collect())
    spark.conf.set(SCOPE, "runtime")
    try:
        out = scope_to_session(fact, sessions)
        assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in out.collect()) == want and len(want) == 500
        spark.conf.set(SCOPE, "other")
        with pytest.raises(ValueError):
            scope_to_session(fact, sessions)
    finally:
        spark.conf.unset(SCOPE)


def test_analyses_agree_on_both_scopes(spark):
    from pitwall.plans import catalog
    from pitwall.session import SCOPE
    sf = "/root/testdata/sf0.001"
    for name in ("lap_time", "pit_intervals"):
        want = sorted(map(str, catalog.QUERIES[name](spark, sf).collect()))
        spark.conf.set(SCOPE, "runtime")
        try:
            assert sorted(map(str, catalog.QUERIES[name](spark, sf).collect())) == want
        finally:
            spark.conf.unset(SCOPE)


def test_bucketed_tables_need_no_exchange(spark, tmp_dir):
    from pitwall.operators.series import Series, rolling
    from pitwall.sources.lake import write_bucketed
    rows = spark.range(3000).select((F.col("id") % 3).alias("session_key"), (F.col("id") % 11).alias("driver_number"), F.col("id").alias("date"), (F.col("id") % 7).alias("v"))
    a = write_bucketed(rows, "bucketed_a", f"{tmp_dir}/a", buckets=4)
    b = write_bucketed(rows.withColumnRenamed("v", "w"), "bucketed_b", f"{tmp_dir}/b", buckets=4)
    try:
        keys = ("driver_number", "session_key")
        out = Series(keys, ("date",), strategy="window").apply(a, r=rolling("avg", "v", 3))
        joined = a.join(b, [*keys, "date"])
        before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        try:
            for df in (out, joined):
                assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)
        want = Series(keys, ("date",), strategy="window").apply(rows, r=rolling("avg", "v", 3))
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and joined.count() == 3000
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_a")
        spark.sql("DROP TABLE IF EXISTS bucketed_b")
