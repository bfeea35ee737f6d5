"""Range and time joins: exact left-join semantics on hand fixtures, and against the residual join."""
import datetime as dt

from pyspark.sql import functions as F

from pitwall.operators.joins import containment_join, join_on_time_bucket, nearest_join, proximity_join

T0 = dt.datetime(2025, 9, 21, 12, 0, 0)


def ts(sec, micro=0):
    return T0 + dt.timedelta(seconds=sec, microseconds=micro)


def test_proximity_strict_bound_and_unmatched(spark):
    # FIXTURES: interval rows exactly 29, 30 and 31 s from a pit stop; a pit stop with none
    pit = spark.createDataFrame([(1, 16, ts(100), 20), (1, 16, ts(5000), 40)], "s int, d int, date timestamp, lap int")
    iv = spark.createDataFrame([(1, 16, ts(100 - 29), 1.0), (1, 16, ts(100 + 30), 2.0), (1, 16, ts(100 - 31), 3.0),
                                (1, 16, ts(100 + 29, 999999), 4.0), (1, 44, ts(100), 5.0)],
                               "s int, d int, date timestamp, gap double")
    out = proximity_join(pit, iv, ("s", "d"), 30, right_cols={"gap": "g"}).collect()
    got = sorted((r.lap, r.g) for r in out)
    assert got == [(20, 1.0), (20, 4.0), (40, None)]


def test_proximity_equals_residual_join(spark):
    import random
    rnd = random.Random(3)
    pit = spark.createDataFrame([(k % 2, k % 3, ts(rnd.randint(0, 3000)), k) for k in range(40)],
                                "s int, d int, date timestamp, id int")
    iv = spark.createDataFrame([(k % 2, k % 3, ts(rnd.randint(0, 3000)), float(k)) for k in range(400)],
                               "s int, d int, date timestamp, v double")
    got = proximity_join(pit, iv, ("s", "d"), 45, right_cols={"v": "v"}).select("id", "v")
    p, i = pit.alias("p"), iv.alias("i")
    exp = p.join(i, (F.col("p.s") == F.col("i.s")) & (F.col("p.d") == F.col("i.d"))
                 & (F.abs(F.unix_seconds("i.date") - F.unix_seconds("p.date")) < 45), "left").select("p.id", "i.v")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_containment_inclusive_and_null_stint(spark):
    # FIXTURES: laps on lap_start, on lap_end, and between stints
    laps = spark.createDataFrame([(1, 16, n) for n in (1, 5, 6, 9, 10, 11, 70)], "s int, d int, lap int")
    stints = spark.createDataFrame([(1, 16, 1, 1, 5, "SOFT"), (1, 16, 3, 10, 69, "HARD")],
                                   "s int, d int, stint int, lo int, hi int, compound string")
    out = containment_join(laps, stints, ("s", "d"), "lap", "lo", "hi", right_cols={"stint": "stint"},
                           bucket_width=4).collect()
    got = sorted((r.lap, r.stint) for r in out)
    assert got == [(1, 1), (5, 1), (6, None), (9, None), (10, 3), (11, 3), (70, None)]


def test_time_bucket_fan_out(spark):
    # FIXTURES: two location rows in one second, and a second with none
    car = spark.createDataFrame([(1, 16, ts(0, 100)), (1, 16, ts(1, 500))], "s int, d int, date timestamp")
    loc = spark.createDataFrame([(1, 16, ts(0, 200), 10), (1, 16, ts(0, 900), 20)], "s int, d int, date timestamp, x int")
    out = join_on_time_bucket(car, loc, ["s", "d"], right_cols={"x": "x"}).collect()
    assert sorted((r.date_sec - int(T0.replace(tzinfo=dt.timezone.utc).timestamp()), r.x) for r in out) == \
        [(0, 10), (0, 20), (1, None)]


def _nearest_fixture(spark):
    ov = spark.createDataFrame([(1, 16, ts(10)), (1, 16, ts(20)), (1, 16, ts(33)), (1, 44, ts(5)), (2, 16, ts(1))],
                               "s int, d int, date timestamp")
    # samples: two in the same second, one just before/after an overtake, ties at equal distance
    car = spark.createDataFrame([(1, 16, ts(9, 500000), 10, 100), (1, 16, ts(9, 100000), 0, 90),
                                 (1, 16, ts(11), 12, 110), (1, 16, ts(18), 1, 180), (1, 16, ts(22), 14, 220),
                                 (1, 16, ts(40), 8, 400), (2, 99, ts(1), 0, 1)],
                                "s int, d int, date timestamp, drs int, speed int")
    return ov, car


def test_nearest_ties_and_unmatched(spark):
    ov, car = _nearest_fixture(spark)
    for strategy in ("window", "split:2"):
        out = nearest_join(ov, car, ("d", "s"), right_cols={"speed": "speed", "drs": "drs"},
                           strategy=strategy, delta_col="dist").collect()
        got = sorted((r.s, r.d, (r.date - T0).seconds, r.speed, r.dist) for r in out)
        assert got == [(1, 16, 10, 90, 1),      # 9.1 and 9.5 s share second 9, 11 s too: earliest sample wins
                       (1, 16, 20, 180, 2),     # 18 and 22 are both 2 s away: earlier sample
                       (1, 16, 33, 400, 7),     # only forward... 22 is 11 s back, 40 is 7 s ahead
                       (1, 44, 5, None, None),  # no sample for that driver: kept with nulls
                       (2, 16, 1, None, None)]


def test_nearest_equals_pairwise_rank(spark):
    import random
    from pyspark.sql.window import Window
    rnd = random.Random(11)
    ov = spark.createDataFrame([(k % 3, ts(rnd.randint(0, 500), rnd.randint(0, 999999))) for k in range(60)],
                               "d int, date timestamp").dropDuplicates()
    car = spark.createDataFrame([(k % 4, ts(rnd.randint(0, 500), rnd.randint(0, 999999)), k) for k in range(300)],
                                "d int, date timestamp, v int")
    got = nearest_join(ov, car, ("d",), right_cols={"v": "v"}).select("d", "date", "v")
    o, c = ov.alias("o"), car.alias("c")
    pairs = o.join(c, F.col("o.d") == F.col("c.d"), "left").select(
        F.col("o.d"), F.col("o.date"), F.col("c.v"), F.col("c.date").alias("cd"),
        F.abs(F.unix_seconds("o.date") - F.unix_seconds("c.date")).alias("dist"))
    w = Window.partitionBy("d", "date").orderBy("dist", "cd", "v")
    exp = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("d", "date", "v")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_nearest_join_null_keys_take_nothing(spark):
    left = spark.createDataFrame([(None, 5, "a"), (1, 5, "b")], "k int, t int, tag string").selectExpr("k", "timestamp_seconds(t) AS date", "tag")
    right = spark.createDataFrame([(None, 5, 111), (1, 6, 222)], "k int, t int, v int").selectExpr("k", "timestamp_seconds(t) AS date", "v")
    got = {r.tag: r.v for r in nearest_join(left, right, ("k",), right_cols={"v": "v"}).collect()}
    assert got == {"a": None, "b": 222}


def test_nearest_join_of_a_large_key_is_linear(spark):
    """One key of 100,000 + 100,000 rows on both routes; a frame to the end of the key would take hours."""
    left = spark.range(100_000).selectExpr("1 AS k", "timestamp_seconds(id * 7) AS date", "id")
    right = spark.range(100_000).selectExpr("1 AS k", "timestamp_seconds(id * 7 + 3) AS date", "id AS v")
    for strategy in ("window", "split:20000"):
        r = nearest_join(left, right, ("k",), right_cols={"v": "v"}, strategy=strategy).selectExpr("sum(abs(v - id)) AS off", "count(*) AS n").first()
        assert (r.off, r.n) == (0, 100_000)


def test_containment_join_of_open_ranges(spark):
    left = spark.range(200).selectExpr("int(id % 2) AS k", "id AS x")
    right = spark.createDataFrame([(0, 0, 2_000_000_000, "open"), (0, 10, 11, "short"), (0, 30, 150, "long"), (1, 90, 80, "none")],
                                  "k int, lo long, hi long, name string")
    got = sorted(containment_join(left, right, ("k",), "x", "lo", "hi", right_cols={"name": "name"}).collect(), key=str)
    want = left.join(right.withColumnRenamed("k", "k2"), (left.k == F.col("k2")) & (left.x >= F.col("lo")) & (left.x <= F.col("hi")), "left") \
        .select("k", "x", "name").collect()
    assert got == sorted(want, key=str)
