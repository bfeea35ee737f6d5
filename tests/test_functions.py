import datetime as dt

from pyspark.sql import functions as F

from pitwall.functions.exprs import (
    arg_max, arg_min, bin_floor, drs_weight, epoch_seconds, guarded_pct, half_up, safe_corr, step_change,
)


def test_safe_corr_constant_is_null_not_error(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 5, 2.0), (1, 5, 3.0), (2, 1, 1.0), (2, 2, 2.0), (3, 7, 1.0)],
                               "g int, rpm int, speed double")
    got = {r.g: r.c for r in df.groupBy("g").agg(safe_corr("rpm", "speed").alias("c")).collect()}
    assert got[1] is None            # constant rpm: built-in corr raises under ANSI
    assert abs(got[2] - 1.0) < 1e-12
    assert got[3] is None            # one row


def test_safe_corr_matches_corr_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0), (None, 1.0), (4.0, 8.5)], "a double, b double")
    r = df.agg(safe_corr("a", "b").alias("s"), F.corr("a", "b").alias("c")).first()
    assert abs(r.s - r.c) < 1e-12


def test_arg_extrema_skip_nulls_and_break_ties(spark):
    # fixture: a null sector 3 on lap 1, two laps tied on st_speed (H3)
    df = spark.createDataFrame([(1, 300, None), (2, 310, 30.1), (3, 310, 29.9), (4, 305, 29.9)],
                               "lap int, st int, s3 double")
    r = df.agg(arg_max("st", "lap").alias("best_speed_lap"), arg_min("s3", "lap").alias("best_s3_lap")).first()
    assert r.best_speed_lap == 3     # tie on 310 -> larger lap
    assert r.best_s3_lap == 3        # null s3 on lap 1 ignored; tie on 29.9 -> smaller lap


def test_drs_weight_and_guarded_pct(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 8, 9, 10, 12, 14, None)], "drs int")
    got = [r.w for r in df.select(drs_weight("drs").alias("w")).collect()]
    assert got == [0.0, 0.0, 0.5, 0.0, 1.0, 1.0, 1.0, 0.0]
    r = spark.range(1).select(guarded_pct(F.lit(1), F.lit(3)).alias("p"), guarded_pct(F.lit(1), F.lit(0)).alias("z"))
    assert r.first().p == 33.3 and r.first().z == 0.0


def test_half_up_and_bins(spark):
    r = spark.range(1).select(half_up(F.lit(1.005), 2).alias("a"), half_up(F.lit(2.5), 0).alias("b"),
                              bin_floor(F.lit(-1), 100).alias("c"), bin_floor(F.lit(199), 100).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (1.01, 3.0, -100, 100)


def test_epoch_seconds_floors(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 900000),), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000),)],
                               "ts timestamp_ntz")
    got = [r.s for r in df.select(epoch_seconds("ts").alias("s")).collect()]
    assert got == [1704067207, -1]


def test_step_change_first_row_zero(spark):
    r = spark.range(1).select(step_change(F.lit(None).cast("int"), F.lit(5)).alias("a"),
                              step_change(F.lit(5), F.lit(3)).alias("b")).first()
    assert (r.a, r.b) == (0, 2)


def test_exact_corr_matches_corr_and_guards(spark):
    from pitwall.functions.exprs import exact_corr
    rows = [(1, r, s) for r, s in [(11000, 301), (10900, 0), (12000, 320), (None, 5), (9000, None), (9500, 250)]]
    rows += [(2, 7, v) for v in (1, 2, 3)] + [(3, 4, 9)]
    df = spark.createDataFrame(rows, "g int, rpm int, speed int")
    got = {r.g: (r.x, r.c) for r in df.groupBy("g").agg(exact_corr("rpm", "speed").alias("x"),
                                                       safe_corr("rpm", "speed").alias("c")).collect()}
    assert abs(got[1][0] - got[1][1]) < 1e-12
    assert got[2][0] is None and got[3][0] is None     # constant column; single pair


def test_exact_corr_is_order_free(spark):
    from pitwall.functions.exprs import exact_corr
    import random
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 12000), rnd.randint(0, 350)) for _ in range(2000)]
    a = spark.createDataFrame(rows, "x int, y int").agg(exact_corr("x", "y")).first()[0]
    b = spark.createDataFrame(list(reversed(rows)), "x int, y int").repartition(7).agg(exact_corr("x", "y")).first()[0]
    assert a == b


def test_packed_arg_extrema_equal_structs(spark):
    import random
    from pyspark.sql import functions as F
    from pitwall.functions.exprs import arg_max, arg_max_of, arg_min, arg_min_of
    rng = random.Random(1)
    big, small = (1 << 63) - 1, (1 << 31) - 1
    rows = [(rng.randrange(8), rng.choice([None, big, -big - 1, 0, -1, 1, 5, 5, 5]), rng.choice([None, small, -small - 1, 0, 1, -1, 7])) for _ in range(300)]
    rows += [(9, None, 1), (10, 3, None)]
    df = spark.createDataFrame(rows, "k int, v bigint, p int")
    out = df.groupBy("k").agg(arg_max_of(df, "v", "p").alias("a"), arg_min_of(df, "v", "p").alias("b"), arg_max("v", "p").alias("c"), arg_min("v", "p").alias("d"))
    assert all(r.a == r.c and r.b == r.d for r in out.collect()) and dict(out.dtypes)["a"] == "int"
    alone = df.groupBy("k").agg(arg_max_of(df, "v", "p"), arg_min_of(df, "v", "p"))
    assert "SortAggregate" not in alone._jdf.queryExecution().executedPlan().toString()
    wide = df.withColumn("p", F.col("p").cast("double"))                # no room or no whole number: the struct
    assert wide.groupBy("k").agg(arg_max_of(wide, "v", "p").alias("a")).count() == df.select("k").distinct().count()


def test_order_free_moments(spark):
    import math
    import random
    from pyspark.sql import functions as F
    from pitwall.functions.exprs import order_free_aggs, order_free_corr, safe_corr
    rng = random.Random(4)
    rows = [(k % 3, rng.choice([None, rng.uniform(200, 340)]), rng.choice([None, rng.uniform(1e4, 1.2e4)]), 5.0) for k in range(300)] + [(7, 1.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double")
    seen = None
    for parts in (1, 4, 9):
        own = df.repartition(parts)
        got = sorted(map(tuple, order_free_corr(own, ["k"], "a", "b").collect()))
        sums = sorted(map(tuple, order_free_aggs(own, ["k"], {"s": F.col("a")}, {"n": F.count("a")}).collect()))
        assert seen in (None, (got, sums))
        seen = got, sums
    want = {r[0]: r[1] for r in df.groupBy("k").agg(safe_corr("a", "b")).collect()}
    assert all((v is None and want[k] is None) or math.isclose(v, want[k], rel_tol=1e-8) for k, v, _ in seen[0]) and want[7] is None
    assert {r[1] for r in order_free_corr(df, ["k"], "a", "c").collect()} == {None}


def test_one_fixed_column_is_deduplicated_by_hashing(spark):
    from pitwall.operators.aggs import dedupe_ordered
    rows = [(1, 5, 2.5), (1, 5, None), (1, 6, 3.0), (1, 6, float("nan")), (2, 1, -1.0), (2, 1, -2.0), (None, 1, 7.0), (None, 1, 7.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    out = dedupe_ordered(df, ("a", "b"), ("v",))
    wide = dedupe_ordered(df.selectExpr("*", "cast(v as string) w"), ("a", "b"), ("v", "w")).drop("w")
    assert sorted(map(str, out.collect())) == sorted(map(str, wide.collect())) and out.count() == 4
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
