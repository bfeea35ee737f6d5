"""Property-based checks: the scalable forms equal the plain forms on random inputs."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitwall.operators.joins import containment_join
from pitwall.operators.series import Series, first, lag, last, lead, rolling, running, whole

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),      # key (null is a group too)
                             st.integers(0, 30),                            # time (ties allowed)
                             st.one_of(st.none(), st.integers(-20, 20))),   # value
                   min_size=1, max_size=120)


@SETTINGS
@given(rows=rows_st, a=st.integers(0, 6), b=st.integers(0, 6), n=st.integers(1, 4), chunk=st.integers(1, 9),
       route=st.sampled_from(["auto", "time", "range"]))
def test_split_equals_window(spark, rows, a, b, n, chunk, route):
    spark.conf.set("spark.pitwall.series.ordinal", route)
    try:
        _check_split(spark, rows, a, b, n, chunk)
    finally:
        spark.conf.unset("spark.pitwall.series.ordinal")


def _check_split(spark, rows, a, b, n, chunk):
    data = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]        # i makes the order total
    df = spark.createDataFrame(data, "k int, t int, i int, v int")
    specs = dict(r=rolling("sum", "v", a, b), c=rolling("count", "v", a, b), lg=lag("v", n), ld=lead("v", n),
                 f=first("v"), l=last("v"), w=whole("max", "v"), rs=running("sum", "v"), rm=running("min", "v"))
    plain = Series(("k",), ("t", "i"), strategy="window").apply(df, **specs)
    split = Series(("k",), ("t", "i"), strategy=f"split:{chunk}").apply(df, **specs).select(plain.columns)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


ranges_st = st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 40)), st.integers(-5, 25)),
                     min_size=0, max_size=12)


@SETTINGS
@given(laps=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 45)), min_size=1, max_size=60),
       ranges=ranges_st, width=st.integers(1, 12))
def test_containment_equals_residual_join(spark, laps, ranges, width):
    l = spark.createDataFrame([(d, x, i) for i, (d, x) in enumerate(laps)], "d int, x int, id int")
    r = spark.createDataFrame([(d, lo, None if lo is None else lo + span, j) for j, (d, lo, span) in enumerate(ranges)],
                              "d int, lo int, hi int, sid int")
    got = containment_join(l, r, ("d",), "x", "lo", "hi", right_cols={"sid": "sid"}, bucket_width=width)
    a, b = l.alias("a"), r.alias("b")
    exp = a.join(b, (F.col("a.d") == F.col("b.d")) & (F.col("a.x") >= F.col("b.lo")) & (F.col("a.x") <= F.col("b.hi")),
                 "left").select("a.id", "b.sid")
    assert sorted(got.select("id", "sid").collect(), key=repr) == sorted(exp.collect(), key=repr)


@SETTINGS
@given(left=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40)), min_size=1, max_size=25, unique=True),
       right=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(0, 999), st.integers(0, 5)),
                      min_size=0, max_size=40),
       strategy=st.sampled_from(["window", "split:3"]))
def test_nearest_equals_pairwise_rank(spark, left, right, strategy):
    import datetime as dt
    from pyspark.sql.window import Window
    from pitwall.operators.joins import nearest_join
    t0 = dt.datetime(2025, 1, 1)

    def ts(s, us=0):
        return t0 + dt.timedelta(seconds=s, microseconds=us)
    lo = spark.createDataFrame([(d, ts(s)) for d, s in left], "d int, date timestamp")
    ro = spark.createDataFrame([(d, ts(s, us * 1000), v) for d, s, us, v in right] or [(9, ts(0), 0)],
                               "d int, date timestamp, v int")
    got = nearest_join(lo, ro, ("d",), right_cols={"date": "cd", "v": "v"}, strategy=strategy)
    a, b = lo.alias("a"), ro.alias("b")
    pairs = a.join(b, F.col("a.d") == F.col("b.d"), "left").select(
        F.col("a.d"), F.col("a.date"), F.col("b.date").alias("cd"), F.col("b.v"),
        F.abs(F.unix_seconds("a.date") - F.unix_seconds("b.date")).alias("dist"))
    w = Window.partitionBy("d", "date").orderBy("dist", "cd", "v")
    exp = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("d", "date", "cd", "v")
    assert sorted(got.select("d", "date", "cd", "v").collect(), key=repr) == sorted(exp.collect(), key=repr)


@SETTINGS
@given(left=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=1, max_size=20),
       right=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 300)), min_size=0, max_size=60),
       tol=st.integers(1, 90))
def test_proximity_equals_residual_join(spark, left, right, tol):
    import datetime as dt
    from pitwall.operators.joins import proximity_join
    t0 = dt.datetime(2025, 1, 1)
    lo = spark.createDataFrame([(d, t0 + dt.timedelta(seconds=s), i % 7) for i, (d, s) in enumerate(left)],
                               "d int, date timestamp, tag int")            # tag repeats: duplicate left rows
    ro = spark.createDataFrame([(d, t0 + dt.timedelta(seconds=s), j) for j, (d, s) in enumerate(right)] or
                               [(9, t0, -1)], "d int, date timestamp, v int")
    got = proximity_join(lo, ro, ("d",), tol, right_cols={"v": "v"}).select("d", "date", "tag", "v")
    a, b = lo.alias("a"), ro.alias("b")
    exp = a.join(b, (F.col("a.d") == F.col("b.d"))
                 & (F.abs(F.unix_seconds("a.date") - F.unix_seconds("b.date")) < tol), "left").select(
        "a.d", "a.date", "a.tag", "b.v")
    assert sorted(got.collect(), key=repr) == sorted(exp.collect(), key=repr)
