"""Series operators: both strategies against a brute-force pandas model."""
import random

import pandas as pd
import pytest

from pitwall.operators.series import (
    Series, fill, first, lag, last, lead, resolve, rolling, row_number, running, whole,
)


def _fixture(spark, n_keys=3, seed=7, hot=200):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        size = hot if k == 0 else rnd.randint(1, 12)     # one hot key, small others, a one-row key
        for i in range(size):
            v = None if rnd.random() < 0.2 else rnd.randint(-50, 50)
            rows.append((k if k != 2 else None, i * 3 + rnd.randint(0, 2), i, v))
    return spark.createDataFrame(rows, "k int, t int, tie int, v int")


SPECS = dict(r=rolling("avg", "v", 3, 2), c=rolling("count", "v", 5), mx=rolling("max", "v", 15, 15),
             lg=lag("v", 5), ld=lead("v", 1), f=first("v"), l=last("v"), w=whole("min", "v"),
             rs=running("sum", "v"), rc=running("count", "v"), rm=running("min", "v"),
             ff=fill("v", True), fb=fill("v", False), rn=row_number())


def _model(pdf):
    out = []
    for _, g in pdf.sort_values(["t", "tie"]).groupby(pdf["k"].fillna(-999), sort=False):
        g = g.sort_values(["t", "tie"]).reset_index(drop=True)
        v = g["v"]
        n = len(g)
        for i in range(n):
            def frame(a, b):
                return v.iloc[max(0, i - a): min(n, i + b + 1)].dropna()
            row = dict(g.iloc[i])
            f = frame(3, 2)
            row["r"] = f.mean() if len(f) else None
            row["c"] = len(frame(5, 0))
            f = frame(15, 15)
            row["mx"] = f.max() if len(f) else None
            row["lg"] = v.iloc[i - 5] if i >= 5 else None
            row["ld"] = v.iloc[i + 1] if i + 1 < n else None
            row["f"], row["l"] = v.iloc[0], v.iloc[n - 1]
            row["w"] = v.dropna().min() if v.notna().any() else None
            pre = v.iloc[: i + 1].dropna()
            row["rs"] = pre.sum() if len(pre) else None
            row["rc"] = len(pre)
            row["rm"] = pre.min() if len(pre) else None
            row["ff"] = pre.iloc[-1] if len(pre) else None
            post = v.iloc[i:].dropna()
            row["fb"] = post.iloc[0] if len(post) else None
            row["rn"] = i + 1
            out.append(row)
    return out


def _norm(rows):
    def n(x):
        if x is None or (isinstance(x, float) and pd.isna(x)):
            return None
        return round(float(x), 9)
    return sorted((tuple(n(r[c]) for c in ["k", "t", "tie", "v", *SPECS]) for r in rows),
                  key=lambda t: tuple((x is None, x or 0) for x in t))


@pytest.mark.parametrize("strategy", ["window", "split:7", "split:64", "split:1000"])
def test_series_matches_model(spark, strategy):
    df = _fixture(spark)
    got = Series(("k",), ("t", "tie"), strategy=strategy).apply(df, **SPECS).toPandas()
    exp = _model(df.toPandas())
    assert _norm(got.to_dict("records")) == _norm(exp)


def test_resolve_profiles_several_key_sets_once(spark):
    df = _fixture(spark)
    a, b = resolve(df, Series(("k",), ("t",)), Series(("k", "tie"), ("t",)))
    assert a.profile.max_rows == 200 and a.profile.rows == df.count()
    assert b.profile.max_rows == 1
    assert a.strategy == "window"          # 200 rows is far below the hot-key bound


def test_auto_switches_to_split_for_hot_keys(spark):
    spark.conf.set("spark.pitwall.series.hotKeyRows", "100")
    try:
        s = Series(("k",), ("t", "tie")).checked(_fixture(spark))
        assert s.strategy == "split"
    finally:
        spark.conf.unset("spark.pitwall.series.hotKeyRows")


def test_split_plan_spreads_hot_key(spark):
    df = _fixture(spark)
    out = Series(("k",), ("t", "tie"), strategy="split:16").apply(df, r=rolling("avg", "v", 3))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_cc" in plan      # window partition includes the chunk column, not the key alone


def test_position_sequence_gained_lost(spark):
    # FIXTURES: position 5, 3, 3, 6 -> gained 2, lost -3
    from pitwall.operators.aggs import negative_sum, positive_sum
    from pitwall.functions.exprs import step_change
    df = spark.createDataFrame([(44, 1, i, p) for i, p in enumerate([5, 3, 3, 6])], "d int, s int, t int, position int")
    for strategy in ("window", "split:2"):
        p = Series(("d", "s"), ("t",), strategy=strategy).apply(df, prev=lag("position", 1))
        p = p.withColumn("pc", step_change("prev", "position"))
        r = p.groupBy("d").agg(positive_sum("pc").alias("g"), negative_sum("pc").alias("l")).first()
        assert (r.g, r.l) == (2, -3)


def test_auto_isolates_hot_keys_and_matches_model(spark):
    spark.conf.set("spark.pitwall.series.hotKeyRows", "100")
    spark.conf.set("spark.pitwall.series.chunkRows", "16")
    try:
        df = _fixture(spark)
        s = Series(("k",), ("t", "tie")).checked(df)
        assert s.strategy == "split" and s.isolate and s.profile.hot_groups == 1 and s.profile.hot_rows == 200
        out = s.apply(df, **SPECS)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_cc" in plan and "Union" in plan          # hot key chunked, the rest windowed
        assert _norm(out.toPandas().to_dict("records")) == _norm(_model(df.toPandas()))
    finally:
        spark.conf.unset("spark.pitwall.series.hotKeyRows")
        spark.conf.unset("spark.pitwall.series.chunkRows")


def test_split_spreads_a_key_with_a_third_of_the_rows(spark):
    from pyspark.sql import functions as F
    # key 0 holds a third of all rows; with 50-row chunks its rows are windowed in many tasks
    rows = [(0 if i % 3 == 0 else 1 + i % 40, i, i % 17) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    key = "spark.sql.adaptive.coalescePartitions.enabled"     # tiny test data: keep AQE from merging tasks
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = Series(("k",), ("t",), strategy="split:50").apply(df, r=rolling("avg", "v", 5, 5))
        parts = (out.filter("k = 0").groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("r").alias("count")).collect())
    finally:
        spark.conf.set(key, before)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 1000
    ref = Series(("k",), ("t",), strategy="window").apply(df, r=rolling("avg", "v", 5, 5))
    assert out.exceptAll(ref.select(out.columns)).count() == 0


def test_special_order_values_on_every_route(spark):
    """NaN, infinities and nulls in the ordering column: the ordinal of the plain window on all routes."""
    import random

    from pitwall.session import ORDINAL
    rng = random.Random(4)
    rows = [(k % 2, rng.choice([float("nan"), float("inf"), float("-inf"), None, rng.random() * 100, rng.random() * 100, rng.random() * 100]), k)
            for k in range(300)]
    df = spark.createDataFrame(rows, "k int, o double, id int")
    want = None
    try:
        for strategy, route in (("window", "auto"), ("split:16", "auto"), ("split:16", "time"), ("split:16", "range")):
            spark.conf.set(ORDINAL, route)
            got = {r.id: r.n for r in Series(("k",), ("o", "id"), strategy=strategy).apply(df, n=row_number()).collect()}
            want = want or got
            assert got == want, (strategy, route)
    finally:
        spark.conf.unset(ORDINAL)


def test_reserved_column_names_are_refused(spark):
    with pytest.raises(ValueError):
        Series(("k",), ("o",), strategy="window").apply(spark.createDataFrame([(1, 1, 1)], "k int, o int, _rn int"), n=row_number())


def test_sums_of_doubles_agree_bit_for_bit_on_every_route(spark):
    import math
    from fractions import Fraction
    rng = random.Random(11)
    rows = [(k % 2, k, rng.choice([None, 1, -1, 1]) and rng.uniform(-1, 1) * 10.0 ** rng.randrange(-12, 15)) for k in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    seen = {}
    for strategy, parts in (("window", 1), ("window", 9), ("split:16", 3), ("split:50", 7), ("auto:10", 5)):
        got = Series(("k",), ("t",), strategy=strategy).apply(
            df.repartition(parts), s=running("sum", "v"), w=whole("sum", "v"), m=whole("avg", "v")).collect()
        got = sorted((r.k, r.t, r.s, r.w, r.m) for r in got)
        assert seen.setdefault("want", got) == got, strategy
    for key in (0, 1):
        own = [v for k, _, v in rows if k == key and v is not None]
        exact = float(sum(map(Fraction, own)))
        w = next(r[3] for r in seen["want"] if r[0] == key)
        assert math.isclose(w, exact, rel_tol=1e-12)


def test_odd_doubles_in_sums(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, None), (1, 2, None), (2, 1, inf), (2, 2, 1.0), (3, 1, nan), (3, 2, 1.0), (4, 1, 1e300), (4, 2, 1.0), (5, 1, 1e-300), (5, 2, 2.0), (6, 1, -0.75)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    for strategy in ("window", "split:2"):
        got = {r.k: (r.w, r.m) for r in Series(("k",), ("t",), strategy=strategy).apply(df, w=whole("sum", "v"), m=whole("avg", "v")).collect()}
        assert got[1] == (None, None) and got[2] == (inf, inf) and got[3][0] != got[3][0]
        assert got[4] == (1e300, 5e299) and got[5] == (2.0, 1.0) and got[6] == (-0.75, -0.75)


def test_a_spec_over_another_spec_through_an_expression(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, t, float(t), 100.0) for t in range(4)], "k int, t int, v double, r double")
    for strategy in ("window", "split:2"):
        got = Series(("k",), ("t",), strategy=strategy).apply(df, r=rolling("avg", "v", 1), l=last(F.col("r") + 1)).collect()
        assert {row.l for row in got} == {3.5}
