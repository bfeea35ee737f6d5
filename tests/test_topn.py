"""Top rows per group, ranks of whole groups."""
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.operators.topn import TIES, ranks, top_n


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 0, 0, 0, 0, 1, 2, 3]), rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, 1.5, 2.5, 7.0]), k) for k in range(500)]
    rows += [(0, 2.5, 7)] * 40                                         # repeated rows of the hot key
    return spark.createDataFrame(rows, "k int, v double, id int").repartition(7)


def plain(df, order, n, ties):
    w = Window.partitionBy("k").orderBy(*order)
    return df.withColumn("rank", TIES[ties]().over(w)).filter(F.col("rank") <= n)


@pytest.mark.parametrize("ties", ["rows", "rank", "dense"])
@pytest.mark.parametrize("strategy", ["auto", "limit", "chunks:8", "chunks:5000"])
def test_equals_a_window_over_whole_groups(frame, ties, strategy):
    order = (F.col("v").desc(), "id")
    for n in (1, 3, 60):
        got = top_n(frame, ["k"], order, n, ties=ties, strategy=strategy)
        assert got.columns == ["k", "v", "id", "rank"]
        assert sorted(map(str, got.collect())) == sorted(map(str, plain(frame, order, n, ties).collect()))


def test_ties_share_places(frame):
    got = top_n(frame, ["k"], ("v",), 2, ties="dense", strategy="chunks:8")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain(frame, ("v",), 2, "dense").collect()))


def test_partitions_are_cut_before_the_exchange(frame):
    text = top_n(frame, ["k"], ("v", "id"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.rindex("Partial") > text.index("hashpartitioning")    # below the exchange in the tree


def test_large_n_counts_groups_and_takes_chunks(spark, frame):
    spark.conf.set("spark.pitwall.series.hotKeyRows", "100")
    spark.conf.set("spark.pitwall.series.chunkRows", "50")
    try:
        out = top_n(frame, ["k"], ("v", "id"), 2000)
        assert "_ck" in out._jdf.queryExecution().analyzed().toString() and out.count() == frame.count()
    finally:
        spark.conf.unset("spark.pitwall.series.hotKeyRows")
        spark.conf.unset("spark.pitwall.series.chunkRows")


def test_bad_arguments(frame):
    with pytest.raises(ValueError):
        top_n(frame, ["k"], ("v",), 0)
    with pytest.raises(ValueError):
        top_n(frame, ["k"], ("v",), 1, strategy="none")
    assert top_n(frame.limit(0), ["k"], ("v",), 1, strategy="chunks:3").count() == 0


@pytest.mark.parametrize("strategy", ["window", "split:4", "split:64", "auto:50"])
def test_ranks_equal_spark(frame, strategy):
    w = Window.partitionBy("k").orderBy("v")
    want = frame.withColumns({"d": F.dense_rank().over(w), "r": F.rank().over(w)})
    got = ranks(frame, ("k",), ("v",), dense="d", rank="r", strategy=strategy)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and dict(got.dtypes)["d"] == "int"
    two = Window.partitionBy("k").orderBy("v", "id")
    want = frame.withColumn("d", F.dense_rank().over(two))
    assert sorted(map(str, ranks(frame, ("k",), ("v", "id"), dense="d", strategy=strategy).collect())) == sorted(map(str, want.collect()))


def test_no_window_holds_a_whole_group(spark):
    """The split plan's windows are over value ranges; only the table of ranges is windowed by key."""
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 5000).alias("v"))
    out = ranks(df, ("k",), ("v",), dense="d", strategy="split:100")
    windows = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    over = [w.split("], [")[-2:] for w in windows]
    assert over and all("_sb" in part or order.startswith("_sb") for part, order in over)
    assert out.groupBy().agg(F.max("d")).first()[0] == 2500
