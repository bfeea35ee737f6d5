"""The first rows of every group in a declared order (F6, O3, W13), and ranks of whole groups without a task per group."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.operators.series import Series, _join_back, profile, row_number, running
from pitwall.session import CHUNK_ROWS, HOT_KEY_ROWS, conf_int

#: How rows that are equal in the order count: each for itself, together with gaps after them, or together without.
TIES = {"rows": F.row_number, "rank": F.rank, "dense": F.dense_rank}
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_n(df: DataFrame, keys, order, n: int, name: str = "rank", ties: str = "rows", strategy: str = "auto") -> DataFrame:
    """Rows whose place in ``order`` within their group is at most ``n``, with the place as ``name``.

    ``limit``: one window, filtered in the same plan, so that Spark cuts every input partition to the first ``n`` rows of
    each group *before* the exchange (``WindowGroupLimit``, up to its threshold of ``n``); a hot group sends ``n`` rows a
    partition. ``chunks`` (``chunks:N`` for chunks of N rows): a first selection per group and chunk, a chunk being a
    hash of the whole row, then one among the chunks' survivors; no task sees more than a chunk or ``n`` rows a chunk.
    A row that is among the first ``n`` of its group is among the first ``n`` of any part of it, and all rows before it are
    too, so places are those of the whole group, with ties as well. ``auto`` takes ``limit`` where Spark's group limit
    applies, else it counts the largest group and takes ``chunks`` above the hot-key bound.

    Null keys are a group. With ``ties="rows"`` the order should be total; rows equal in it are picked arbitrarily.
    With ``rank`` or ``dense`` all rows of the last place are kept, however many.
    """
    if n < 1:
        raise ValueError("top_n keeps one row a group at least")
    keys, spark = list(keys), df.sparkSession
    place = TIES[ties]()
    chunk = conf_int(spark, CHUNK_ROWS)
    if strategy.startswith("chunks:"):
        strategy, chunk = "chunks", int(strategy.split(":", 1)[1])
    if strategy not in ("auto", "limit", "chunks"):
        raise ValueError(f"unknown top-n strategy {strategy!r}")
    if strategy == "auto" and n <= int(spark.conf.get(GROUP_LIMIT, "1000")):
        strategy = "limit"
    if strategy != "limit":
        prof = profile(df, keys)
        if strategy == "auto":
            strategy = "chunks" if prof.max_rows > conf_int(spark, HOT_KEY_ROWS) else "limit"
        chunks = max(1, math.ceil(prof.max_rows / chunk))
        if strategy == "chunks" and chunks > 1:
            whole = [c for c, t in df.dtypes if "map<" not in t]    # maps have no hash
            df = df.withColumn("_ck", F.pmod(F.xxhash64(*whole), F.lit(chunks)))
            df = df.withColumn(name, place.over(Window.partitionBy(*keys, "_ck").orderBy(*order))).filter(F.col(name) <= n).drop("_ck")
    return df.withColumn(name, place.over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)


def ranks(df: DataFrame, keys, order, dense: str | None = None, rank: str | None = None, strategy: str = "auto") -> DataFrame:
    """``dense_rank`` and/or ``rank`` of every row within its group, ascending with nulls first, as columns of these names.

    ``window`` is Spark's own window, one task per group. ``split`` ranks the *distinct values* of a group instead of its
    rows: they are pre-aggregated with their number of rows, a dense rank is a value's ordinal among them, a rank is one
    more than the rows of the values before it, and both come from the split route of ``Series`` (value ranges of
    bounded size, and prefix sums over the table of ranges), so no window holds a whole group. Values are then joined
    back by null-safe equality (null and NaN are values of their own). ``auto`` counts the largest group first.
    """
    keys, order = list(keys), list(order)
    s = Series(keys, order, strategy=strategy)
    if s.strategy == "auto":
        s = replace(s.checked(df), isolate=False)
    if s.strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({c: f.over(w) for c, f in ((dense, F.dense_rank()), (rank, F.rank())) if c})
    values = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_rows"))
    placed = replace(s, profile=None).checked(values)
    specs = {"_dense": row_number()} | ({"_upto": running("sum", "_rows")} if rank else {})
    out = placed.apply(values, **specs)
    named = [F.col("_dense").alias(dense)] if dense else []
    if rank:
        named.append((F.col("_upto") - F.col("_rows") + 1).cast("int").alias(rank))
    return _join_back(df, out.select(*keys, *order, *named), keys + order, placed.profile.rows)
