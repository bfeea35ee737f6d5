"""Outer equi-joins that no hot key can overload.

AQE splits a skewed partition of a left outer join on its left side only. Here the keys that are hot on *either* side are
found by counting both, and only they are dealt over a grid: the left rows of a hot key are cut into as many parts as
their number needs, the right ones likewise, and part i of the left meets part j of the right in cell (i, j). Every
pair meets once, rows of all other keys are neither copied nor moved differently, and it stays one join.

A row is copied to all parts of the other side, so cells of a fixed number of rows would move left times right rows.
Instead the hot keys of a join share a fixed number of cells by their work: copies grow with the rows, not with their
product, and only a key too large for one task's memory gets more.

The pairs themselves grow with left times right. With ``order`` the pairs of a cell come block by block: ``BLOCK`` rows of
the smaller side, in order, meet one row of the larger side after the other. A run then holds one row of the larger side,
and the block repeats in the same sequence from run to run, near enough for a columnar file's codec, however many rows a
cell has: a written pair takes a fraction of a byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.series import _bounded
from pitwall.session import HOT_KEY_ROWS, conf_int, ensure_checkpoint_dir

#: Cells that the hot keys of one join share, for every shuffle partition.
CELLS = 4

#: Rows of a cell's smaller side that meet the whole other side before the next ones do (``order``).
BLOCK = 256

#: Pairs in cells for every shuffle partition from which their tasks are not joined: small in bytes, but long.
TASK_PAIRS = 1_000_000


def _sum_of_counts(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """(on, _ln, _rn): rows of every key on both sides, by one partial aggregate over their union."""
    zero = F.lit(0).cast("bigint")
    sides = left.select(*on, F.lit(1).cast("bigint").alias("_l"), zero.alias("_r")).unionByName(
        right.select(*on, zero.alias("_l"), F.lit(1).cast("bigint").alias("_r")))
    return sides.groupBy(*on).agg(F.sum("_l").alias("_ln"), F.sum("_r").alias("_rn"))


def hot_join_keys(left: DataFrame, right: DataFrame, on, bound: int) -> tuple[DataFrame, int]:
    """Keys with more than ``bound`` rows on a side, with both counts, and their number (at most rows / bound).

    Counted once and kept in the checkpoint folder: both sides of the join read it.
    """
    ensure_checkpoint_dir(left.sparkSession)
    hot = _sum_of_counts(left, right, on).filter(F.greatest("_ln", "_rn") > bound).checkpoint(eager=True)
    return hot, hot.count()


def _with_parts(hot: DataFrame, bound: int) -> DataFrame:
    """Counts of hot keys with ``_lp`` and ``_rp``, the parts that their left and right rows are cut into.

    ``CELLS`` cells a shuffle partition go to the keys by their share of all pairs or, if larger, of all rows. A key's
    cells have about as many left as right rows, which makes the fewest copies. No part is cut below ``bound`` rows or
    holds much more than the session's hot-key bound (a task keeps the right part of a cell).
    """
    spark = hot.sparkSession
    most = max(bound, conf_int(spark, HOT_KEY_ROWS))
    cells = CELLS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ln, rn = F.col("_ln").cast("double"), F.col("_rn").cast("double")
    pairs, rows = hot.agg(F.sum(ln * rn), F.sum(ln + rn)).first()
    own = F.ceil(F.lit(float(cells)) * F.greatest(ln * rn / F.lit(pairs or 1.0), (ln + rn) / F.lit(rows)))
    parts = lambda n, wanted: F.least(F.ceil(n / bound), F.greatest(wanted, F.ceil(n / most)))
    wanted = F.least(own, F.ceil(F.sqrt(own * ln / F.greatest(rn, F.lit(1.0)))))
    hot = hot.withColumn("_lp", F.greatest(F.lit(1), parts(ln, wanted)).cast("int"))
    return hot.withColumn("_rp", F.greatest(F.lit(1), parts(rn, F.ceil(own / F.col("_lp")))).cast("int"))


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t])      # maps have no hash


def _in_order(df: DataFrame, by: str) -> DataFrame:
    """Rows of every cell in the order of ``by``: Spark drops a plain sort below a join, but not a window whose number is read."""
    return df.withColumn("_cell_n", F.row_number().over(Window.partitionBy("_cell").orderBy(by))).filter(F.col("_cell_n") > 0).drop("_cell_n")


def _in_blocks(df: DataFrame, by: str) -> DataFrame:
    """(_cell, _block): the rows of every cell in the order of ``by``, ``BLOCK`` of them in one array."""
    n = F.row_number().over(Window.partitionBy("_cell").orderBy(by))
    rows = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "_cell"])
    return df.withColumn("_cell_n", F.floor((n - 1) / BLOCK)).groupBy("_cell", "_cell_n").agg(F.collect_list(rows).alias("_block")).drop("_cell_n")


def skew_join(left: DataFrame, right: DataFrame, on, how: str = "left", hot_rows: int | None = None,
              order: tuple[str, str] | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for ``left`` and ``inner``, with keys of more than ``hot_rows`` rows on a side
    (default: the session's hot-key bound) dealt over cells, as many as ``_with_parts`` tells.

    A left row without a partner is known from the counts: its key has no right row. So a copy of a hot left row that
    finds nothing in its cell is dropped, and one whose key has no right row at all (a null key too, which only spreads
    over its parts) is kept once with nulls. Parts are a hash of the whole row, so equal rows share a part.

    ``order`` names a column of the left and one of the right, by which an inner join with hot keys orders the rows of a
    cell and cuts the smaller side into blocks; for a join whose residual compares them, so that the matches of a row are
    one stretch of the other side. Blocks are streamed by a sort-merge join, whatever the sizes, which keeps the larger
    side of a cell (in memory, or spilled).
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join supports how='left' or 'inner'")
    on = list(on)
    own = {"_ln", "_rn", "_lp", "_rp", "_i", "_j", "_m"} | ({"_cell", "_cell_n", "_block"} if order else set())
    taken = own & (set(left.columns) | set(right.columns))
    if taken:
        raise ValueError(f"the skew join uses these column names itself: {sorted(taken)}")
    bound = hot_rows or conf_int(left.sparkSession, HOT_KEY_ROWS)
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()
    right = right.filter(known)
    hot, n = hot_join_keys(left, right, on, bound)
    if not n:
        return left.join(right, on, how)
    lrows, rrows, pairs = hot.agg(F.sum("_ln"), F.sum("_rn"), F.sum(F.col("_ln").cast("double") * F.col("_rn"))).first()
    hot = _bounded(_with_parts(hot, bound).select(*[F.col(k).alias(f"_h_{k}") for k in on], "_ln", "_rn", "_lp", "_rp"), n)

    def dealt(df: DataFrame, own: str, other: str, mine: str, yours: str) -> DataFrame:
        cond = F.lit(True)
        for k in on:
            cond = cond & df[k].eqNullSafe(hot[f"_h_{k}"])
        out = df.join(hot, cond, "left").drop(*[f"_h_{k}" for k in on])
        parts = lambda c: F.coalesce(F.col(c), F.lit(1))
        return out.withColumn(mine, F.pmod(_row_hash(df), parts(own)).cast("int")) \
            .withColumn(yours, F.explode(F.sequence(F.lit(0), parts(other) - 1))).drop("_lp", "_rp")

    l = dealt(left, "_lp", "_rp", "_i", "_j").drop("_ln")
    r = dealt(right, "_rp", "_lp", "_j", "_i").filter(F.col("_ln").isNull() | (F.col("_ln") > 0)).drop("_ln", "_rn")
    cell = [*on, "_i", "_j"]
    if how == "left":
        out = l.join(r.withColumn("_m", F.lit(True)), cell, how).filter(F.col("_m") | F.col("_rn").isNull() | (F.col("_rn") == 0))
        return out.drop("_rn", "_i", "_j", "_m")
    l = l.filter(F.col("_rn").isNull() | (F.col("_rn") > 0)).drop("_rn")
    names = [*on, *[c for c in [*l.columns, *r.columns] if c not in cell]]
    if len(set(names)) < len(names):
        return l.join(r, cell).drop("_i", "_j")
    cols = [F.col(f"`{c}`") for c in names]
    if not order:
        return (r.join(l, cell) if rrows > lrows else l.join(r, cell)).select(*cols)
    # The cell is one column: of several, Spark would drop a key that is constant on a side from the join only, and shuffle
    # again, as it would for fields that can be null on one side only (a ``nullif`` always can).
    l, r = (side.withColumn("_cell", F.struct(*[F.nullif(F.col(c), F.lit(None)).alias(c) for c in cell])).drop("_i", "_j") for side in (l, r))
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pairs > TASK_PAIRS * partitions:
        l, r = (side.repartition(partitions, "_cell") for side in (l, r))
    (small, by), (large, then) = (r, order[1]), (l, order[0])
    if rrows > lrows:
        (small, by), (large, then) = (large, then), (small, by)
    joined = _in_blocks(small.drop(*on), by).join(_in_order(large, then).hint("merge"), "_cell")
    return joined.select(*[F.col(f"`{c}`") for c in large.columns if c != "_cell"], F.inline("_block")).select(*cols)
