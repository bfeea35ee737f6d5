"""Aggregation helpers (A1-A14) beyond a plain ``groupBy().agg()``.

Everything here is an algebraic aggregate, so Spark combines it map-side
(partial aggregation) before the shuffle: a hot group is reduced to one row per
input partition before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

FIXED = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def dedupe_ordered(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the row with the smallest (order..., other columns...) tuple.

    ``dropDuplicates`` keeps an arbitrary row; this keeps a declared one. Nulls
    in ``order`` sort first, as in an ascending ``orderBy``. A single column of
    fixed width beside the keys is a plain minimum, which hash aggregation holds;
    several are compared as a struct, for which Spark sorts the rows first.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and len(order) == 1 and isinstance(df.schema[order[0]].dataType, FIXED):
        (c,) = order
        least = F.when(F.count(F.lit(1)) == F.count(c), F.min(c))       # a null is the smallest
        return df.groupBy(*keys).agg(least.alias(c)).select(*df.columns)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in order + rest]).select(*df.columns)


def count_if(cond: Column) -> Column:
    """Conditional count."""
    return F.count(F.when(cond, F.lit(1)))


def avg_if(cond: Column, value) -> Column:
    """Conditional average: rows failing ``cond`` are ignored."""
    return F.avg(F.when(cond, value))


def positive_sum(c) -> Column:
    """Sum of the positive part."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(F.when(c > 0, c).otherwise(0))


def negative_sum(c) -> Column:
    """Sum of the negative part, <= 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(F.when(c < 0, c).otherwise(0))
