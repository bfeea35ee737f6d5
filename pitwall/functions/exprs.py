"""Column expressions shared by the operators and plans.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, IntegralType, LongType, ShortType

# ---- fixed values (DRS flap codes of the car telemetry feed) -------------------------
# open flap: 10, 12, 14; flap "eligible" (half weight): 8; codes kept as clearly defined: 0, 1, 8, 10, 12, 14
DRS_OPEN = (10, 12, 14)
DRS_HALF = 8
DRS_VALID = (0, 1, 8, 10, 12, 14)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c, digits: int) -> Column:
    """round(x, n) with HALF_UP on the decimal form of the double."""
    return F.round(_c(c), digits)


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch, floored.

    Accepts ``timestamp`` and ``timestamp_ntz``; an NTZ value is read as a wall
    clock in the session time zone (UTC in every session this engine builds).
    """
    return F.unix_seconds(_c(c).cast("timestamp"))


def bin_floor(c, width: int) -> Column:
    """Lower edge of the ``width``-wide bin holding ``c``, as int."""
    return (F.floor(_c(c) / F.lit(width)) * F.lit(width)).cast("int")


def null_as(c, default) -> Column:
    """coalesce(c, default)."""
    return F.coalesce(_c(c), F.lit(default))


def guarded_pct(num, den, digits: int = 1) -> Column:
    """100 * num / den rounded, 0 when the denominator is not positive."""
    return F.round(F.when(_c(den) > 0, _c(num) / _c(den) * 100).otherwise(0), digits)


def drs_open(c) -> Column:
    return _c(c).isin(*DRS_OPEN)


def drs_weight(c) -> Column:
    """1 for an open flap, 0.5 for an eligible one, 0 otherwise (X6, chained when)."""
    return F.when(drs_open(c), 1).when(_c(c) == DRS_HALF, 0.5).otherwise(0)


def step_change(prev, cur) -> Column:
    """prev - cur with the first row (no previous) counted as 0."""
    return F.coalesce(_c(prev) - _c(cur), F.lit(0))


def safe_corr(a, b) -> Column:
    """Pearson correlation that is NULL instead of failing (A11, hazard H4).

    Built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when one input is
    constant over the group. Here both inputs are restricted to rows where the
    other is present (as ``corr`` does), and the ratio uses ``try_divide``; a
    constant column or a single row gives NULL. Aggregates merge partially, so a
    hot group is combined map-side like any other algebraic aggregate.
    """
    a, b = _c(a), _c(b)
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def exact_corr(a, b) -> Column:
    """Pearson correlation of two integer-valued columns from exact moments.

    n, sums, sums of squares and of products are accumulated as decimal(38,0),
    so accumulation is exact and independent of row order and partitioning;
    only the final ratio is a double. Pairs with a null on either side are
    skipped (as ``corr`` does); a constant column or a single pair gives NULL.
    Telemetry speed, rpm and DRS codes are integers; use ``safe_corr`` for
    fractional inputs.
    """
    a, b = _c(a), _c(b)
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a).cast("decimal(38,0)")
    y = F.when(both, b).cast("decimal(38,0)")
    n = F.count(F.when(both, F.lit(1))).cast("decimal(38,0)")
    sx, sy = F.sum(x), F.sum(y)
    cov = (n * F.sum(x * y) - sx * sy).cast("double")
    vx = (n * F.sum(x * x) - sx * sx).cast("double")
    vy = (n * F.sum(y * y) - sy * sy).cast("double")
    return F.try_divide(cov, F.sqrt(vx * vy))


def corr_of(df, a, b, *integral) -> Column:
    """``exact_corr`` if the columns ``integral`` of ``df`` (``a`` and ``b`` by default) hold whole numbers by type, else ``safe_corr``."""
    whole = all(isinstance(df.schema[c].dataType, IntegralType)
                or isinstance(df.schema[c].dataType, DecimalType) and df.schema[c].dataType.scale == 0 for c in integral or (a, b))
    return (exact_corr if whole else safe_corr)(a, b)


def arg_max(value, payload) -> Column:
    """payload at the largest non-null value; ties -> larger payload."""
    v = _c(value)
    return F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), _c(payload).alias("p"))))["p"]


def arg_min(value, payload) -> Column:
    """payload at the smallest non-null value; ties -> smaller payload (A10, hazard H3)."""
    v = _c(value)
    return F.min(F.when(v.isNotNull(), F.struct(v.alias("v"), _c(payload).alias("p"))))["p"]


_BITS = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64}


def _arg(df, fn, value: str, payload: str) -> Column | None:
    """``payload`` at the extremum of (value, payload), both whole numbers, over one packed number; None if it has no room."""
    kinds = [df.schema[c].dataType for c in (value, payload)]
    bits = [_BITS.get(type(k), 0) for k in kinds]
    if not all(bits) or sum(bits) > 96:
        return None
    half, span = 1 << (bits[1] - 1), (1 << bits[1]) + 1         # a null payload is 0, and comes first as in a struct
    places = f"decimal({len(str(span)) + 1},0)"
    low = F.coalesce(F.col(payload).cast(places) + F.lit(half + 1).cast(places), F.lit(0).cast(places))
    packed = fn(F.col(value).cast("decimal(20,0)") * F.lit(span).cast(places) + low)
    low = F.pmod(packed, F.lit(span).cast(places))
    return F.when(low > 0, (low - F.lit(half + 1).cast(places)).cast(kinds[1]))


def arg_max_of(df, value: str, payload: str) -> Column:
    """``arg_max`` over one number that packs both columns of ``df``, if they are whole numbers that fit: an aggregate of
    fixed width, which hash aggregation can hold. A struct makes Spark sort the fact before it is combined."""
    packed = _arg(df, F.max, value, payload)
    return arg_max(value, payload) if packed is None else packed


def arg_min_of(df, value: str, payload: str) -> Column:
    """``arg_min`` over one packed number where the columns of ``df`` allow it."""
    packed = _arg(df, F.min, value, payload)
    return arg_min(value, payload) if packed is None else packed


# ---- sums of doubles that do not depend on the order of rows ---------------------------
# A double below 2**90 is a sum of whole multiples of these powers of two, and a rest below the last.
LIMBS = (40, -10, -60, -110)
LIMB_RANGE = 2.0 ** 90


def with_limbs(df, c, prefix: str):
    """``df`` with the limbs of ``c`` (a double) as decimals ``<prefix>0`` ..., and what they cannot hold as ``<prefix>odd``.

    Limbs are whole numbers of their power of two, so their sums are exact in any order and any grouping; ``from_limbs``
    puts the sums together once. Infinities, NaN, values from 2**90 on and parts below 2**-110 are summed as they are.
    """
    rest = f"{prefix}odd"
    df = df.withColumn(rest, _c(c).cast("double"))
    held = F.abs(F.col(rest)) < LIMB_RANGE                      # false for NaN: it is the largest number
    for k, e in enumerate(LIMBS):
        own = F.when(held, (F.col(rest) * 2.0 ** -e).cast("bigint")).when(F.col(rest).isNotNull(), F.lit(0).cast("bigint"))
        df = df.withColumn(f"{prefix}{k}", own)
        df = df.withColumn(rest, F.col(rest) - F.col(f"{prefix}{k}").cast("double") * 2.0 ** e)
    return df.withColumns({**{f"{prefix}{k}": F.col(f"{prefix}{k}").cast("decimal(16,0)") for k in range(len(LIMBS))},
                           rest: F.when(F.col(rest) != 0, F.col(rest))})


def from_limbs(prefix: str) -> Column:
    """The sum whose limbs' sums are ``<prefix>0`` ... and ``<prefix>odd``; null where nothing was summed."""
    total = None
    for k, e in enumerate(LIMBS):
        part = F.col(f"{prefix}{k}").cast("double") * 2.0 ** e
        total = part if total is None else total + part
    return total + F.coalesce(F.col(f"{prefix}odd"), F.lit(0.0))


def order_free_aggs(df, keys, sums: dict, counts: dict | None = None):
    """``df`` grouped by ``keys`` with order-free sums of doubles (A2): {name: column}, and plain aggregates beside them.

    The limbs are summed by a partial aggregate like any other sum, so a hot group is combined before the shuffle, and
    the result does not depend on how rows were read, split or shuffled.
    """
    aggs = []
    for name, c in sums.items():
        df = with_limbs(df, c, f"_x_{name}_")
        aggs += [F.sum(f"_x_{name}_{k}").alias(f"_x_{name}_{k}") for k in (*range(len(LIMBS)), "odd")]
    out = df.groupBy(*keys).agg(*aggs, *[e.alias(n) for n, e in (counts or {}).items()])
    return out.withColumns({n: from_limbs(f"_x_{n}_") for n in sums}).drop(*[c for c in out.columns if c.startswith("_x_")])


def order_free_corr(df, keys, a, b, name: str = "corr"):
    """Pearson correlation of two columns of doubles per group, from order-free moments.

    Pairs with a null on either side are skipped; products are rounded once a row, their sums are exact. Like
    ``safe_corr`` it is NULL for a constant column or a single pair; unlike it, the same on every plan.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    df = df.withColumns({"_a": F.when(b.isNotNull(), a), "_b": F.when(a.isNotNull(), b)})
    x, y = F.col("_a"), F.col("_b")
    m = order_free_aggs(df, keys, {"_sx": x, "_sy": y, "_sxx": x * x, "_syy": y * y, "_sxy": x * y}, {"_n": F.count("_a")})
    n, sx, sy = F.col("_n"), F.col("_sx"), F.col("_sy")
    vx, vy = n * F.col("_sxx") - sx * sx, n * F.col("_syy") - sy * sy
    return m.select(*keys, F.when((vx > 0) & (vy > 0), (n * F.col("_sxy") - sx * sy) / F.sqrt(vx * vy)).alias(name), F.col("_n").alias(f"{name}_n"))
