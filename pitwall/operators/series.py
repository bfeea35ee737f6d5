"""Ordered per-key series operators: rolling frames, lag/lead, running totals,
fills, first/last/whole-group values and ordinals (W1-W17).

A ``Series`` names the grouping keys and a *total* order inside each key (the
ordering columns plus tie-breaks), so every result is deterministic.

Two physical strategies compute the same values:

``window``
    One ``Window.partitionBy(keys).orderBy(order)`` per call: one hash exchange
    on the keys, one sort, one ``Window`` node for all frames. Every key is one
    task's work, which is right while groups are bounded.

``split``
    For hot keys (one key may hold a large share of all rows). A key is cut into
    *stretches* of about ``C`` consecutive rows: time sub-buckets, or, for bursts
    and non-numeric orders, parts of a range partitioning on keys + order. One
    aggregate per stretch holds its number of rows and, for every requested
    column, its sum, extremum, first, last or last non-null value; it is kept
    in the checkpoint folder (rows / C rows), and one prefix over it serves the
    ordinal, the carries of running values and fills, and whole-group values
    together. The rows are then read once: they take their stretch's prefix by a
    join and complete it with a window inside the stretch. Bounded frames
    (rolling, lag, lead) see chunks of ``C`` rows by ordinal with a halo of the
    neighbouring chunks' boundary rows, in the order of the ``window`` strategy,
    so sums over a frame are bit-identical.

``auto`` (default) profiles the key sizes first (one aggregation job) and picks
``window`` unless the largest group exceeds ``spark.pitwall.series.hotKeyRows``;
then only the hot keys take the ``split`` route and the rest stay on ``window``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from pitwall.functions.exprs import LIMBS, from_limbs, with_limbs
from pitwall.operators.scope import BROADCAST_BYTES, row_width
from pitwall.session import BROADCAST_ROWS, CHUNK_ROWS, HOT_KEY_ROWS, ORDINAL, RANGE_ROWS, conf_int, ensure_checkpoint_dir

_AGG = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_LAST = (1 << 63) - 1   # sub-bucket of NaN, which sorts last
# names of the split route's own columns
RESERVED = {"_rn", "_ck", "_cc", "_sb", "_off", "_t", "_t0", "_w", "_mid", "_l", "_n"}
_UNB_P, _UNB_F = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Spec:
    kind: str                 # rolling|lag|lead|first|last|whole|running|fill_fwd|fill_bwd|row_number
    fn: str | None = None     # avg|sum|min|max|count for rolling/whole/running
    col: object = None        # column name or Column
    lo: int = 0               # rows before the current row
    hi: int = 0               # rows after the current row


def rolling(fn: str, col, preceding: int, following: int = 0) -> Spec:
    """fn over rows [-preceding, +following]: preceding=5 is a 6-row frame (hazard H8)."""
    return Spec("rolling", fn, col, preceding, following)


def lag(col, n: int = 1) -> Spec:
    return Spec("lag", None, col, n, 0)


def lead(col, n: int = 1) -> Spec:
    return Spec("lead", None, col, 0, n)


def first(col) -> Spec:
    """Value at the first row of the key (nulls not skipped)."""
    return Spec("first", None, col)


def last(col) -> Spec:
    """Value at the last row of the key (nulls not skipped)."""
    return Spec("last", None, col)


def whole(fn: str, col) -> Spec:
    """fn over every row of the key (order-free; sums and averages of doubles too, see ``running``)."""
    return Spec("whole", fn, col)


def running(fn: str, col) -> Spec:
    """fn over rows (unbounded preceding, current].

    Sums of doubles are summed as whole-number limbs (``exprs.with_limbs``): exact, so equal bit for bit on every route, in
    any partitioning and after any shuffle.
    """
    if fn not in ("sum", "count", "min", "max"):
        raise ValueError(f"running {fn} is not supported")
    return Spec("running", fn, col)


def fill(col, forward: bool = True) -> Spec:
    """Last non-null value at or before the row (forward) / first at or after it."""
    return Spec("fill_fwd" if forward else "fill_bwd", None, col)


def row_number() -> Spec:
    return Spec("row_number")


@dataclass(frozen=True)
class Profile:
    groups: int
    max_rows: int
    rows: int
    hot_groups: int = 0       # groups above the hot-key bound at profiling time
    hot_rows: int = 0         # rows in those groups
    hot_bound: int = 0


@dataclass(frozen=True)
class Series:
    keys: tuple
    order: tuple
    strategy: str = "auto"            # auto | window | split
    chunk_rows: int | None = None
    profile: Profile | None = field(default=None, compare=False)
    isolate: bool = False             # split only the hot keys, window the rest (set by auto)
    hot_key_rows: int | None = None   # hot-key bound; default spark.pitwall.series.hotKeyRows

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))
        object.__setattr__(self, "order", tuple(self.order))
        if self.strategy.startswith("split:"):     # "split:N" = split with N-row chunks
            object.__setattr__(self, "chunk_rows", int(self.strategy.split(":", 1)[1]))
            object.__setattr__(self, "strategy", "split")
        if self.strategy.startswith("auto:"):      # "auto:N" = auto with an N-row hot-key bound
            object.__setattr__(self, "hot_key_rows", int(self.strategy.split(":", 1)[1]))
            object.__setattr__(self, "strategy", "auto")
        if self.strategy not in ("auto", "window", "split"):
            raise ValueError(f"unknown series strategy {self.strategy!r}")

    def checked(self, df: DataFrame) -> "Series":
        """Resolve ``auto`` once for a DataFrame so several calls share the decision."""
        if self.strategy == "window" or (self.strategy == "split" and self.profile is not None):
            return self
        prof = profile(df, self.keys, self.hot_key_rows)
        if self.strategy == "split":
            return replace(self, profile=prof)
        return _decide(self, prof)

    def apply(self, df: DataFrame, **specs: Spec) -> DataFrame:
        """Add one column per spec. A spec whose column names another spec of the
        same call (a window over a window, W15) runs in a later stage; on the split
        route all stages share one distributed ordinal."""
        taken = RESERVED & set(df.columns)
        if taken:
            raise ValueError(f"the series operators use these column names themselves: {sorted(taken)}")
        s = self.checked(df)
        stages = _stages(df, specs)
        if s.strategy == "window":
            for st in stages:
                df = _order_free(_window_path, df, s, st)
            return df
        if s.isolate and 0 < s.profile.hot_groups < s.profile.groups:
            return _isolated(df, s, stages)
        return _split_stages(df, s, stages)


def _refers(df: DataFrame, c, name: str, specs: dict) -> bool:
    """Does a spec's column (a name or an expression) need the column ``name``? An expression does if it cannot be resolved without."""
    if not isinstance(c, Column):
        return c == name
    others = [F.lit(None).alias(o) for o in specs if o != name and o not in df.columns]
    try:
        df.select(*[F.col(f"`{o}`") for o in df.columns if o != name], *others).select(c)
    except AnalysisException as e:
        return (e.getCondition() or "").startswith("UNRESOLVED_COLUMN")
    return False


def _stages(df: DataFrame, specs: dict) -> list:
    """Specs in the order in which they can be computed; one that reads another one's column comes after it."""
    needs = {n: {o for o in specs if o != n and _refers(df, sp.col, o, specs)} for n, sp in specs.items()}
    pending, stages = dict(specs), []
    while pending:
        ready = {n: sp for n, sp in pending.items() if not needs[n] & pending.keys()}
        if not ready:
            raise ValueError("specs refer to each other in a cycle")
        stages.append(ready)
        for n in ready:
            pending.pop(n)
    return stages


def _split_stages(df: DataFrame, s: "Series", stages: list) -> DataFrame:
    for i, st in enumerate(stages):
        df = _order_free(_split_path, df, s, st, keep_rn=i < len(stages) - 1)
    return df


def _order_free(path, df: DataFrame, s: "Series", specs: dict, **more) -> DataFrame:
    """A stage in which sums and averages of doubles over unbounded frames are sums of limbs, put together at the end.

    Bounded frames see the same rows in the same order on every route, and stay as they are.
    """
    split, plain = {}, {}
    for name, sp in specs.items():
        unbounded = sp.kind in ("running", "whole") and sp.fn in ("sum", "avg")
        floating = unbounded and isinstance(df.select(_col(sp.col).alias("c")).schema["c"].dataType, (DoubleType, FloatType))
        (split if floating else plain)[name] = sp
    if not split:
        return path(df, s, specs, **more)
    for name, sp in split.items():
        prefix = f"_x_{name}_"
        df = with_limbs(df, sp.col, prefix)
        plain |= {f"_y_{name}_{k}": Spec(sp.kind, "sum", f"{prefix}{k}") for k in (*range(len(LIMBS)), "odd")}
        if sp.fn == "avg":
            plain[f"_y_{name}_n"] = Spec(sp.kind, "count", f"{prefix}0")
    out = path(df, s, plain, **more)
    total = {n: from_limbs(f"_y_{n}_") for n in split}
    out = out.withColumns({n: F.when(F.col(f"_y_{n}_n") > 0, e / F.col(f"_y_{n}_n")) if split[n].fn == "avg" else e for n, e in total.items()})
    return out.drop(*[c for c in out.columns if c.startswith(("_x_", "_y_"))])


def _decide(s: "Series", prof: Profile) -> "Series":
    if prof.max_rows > prof.hot_bound:
        return replace(s, strategy="split", profile=prof, isolate=True)
    return replace(s, strategy="window", profile=prof)


def _isolated(df: DataFrame, s: "Series", stages: list) -> DataFrame:
    """Hot keys through the split path, every other key through one plain window.

    The hot-key table is lazy (no collect) and has at most rows / hotKeyRows
    entries, a proven bound for its broadcast.
    """
    keys = list(s.keys)
    p = s.profile
    hot = (df.groupBy(*keys).count().filter(F.col("count") > p.hot_bound).drop("count")
           .select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    hot = _bounded(hot, p.rows // max(p.hot_bound, 1) + 1)
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(hot[f"_h_{k}"])
        cond = e if cond is None else cond & e
    hot_rows = df.join(hot, cond, "left_semi")
    cold_rows = df.join(hot, cond, "left_anti")
    hot_prof = Profile(p.hot_groups, p.max_rows, p.hot_rows, p.hot_groups, p.hot_rows, p.hot_bound)
    cold_prof = Profile(p.groups - p.hot_groups, p.hot_bound, p.rows - p.hot_rows, 0, 0, p.hot_bound)
    hot_out = _split_stages(hot_rows, replace(s, profile=hot_prof), stages)
    cold = replace(s, strategy="window", profile=cold_prof)
    for st in stages:
        cold_rows = _order_free(_window_path, cold_rows, cold, st)
    return cold_rows.unionByName(hot_out)


def resolve(df: DataFrame, *series: "Series") -> list:
    """Resolve several series against one (cheap, ancestor) DataFrame in a single job.

    The series must run on this frame or on one whose groups only shrink from
    it (later filters, joins with de-duplicated dimensions); after a join that
    multiplies rows, leave the series unresolved: it profiles its own frame. All key sets are counted together with ``groupingSets``.
    """
    if any(s.hot_key_rows for s in series):
        return [s.checked(df) for s in series]
    todo = [s for s in series if s.strategy != "window" and s.profile is None]
    if not todo:
        return list(series)
    sets = list(dict.fromkeys(tuple(s.keys) for s in todo))
    cols = list(dict.fromkeys(c for ks in sets for c in ks))
    gid = F.grouping_id(*cols).alias("_gid")
    counts = df.groupingSets([[F.col(c) for c in ks] for ks in sets], *[F.col(c) for c in cols]).agg(
        gid, F.count(F.lit(1)).alias("_n"))
    hot = conf_int(df.sparkSession, HOT_KEY_ROWS)
    stats = {r["_gid"]: r for r in _summary(counts, "_n", hot, ["_gid"]).collect()}
    out = []
    for s in series:
        if s.strategy == "window" or s.profile is not None:
            out.append(s)
            continue
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s.keys)
        prof = _profile_of(stats.get(bits), hot)
        out.append(replace(s, profile=prof) if s.strategy == "split" else _decide(s, prof))
    return out


def _summary(counts: DataFrame, n: str, hot: int, by=()):
    c = F.col(n)
    return counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("g"), F.max(c).alias("m"), F.sum(c).alias("n"),
        F.count(F.when(c > hot, F.lit(1))).alias("hg"), F.sum(F.when(c > hot, c).otherwise(0)).alias("hn"))


def _profile_of(r, hot: int) -> Profile:
    if r is None:
        return Profile(0, 0, 0, 0, 0, hot)
    return Profile(int(r["g"] or 0), int(r["m"] or 0), int(r["n"] or 0), int(r["hg"] or 0), int(r["hn"] or 0), hot)


def profile(df: DataFrame, keys, hot: int | None = None) -> Profile:
    """Groups, largest group, rows, and the groups/rows above the hot-key bound
    (partial aggregation, one job, one summary row to the driver)."""
    hot = hot or conf_int(df.sparkSession, HOT_KEY_ROWS)
    return _profile_of(_summary(df.groupBy(*keys).count(), "count", hot).first(), hot)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _reversed(order) -> list:
    """The opposite of ascending order with nulls first; entries are names or unsorted columns."""
    return [_col(c).desc_nulls_last() for c in order]


# ----------------------------------------------------------------------------- window


def _window_path(df: DataFrame, s: Series, specs: dict) -> DataFrame:
    if s.profile is not None and specs and all(sp.kind == "whole" for sp in specs.values()) \
            and s.profile.groups <= conf_int(df.sparkSession, BROADCAST_ROWS):
        # Group values only, and the profile proved the groups few: aggregate
        # map-side and broadcast the per-group table back instead of shuffling
        # every row to its group (no exchange of the fact at all).
        per_key = df.groupBy(*s.keys).agg(*[_AGG[sp.fn](_col(sp.col)).alias(n) for n, sp in specs.items()])
        return _join_back(df, per_key, list(s.keys), s.profile.groups)
    part = Window.partitionBy(*s.keys)
    ordered = part.orderBy(*s.order)
    cols = {}
    for name, sp in specs.items():
        c = _col(sp.col) if sp.col is not None else None
        if sp.kind == "rolling":
            e = _AGG[sp.fn](c).over(ordered.rowsBetween(-sp.lo, sp.hi))
        elif sp.kind == "lag":
            e = F.lag(c, sp.lo).over(ordered)
        elif sp.kind == "lead":
            e = F.lead(c, sp.hi).over(ordered)
        elif sp.kind == "first":
            e = F.first(c).over(ordered.rowsBetween(_UNB_P, _UNB_F))
        elif sp.kind == "last":
            e = F.last(c).over(ordered.rowsBetween(_UNB_P, _UNB_F))
        elif sp.kind == "whole":
            e = _AGG[sp.fn](c).over(part)
        elif sp.kind == "running":
            e = _AGG[sp.fn](c).over(ordered.rowsBetween(_UNB_P, 0))
        elif sp.kind == "fill_fwd":
            e = F.last(c, ignorenulls=True).over(ordered.rowsBetween(_UNB_P, 0))
        elif sp.kind == "fill_bwd":
            # the running frame of the reversed order: a frame to unboundedFollowing is recomputed for every row
            e = F.last(c, ignorenulls=True).over(part.orderBy(*_reversed(s.order)).rowsBetween(_UNB_P, 0))
        elif sp.kind == "row_number":
            e = F.row_number().over(ordered)
        else:
            raise ValueError(sp.kind)
        cols[name] = e
    return df.withColumns(cols)


# ------------------------------------------------------------------------------ split


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side whose row count is known to be under the session bound, in rows and in bytes."""
    return F.broadcast(df) if rows <= min(conf_int(df.sparkSession, BROADCAST_ROWS), BROADCAST_BYTES // row_width(df)) else df


def _pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once into the cluster's checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ordinal(df: DataFrame, keys, order, name: str = "_rn", prof: Profile | None = None,
            chunk: int | None = None) -> DataFrame:
    """Dense 1-based ordinal of each row inside its key, without one task per key.

    ``spark.pitwall.series.ordinal``: ``auto`` (default) tries the time route and
    falls back to the range route; ``time`` / ``range`` force one.
    """
    s = Series(tuple(keys), tuple(order), "split", chunk, prof or profile(df, keys))
    return _split_path(df, s, {name: row_number()})


def _cut(df: DataFrame, s: "Series", prof: Profile, chunk: int, summed) -> tuple[DataFrame, DataFrame, int]:
    """``df`` with its stretches ``_sb`` (ascending in the order within a key), the table of stretches, and its number of rows."""
    mode = df.sparkSession.conf.get(ORDINAL, "auto")
    rows = _time_cut(df, s.keys, s.order, prof, chunk) if mode != "range" and s.order else None
    if rows is not None:
        table, n, biggest = summed(rows)
        if biggest <= 4 * chunk or mode == "time":
            return rows, table, n
    rows = _range_cut(df, s.keys, s.order, prof)
    return rows, *summed(rows)[:2]


def _time_cut(df: DataFrame, keys, order, prof: Profile, chunk: int):
    """Stretches from time sub-buckets: deterministic, no sampling, rows are not written.

    The first ordering column (a time or a number) cuts each key into
    sub-buckets of width (span * C / rows), about C rows each when the key is
    sampled at a steady rate (a burst shows in their table, and takes the range
    route). Every step is a function of the data, so branches that re-read it
    agree, provided the order is total. None when the first ordering column is
    not a time or number.
    """
    first = order[0]
    if not isinstance(first, str) or first not in df.columns:
        return None
    dt = df.schema[first].dataType
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        t = F.unix_micros(F.col(first).cast("timestamp")).cast("double")
    elif isinstance(dt, DateType):
        t = F.unix_date(F.col(first)).cast("double")
    elif isinstance(dt, NumericType):
        t = F.col(first).cast("double")
    else:
        return None
    keys = list(keys)
    # infinities and NaN have sub-buckets of their own, in the order in which Spark sorts them
    special = F.lit(None).cast("bigint")
    if isinstance(dt, (FloatType, DoubleType)):
        special = (F.when(F.isnan(t), F.lit(_LAST)).when(t == float("inf"), F.lit(_LAST - 1))
                   .when(t == float("-inf"), F.lit(-1)).cast("bigint"))
        t = F.when(special.isNull(), t)
    tdf = df.withColumn("_t", t)
    stats = tdf.groupBy(*keys).agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"), F.count(F.lit(1)).alias("_kn"))
    width = F.greatest(F.lit(1.0), F.ceil((F.col("_t1") - F.col("_t0") + 1) * float(chunk) / F.col("_kn")).cast("double"))
    stats = _pinned(stats.select(*keys, "_t0", width.alias("_w")))
    sub = _join_back(tdf, stats, keys, prof.groups)
    return sub.withColumn("_sb", F.coalesce(special, F.floor((F.col("_t") - F.col("_t0")) / F.col("_w")),
                                            F.lit(-2).cast("bigint"))).drop("_t", "_t0", "_w")


def _range_cut(df: DataFrame, keys, order, prof: Profile) -> DataFrame:
    """Stretches from a range partitioning (any orderable columns, any distribution).

    Rows are range-partitioned on (keys, order) into ``P`` partitions with an
    explicit count, so AQE keeps the partitioning, and a hot key lands in many
    partitions; a partition's rows of a key are a stretch. The rows are written
    with a reliable ``checkpoint`` to the cluster's checkpoint folder: the table
    of stretches and the rows must see one physical partitioning.
    """
    spark = df.sparkSession
    per_part = conf_int(spark, RANGE_ROWS)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(prof.rows / per_part))
    sort_cols = [*keys, *order]
    return _pinned(df.repartitionByRange(parts, *sort_cols).sortWithinPartitions(*sort_cols)
                   .withColumn("_sb", F.spark_partition_id().cast("bigint")))


def _join_back(left: DataFrame, right: DataFrame, on: list, rows: int) -> DataFrame:
    """Left join on ``on`` with null-safe equality (a null key is a group too)."""
    r = right.select(*[F.col(c).alias(f"_j_{c}") for c in on],
                     *[c for c in right.columns if c not in on])
    r = _bounded(r, rows)
    cond = None
    for c in on:
        e = left[c].eqNullSafe(r[f"_j_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"_j_{c}" for c in on])


def _partials(df: DataFrame, specs: dict, at) -> dict:
    """What the table of stretches holds for the specs; ``at`` orders the rows of a stretch."""
    out = {}
    for name, sp in specs.items():
        c = _col(sp.col) if sp.col is not None else None
        if sp.kind == "whole" and sp.fn == "avg":
            fractional = isinstance(df.select(c.alias("c")).schema["c"].dataType, DecimalType)
            out[f"_s_{name}"] = F.sum(c if fractional else c.cast("double"))
            out[f"_p_{name}"] = F.count(c)
        elif sp.kind in ("running", "whole"):
            out[f"_p_{name}"] = _AGG[sp.fn](c)
        elif sp.kind == "fill_fwd":
            out[f"_p_{name}"] = F.max_by(c, F.when(c.isNotNull(), at))
        elif sp.kind == "fill_bwd":
            out[f"_p_{name}"] = F.min_by(c, F.when(c.isNotNull(), at))
        elif sp.kind == "first":
            out[f"_p_{name}"] = F.min_by(c, at)
        elif sp.kind == "last":
            out[f"_p_{name}"] = F.max_by(c, at)
    return out


def _prefix(table: DataFrame, df: DataFrame, keys: list, specs: dict) -> DataFrame:
    """Of every stretch: the rows before it, and each spec's carry (running values, fills) or group value."""
    part = Window.partitionBy(*keys)
    ahead = part.orderBy("_sb")
    before, whole_ = ahead.rowsBetween(_UNB_P, -1), ahead.rowsBetween(_UNB_P, _UNB_F)
    after = part.orderBy(F.col("_sb").desc()).rowsBetween(_UNB_P, -1)
    cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    for name, sp in specs.items():
        p = F.col(f"_p_{name}")
        if sp.kind == "running":
            e = _AGG["sum" if sp.fn == "count" else sp.fn](p).over(before)
        elif sp.kind == "fill_fwd":
            e = F.last(p, ignorenulls=True).over(before)
        elif sp.kind == "fill_bwd":
            e = F.last(p, ignorenulls=True).over(after)
        elif sp.kind == "first":
            e = F.first(p).over(whole_)
        elif sp.kind == "last":
            e = F.last(p).over(whole_)
        elif sp.kind == "whole" and sp.fn == "avg":
            result = df.select(F.avg(_col(sp.col)).alias("a")).schema["a"].dataType
            n = F.sum(p).over(part)
            e = F.when(n > 0, F.sum(f"_s_{name}").over(part) / n).cast(result)
        elif sp.kind == "whole":
            e = _AGG["sum" if sp.fn == "count" else sp.fn](p).over(part)
        else:
            continue
        cols.append(e.alias(f"_c_{name}"))
    return table.select(*keys, "_sb", *cols)


def _split_path(df: DataFrame, s: Series, specs: dict, keep_rn: bool = False) -> DataFrame:
    spark = df.sparkSession
    prof = s.profile or profile(df, s.keys)
    keys = list(s.keys)
    if all(sp.kind == "whole" for sp in specs.values()) and "_sb" not in df.columns and not keep_rn:
        per_key = _pinned(df.groupBy(*keys).agg(*[_AGG[sp.fn](_col(sp.col)).alias(n) for n, sp in specs.items()]))
        return _join_back(df, per_key, keys, prof.groups)
    bounded = {n: sp for n, sp in specs.items() if sp.kind in ("rolling", "lag", "lead")}
    a = max([sp.lo for sp in bounded.values()], default=0)
    b = max([sp.hi for sp in bounded.values()], default=0)
    C = max(s.chunk_rows or conf_int(spark, CHUNK_ROWS), a, b, 1)

    def summed(rows: DataFrame):
        at = F.col("_rn") if "_rn" in rows.columns else F.struct(*[_col(c).alias(f"o{k}") for k, c in enumerate(s.order)])
        extra = [e.alias(n) for n, e in _partials(df, specs, at).items()]
        table = _pinned(rows.groupBy(*keys, "_sb").agg(F.count(F.lit(1)).alias("_n"), *extra))
        n, biggest = table.agg(F.count(F.lit(1)), F.max("_n")).first()
        return table, n, biggest or 0

    if "_sb" in df.columns:     # an earlier stage of the same call left its stretches and ordinal on the rows
        rows, (table, n, _) = df, summed(df)
    else:
        rows, table, n = _cut(df, s, prof, C, summed)
    base = _join_back(rows, _prefix(table, df, keys, specs), [*keys, "_sb"], n)

    # inside a stretch: the ordinal, running values and fills, completed by what comes before (or after) it
    numbered = "_rn" in rows.columns
    order = ["_rn"] if numbered else list(s.order)
    inner = Window.partitionBy(*keys, "_sb")
    upto, back = inner.orderBy(*order).rowsBetween(_UNB_P, 0), inner.orderBy(*_reversed(order)).rowsBetween(_UNB_P, 0)
    local = {}
    if not numbered and (bounded or keep_rn or any(sp.kind == "row_number" for sp in specs.values())):
        local["_l"] = F.row_number().over(inner.orderBy(*order))
    for name, sp in specs.items():
        if sp.kind == "running":
            local[f"_v_{name}"] = _AGG[sp.fn](_col(sp.col)).over(upto)
        elif sp.kind in ("fill_fwd", "fill_bwd"):
            local[f"_v_{name}"] = F.last(_col(sp.col), ignorenulls=True).over(upto if sp.kind == "fill_fwd" else back)
    out = base.withColumns(local) if local else base
    if "_l" in local:
        out = out.withColumn("_rn", F.col("_off") + F.col("_l")).drop("_l")
    done = {}
    for name, sp in specs.items():
        own, carry = F.col(f"_v_{name}"), F.col(f"_c_{name}")
        if sp.kind == "running" and sp.fn in ("sum", "count"):
            done[name] = F.when(own.isNull(), carry).when(carry.isNull(), own).otherwise(carry + own)
        elif sp.kind == "running":
            done[name] = (F.greatest if sp.fn == "max" else F.least)(carry, own)
        elif sp.kind in ("fill_fwd", "fill_bwd"):
            done[name] = F.coalesce(own, carry)
        elif sp.kind in ("first", "last", "whole"):
            done[name] = carry
        elif sp.kind == "row_number":
            done[name] = F.col("_rn").cast("int")
        elif name not in bounded:
            raise ValueError(sp.kind)
    scratch = {f"_v_{n}": e for n, e in done.items()}
    out = out.withColumns(scratch).drop("_off", *[f"_c_{n}" for n in specs])

    if bounded:
        chunk, pos = F.floor((F.col("_rn") - 1) / C), (F.col("_rn") - 1) % C
        out = out.withColumn("_ck", chunk)
        copies = [F.col("_ck")]
        if a > 0:   # my tail is the preceding halo of the next chunk
            copies.append(F.when(pos >= C - a, F.col("_ck") + 1))
        if b > 0:   # my head is the following halo of the previous chunk
            copies.append(F.when((pos < b) & (F.col("_ck") > 0), F.col("_ck") - 1))
        out = out.withColumn("_cc", F.explode(F.array_compact(F.array(*copies))))
        w = Window.partitionBy(*keys, "_cc").orderBy("_rn")
        framed = {}
        for name, sp in bounded.items():
            c = _col(sp.col)
            if sp.kind == "rolling":
                framed[f"_v_{name}"] = _AGG[sp.fn](c).over(w.rowsBetween(-sp.lo, sp.hi))
            else:
                framed[f"_v_{name}"] = F.lag(c, sp.lo).over(w) if sp.kind == "lag" else F.lead(c, sp.hi).over(w)
        out = out.withColumns(framed).filter(F.col("_cc") == F.col("_ck")).drop("_ck", "_cc")
    out = out.withColumns({n: F.col(f"_v_{n}") for n in specs}).drop(*[f"_v_{n}" for n in specs])
    return out if keep_rn else out.drop("_rn", "_sb")
