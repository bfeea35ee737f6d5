"""Time and range joins the DataFrame API has no single operator for.

All of them are equi-joins on the entity keys plus a *bucket* column, with the
range test left as a join residual. Buckets spread one hot entity over many
join keys, so a skewed driver/session does not land in a single task, and the
number of candidate pairs per bucket stays proportional to the true matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.exprs import epoch_seconds
from pitwall.operators.series import Series, _bounded, fill
from pitwall.operators.skew import skew_join
from pitwall.session import HOT_KEY_ROWS, conf_int, ensure_checkpoint_dir


def _right_side(right: DataFrame, keys, right_cols: dict, extra: dict) -> DataFrame:
    cols = [F.col(k).alias(f"_r_{k}") for k in keys]
    cols += [F.col(src).alias(dst) for src, dst in right_cols.items()]
    cols += [e.alias(n) for n, e in extra.items()]
    return right.select(*cols)


def _key_match(left: DataFrame, right: DataFrame, keys):
    cond = None
    for k in keys:
        c = left[k] == right[f"_r_{k}"]
        cond = c if cond is None else cond & c
    return cond


def join_on_time_bucket(left: DataFrame, right: DataFrame, keys, left_ts: str = "date", right_ts: str = "date",
                        right_cols: dict | None = None, seconds: int = 1, bucket_col: str = "date_sec",
                        how: str = "left", hot_rows: int | None = None) -> DataFrame:
    """Equi-join on (keys, whole ``seconds``-wide time bucket), n:m within a bucket.

    ``bucket_col`` (floor(epoch / seconds)) is kept on the output. The bucket is
    part of the join key, so a hot driver is spread over as many partitions as
    it has seconds; a bucket that is hot on either side (more than ``hot_rows``
    rows, counted first) is dealt over cells by ``skew_join``, in the same join.
    """
    right_cols = right_cols or {}
    l = left.withColumn(bucket_col, F.floor(epoch_seconds(left_ts) / seconds))
    r = right.select(*keys, F.floor(epoch_seconds(right_ts) / seconds).alias(bucket_col),
                     *[F.col(s).alias(d) for s, d in right_cols.items()])
    if how not in ("left", "inner"):
        return l.join(r, [*keys, bucket_col], how)
    return skew_join(l, r, [*keys, bucket_col], how, hot_rows)


def proximity_join(left: DataFrame, right: DataFrame, keys, tol_seconds: int, left_ts: str = "date",
                   right_ts: str = "date", right_cols: dict | None = None, how: str = "left",
                   hot_rows: int | None = None) -> DataFrame:
    """Left rows joined to right rows of the same keys with |dt| < tol whole seconds, strict.

    Bucket width is 2*tol. A left row sits in one bucket; each right row is
    copied to the (at most two) buckets whose left rows it can match, so every
    matching pair meets exactly once, and a left row sees all its candidates in
    one place: one outer join with the time test as its residual gives the
    matches and the unmatched rows, and each side is read once.

    A right bucket of more than ``hot_rows`` rows (counted first; default: the
    session's hot-key bound) would overload that join's task, which AQE cannot
    split on the right of an outer join. Left rows of such buckets take a second
    route: an inner join, their parts dealt by ``skew_join``, and the rows
    without a match from an anti-join against the bucket's distinct seconds (at
    most 4*tol). The other rows stay on the one join.
    """
    if how not in ("left", "inner"):
        raise ValueError("proximity_join supports how='left' or 'inner'")
    right_cols = right_cols or {}
    w = 2 * tol_seconds
    rkeys = [f"_r_{k}" for k in keys]
    lcols = left.columns
    l = left.withColumn("_ls", epoch_seconds(left_ts)).withColumn("_lb", F.floor(F.col("_ls") / w))
    r = _right_side(right, keys, right_cols, {"_rs": epoch_seconds(right_ts)})
    r = r.withColumn("_rb", F.explode(F.array_distinct(F.array(
        F.floor((F.col("_rs") - tol_seconds + 1) / w), F.floor((F.col("_rs") + tol_seconds - 1) / w)))))
    bound = hot_rows or conf_int(left.sparkSession, HOT_KEY_ROWS)
    sizes = r.groupBy(*rkeys, "_rb").count().filter(F.col("count") > bound).drop("count")
    outcols = [*lcols, *right_cols.values()]

    def cond(lf, rf):
        return _key_match(lf, rf, keys) & (lf["_lb"] == rf["_rb"]) & (F.abs(lf["_ls"] - rf["_rs"]) < tol_seconds)

    if not sizes.head(1):
        return l.join(r, cond(l, r), how).select(*[l[c] for c in lcols], *[r[c] for c in right_cols.values()])

    ensure_checkpoint_dir(left.sparkSession)
    hot = sizes.checkpoint(eager=True)
    hot = _bounded(hot, hot.count())
    lhot = hot.select(*[F.col(c).alias(f"_h{c}") for c in [*rkeys, "_rb"]])

    def in_hot(lf):
        c = lf["_lb"] == lhot["_h_rb"]
        for k in keys:
            c = c & (lf[k] == lhot[f"_h_r_{k}"])
        return c

    cold, crowded = l.join(lhot, in_hot(l), "left_anti"), l.join(lhot, in_hot(l), "left_semi")
    quiet = r.join(hot, [*rkeys, "_rb"], "left_anti")
    calm = cold.join(quiet, cond(cold, quiet), how).select(*[cold[c] for c in lcols], *[quiet[c] for c in right_cols.values()])

    on = [*[f"_k_{k}" for k in keys], "_b"]
    lc = crowded.withColumns({**{f"_k_{k}": F.col(k) for k in keys}, "_b": F.col("_lb")})
    rc = r.join(hot, [*rkeys, "_rb"], "left_semi").select(*[F.col(f"_r_{k}").alias(f"_k_{k}") for k in keys], F.col("_rb").alias("_b"),
                                                           "_rs", *right_cols.values())
    matched = skew_join(lc, rc, on, "inner", bound, order=("_ls", "_rs")).filter(F.abs(F.col("_ls") - F.col("_rs")) < tol_seconds).select(*outcols)
    if how == "inner":
        return calm.unionByName(matched)
    seconds = r.join(hot, [*rkeys, "_rb"], "left_semi").select(*rkeys, "_rs", "_rb").distinct()
    alone = crowded.join(seconds, cond(crowded, seconds), "left_anti").select(*lcols)
    for src, dst in right_cols.items():
        alone = alone.withColumn(dst, F.lit(None).cast(right.schema[src].dataType))
    return calm.unionByName(matched).unionByName(alone)


def containment_join(left: DataFrame, right: DataFrame, keys, x: str, lo: str, hi: str,
                     right_cols: dict | None = None, bucket_width: int = 32, how: str = "left",
                     hot_rows: int | None = None) -> DataFrame:
    """Left rows joined to right ranges of the same keys with lo <= x <= hi, inclusive.

    A range belongs to one level: the blocks of ``bucket_width * 2**level`` of
    which it covers at most two, so a range is copied twice at most, however
    long it is. Levels in use are at most one per doubling of the longest range;
    one for ranges of about a bucket, which is then a single outer join on keys
    and block. With several, a left row is copied to its block on each of them
    and one inner join makes all matches; left rows without a match come from
    anti-joins, one after the other.

    One aggregate over the ranges tells the levels and the largest block of
    each. A level with a block of more than ``hot_rows`` ranges (default: the
    session's hot-key bound) is dealt over cells by ``skew_join``; its unmatched
    rows are found against what the block's ranges cover, one range for every
    distinct start (so at most as many as a block has whole numbers).
    """
    right_cols = dict(right_cols or {})
    bound = hot_rows or conf_int(left.sparkSession, HOT_KEY_ROWS)
    r = _right_side(right, keys, right_cols, {"_lo": F.col(lo), "_hi": F.col(hi)}).where(F.col("_lo") <= F.col("_hi"))
    rkeys = [f"_r_{k}" for k in keys]
    span = (F.col("_hi") - F.col("_lo") + 1).cast("double") / float(bucket_width)
    r = r.withColumn("_lv", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(span, F.lit(1.0))))).cast("int"))
    width = float(bucket_width) * F.pow(F.lit(2.0), F.col("_lv"))
    r = r.withColumn("_rb", F.explode(F.array_distinct(F.array(F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width)))))
    sizes = r.groupBy(*rkeys, "_lv", "_rb").count().groupBy("_lv").agg(F.max("count").alias("most"))
    levels = {row["_lv"]: row["most"] for row in sizes.collect()} or {0: 0}      # some sixty rows at most
    helpers = ["_lb", "_rb", "_lo", "_hi", "_lv", *rkeys]

    def at(level: int):
        lf = left.withColumn("_lb", F.floor(F.col(x) / (float(bucket_width) * 2.0 ** level)))
        rf = r.filter(F.col("_lv") == level)
        return lf, rf, _key_match(lf, rf, keys) & (lf["_lb"] == rf["_rb"]) & (lf[x] >= rf["_lo"]) & (lf[x] <= rf["_hi"])

    if len(levels) == 1 and max(levels.values()) <= bound:
        lf, rf, cond = at(min(levels))
        return lf.join(rf, cond, how).drop(*helpers)
    if how not in ("left", "inner"):
        raise ValueError("containment_join over several levels or hot blocks supports how='left' or 'inner'")
    outcols = [*left.columns, *right_cols.values()]
    calm, crowded = ([lv for lv, most in sorted(levels.items()) if (most > bound) == hot] for hot in (False, True))
    parts = []
    if calm:        # all levels in one join: a left row is copied to its block on each
        lf = left.withColumn("_llv", F.explode(F.array(*[F.lit(lv) for lv in calm])))
        lf = lf.withColumn("_lb", F.floor(F.col(x) / (float(bucket_width) * F.pow(F.lit(2.0), F.col("_llv")))))
        rf = r.filter(F.col("_lv").isin(calm))
        cond = _key_match(lf, rf, keys) & (lf["_llv"] == rf["_lv"]) & (lf["_lb"] == rf["_rb"]) & (lf[x] >= rf["_lo"]) & (lf[x] <= rf["_hi"])
        parts.append(lf.join(rf, cond, "inner").select(*[lf[c] for c in left.columns], *[rf[c] for c in right_cols.values()]))
    for level in crowded:
        lf, rf, _ = at(level)
        on = [*[f"_k_{k}" for k in keys], "_b"]
        lc = lf.withColumns({**{f"_k_{k}": F.col(k) for k in keys}, "_b": F.col("_lb")}).drop("_lb")
        rc = rf.select(*[F.col(f"_r_{k}").alias(f"_k_{k}") for k in keys], F.col("_rb").alias("_b"), "_lo", "_hi", *right_cols.values())
        parts.append(skew_join(lc, rc, on, "inner", bound, order=(x, "_lo")).filter((F.col(x) >= F.col("_lo")) & (F.col(x) <= F.col("_hi"))).select(*outcols))
    matched = parts[0]
    for part in parts[1:]:
        matched = matched.unionByName(part)
    if how == "inner":
        return matched
    alone = left
    for level, most in sorted(levels.items()):
        left = alone
        lf, rf, cond = at(level)
        if most > bound:
            rf = _covered(rf, [*rkeys, "_rb"])
            cond = _key_match(lf, rf, keys) & (lf["_lb"] == rf["_rb"]) & (lf[x] >= rf["_lo"]) & (lf[x] <= rf["_hi"])
        alone = lf.join(rf, cond, "left_anti").drop("_lb")
    for src, dst in right_cols.items():
        alone = alone.withColumn(dst, F.lit(None).cast(right.schema[src].dataType))
    return matched.unionByName(alone)


def _covered(ranges: DataFrame, keys) -> DataFrame:
    """Ranges that cover together what ``ranges`` do: of equal starts the longest, of equal ends the longest of those."""
    longest = ranges.groupBy(*keys, "_lo").agg(F.max("_hi").alias("_hi"))
    return longest.groupBy(*keys, "_hi").agg(F.min("_lo").alias("_lo"))


def nearest_join(left: DataFrame, right: DataFrame, keys, left_ts: str = "date", right_ts: str = "date",
                 right_cols: dict | None = None, strategy: str = "auto", delta_col: str | None = None) -> DataFrame:
    """As-of join in both directions: each left row takes the right row of the same
    keys at the least |dt| in whole seconds; ties go to the earlier right row, then
    to the smaller payload. Left rows without any right row keep nulls (J9, H5).

    Instead of pairing every left row with every right row of its key and
    ranking, right rows are collapsed to the earliest one per second, unioned
    with the left rows, and the nearest right row on each side is carried to the
    left rows with forward/backward fills over the key's time order. Work is
    linear in rows; the fill runs on the ``Series`` strategy (split for hot keys).
    """
    right_cols = dict(right_cols or {})
    payload = [F.col(right_ts).alias("_rts"), *[F.col(s).alias(d) for s, d in right_cols.items()]]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # a null key equals no other: those rows stay without a sample
    strangers, left, right = left.filter(~known), left.filter(known), right.filter(known)
    samples = (right.select(*keys, epoch_seconds(right_ts).alias("_s"), F.struct(*payload).alias("_p"))
               .groupBy(*keys, "_s").agg(F.min("_p").alias("_p")))
    lcols = left.columns
    lrows = left.select(*keys, epoch_seconds(left_ts).alias("_s"),
                        F.struct(*[F.col(c) for c in lcols]).alias("_left"))
    both = (samples.select(*keys, "_s", F.lit(0).alias("_side"), "_p", F.lit(None).cast(lrows.schema["_left"].dataType).alias("_left"))
            .unionByName(lrows.select(*keys, "_s", F.lit(1).alias("_side"),
                                      F.lit(None).cast(samples.schema["_p"].dataType).alias("_p"), "_left")))
    hit = F.when(F.col("_side") == 0, F.struct(F.col("_s").alias("s"), F.col("_p").alias("p")))
    # Order by (second, side): samples precede left rows of their second. Left rows tied on
    # (keys, second) get identical fills whatever their order, so no further tie-break is needed.
    series = Series(keys, ("_s", "_side"), strategy=strategy)
    filled = series.apply(both, _bwd=fill(hit, forward=True), _fwd=fill(hit, forward=False))
    bwd, fwd = F.col("_bwd"), F.col("_fwd")
    take_bwd = fwd.isNull() | (bwd.isNotNull() & ((F.col("_s") - bwd["s"]) <= (fwd["s"] - F.col("_s"))))
    best = F.when(take_bwd, bwd).otherwise(fwd)
    out = filled.filter(F.col("_side") == 1).withColumn("_best", best)
    sel = [F.col("_left")[c].alias(c) for c in lcols]
    sel += [F.col("_best")["p"][d].alias(d) for d in right_cols.values()]
    if delta_col:
        sel.append(F.abs(F.col("_s") - F.col("_best")["s"]).alias(delta_col))
    out = out.select(*sel)
    return out.unionByName(strangers.select(*lcols, *[F.lit(None).cast(out.schema[c].dataType).alias(c)
                                                      for c in out.columns[len(lcols):]]))
