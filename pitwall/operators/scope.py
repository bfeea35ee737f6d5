"""Session scoping and dimension enrichment.

Dimensions (sessions, drivers) are small in any realistic lake: a meeting has a
handful of sessions and a session a few dozen drivers. They are still only
broadcast behind an explicit row bound (``sized_broadcast``); above it the join
falls back to a shuffle join, which AQE can split when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from pitwall.session import BROADCAST_ROWS, SCOPE, conf_int

# Session keys of one scope are resolved to a literal list (for Parquet filter
# pushdown and partition pruning) only up to this many keys.
MAX_SCOPE_KEYS = 10_000
# A broadcast side's rows times its estimated row width.
BROADCAST_BYTES = 256 << 20


def row_width(df: DataFrame) -> int:
    """Upper estimate of a row's bytes: 16 for each fixed-size column, 256 for any other."""
    fixed = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
    return 16 + sum(16 if isinstance(f.dataType, fixed) else 256 for f in df.schema.fields)


def sized_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``BROADCAST_BYTES`` (rows by width), else ``df`` unchanged.

    The check reads at most one row more than the bound (``limit`` stops the scan early). The count is kept with
    the bound it was taken under, and only reused where that bound does not cut it short.
    """
    bound = max_rows if max_rows is not None else conf_int(df.sparkSession, BROADCAST_ROWS)
    bound = min(bound, BROADCAST_BYTES // row_width(df))
    kept = getattr(df, "_pitwall_rows", None)              # (bound, count) of this DataFrame object
    if kept is None or (kept[1] > kept[0] and kept[0] < bound):
        kept = df._pitwall_rows = (bound, df.limit(bound + 1).count())
    return F.broadcast(df) if kept[1] <= bound else df


def race_sessions(sessions: DataFrame, meeting_key: int, session_name: str = "Race") -> DataFrame:
    """Sessions of one meeting with one name (F1: conjunctive equality)."""
    return (sessions.filter((F.col("meeting_key") == meeting_key) & (F.col("session_name") == session_name))
            .select("session_key", "meeting_key"))


def scope_keys(sessions_f: DataFrame, key: str = "session_key") -> list | None:
    """Literal session keys of a filtered session dimension, or None when there are too many."""
    rows = sessions_f.select(key).distinct().limit(MAX_SCOPE_KEYS + 1).collect()
    if len(rows) > MAX_SCOPE_KEYS:
        return None
    return [r[0] for r in rows]


def runtime_scope(spark) -> bool:
    """Does the session ask for scopes as joins (``spark.pitwall.scope`` = ``runtime``) in place of literal keys?"""
    mode = spark.conf.get(SCOPE, "keys")
    if mode not in ("keys", "runtime"):
        raise ValueError(f"{SCOPE} is keys or runtime, not {mode!r}")
    return mode == "runtime"


def scope_to_session(fact: DataFrame, sessions_f: DataFrame, key: str = "session_key",
                     keys: list | None = None) -> DataFrame:
    """Inner join of a fact table with the filtered session dimension.

    When the scope resolves to at most ``MAX_SCOPE_KEYS`` keys the semi-join is
    an ``isin`` filter on the fact, which Parquet row groups and ``session_key``
    partitions outside the scope are pruned by; otherwise it is a left-semi
    join with the (size-checked) session keys.

    With ``spark.pitwall.scope`` = ``runtime`` no key comes to the driver: it is
    always that semi-join, and on a table partitioned by ``key`` Spark prunes
    the partitions with the dimension's rows while the query runs.
    """
    if not runtime_scope(fact.sparkSession):
        keys = keys if keys is not None else scope_keys(sessions_f, key)
        if keys is not None:       # the literal list is exactly the semi-join
            return fact.filter(F.col(key).isin(keys))
    return fact.join(sized_broadcast(sessions_f.select(key).distinct()), key, "left_semi")


def one_row_per_driver(drivers: DataFrame, key: str = "driver_number",
                       cols=("full_name", "team_name")) -> DataFrame:
    """Deterministic de-duplication on ``key``: the smallest (cols...) tuple wins.

    A partial ``min(struct)`` aggregate, so a driver present in many sessions is
    combined map-side instead of shuffled whole.
    """
    picked = drivers.groupBy(key).agg(F.min(F.struct(*cols)).alias("_pick"))
    return picked.select(key, *[F.col("_pick")[c].alias(c) for c in cols])


def session_drivers(drivers: DataFrame, sessions_f: DataFrame | None = None, meeting_key: int | None = None,
                    cols=("full_name", "team_name"), keys: list | None = None) -> DataFrame:
    """Driver dimension restricted to the scoped sessions (or a meeting, or unscoped), one row per driver."""
    d = drivers
    if sessions_f is not None:
        d = scope_to_session(d, sessions_f, keys=keys)
    if meeting_key is not None:
        d = d.filter(F.col("meeting_key") == meeting_key)
    return one_row_per_driver(d.select("driver_number", *cols), "driver_number", cols)


def with_driver(fact: DataFrame, drivers_dim: DataFrame, on: str = "driver_number",
                how: str = "inner") -> DataFrame:
    """Attach driver attributes."""
    return fact.join(sized_broadcast(drivers_dim), on, how)


def as_role(dim: DataFrame, mapping: dict) -> DataFrame:
    """Role-playing dimension: the same table under role-specific names."""
    return dim.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def left_join_renamed(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left equi-join on differently named keys; facts without a dimension row stay."""
    d = sized_broadcast(dim)
    return fact.join(d, fact[fact_key] == d[dim_key], "left")
