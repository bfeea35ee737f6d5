"""Registered queries: one per operator family and one per race analysis.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the driver's test tables
(directly, or through the race-table adapter) and always over whole tables.
``ORACLE[name]`` is the same query as DuckDB SQL over the raw tables, with the
adapter written as CTEs. Column names match one to one.

Oracle parity rules (see the survey's Spark/DuckDB notes):
* epoch seconds are floored (``SEC``), rounding goes through the decimal text of
  the double (``R``), ascending orders say ``NULLS FIRST``;
* integer aggregates are cast to BIGINT, ranks to INTEGER;
* a NaN/inf correlation (constant input) is NULL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.functions.exprs import (
    LIMBS, arg_max_of, arg_min_of, bin_floor, order_free_corr, drs_open, drs_weight, guarded_pct, half_up, safe_corr, step_change,
)
from pitwall.operators.aggs import avg_if, count_if, dedupe_ordered, negative_sum, positive_sum
from pitwall.operators.joins import containment_join, join_on_time_bucket, nearest_join, proximity_join
from pitwall.operators.scope import (
    as_role, left_join_renamed, race_sessions, scope_to_session, session_drivers, with_driver,
)
from pitwall.operators.series import Series, first, lag, last, lead, rolling, row_number, running, whole
from pitwall.operators.skew import skew_join
from pitwall.operators.topn import ranks, top_n
from pitwall.plans import race
from pitwall.sources import infer
from pitwall.sources.ingest import apply_types
from pitwall.sources.testdata import RACE_CTES, LazyTables, cents, read

# ---- scope of the registered race queries on the driver data -------------------------
MEETING = 1265                      # session 0 of the adapter, a race
TEAM = "BUILDING"
TEAMS = ("BUILDING", "MACHINERY")
DRIVERS = (16, 44)
TOL_SECONDS = 43200                 # events are sparse: +-12 h instead of +-30 s
BUCKET_SECONDS = 86400              # one day instead of one second
SPLIT = "split:64"                  # hot-key strategy forced with 64-row chunks
ISOLATE = "auto:150"                # keys above 150 rows split, the rest windowed

D = "driver_number"
DS = ("driver_number", "session_key")


def SEC(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def R(x: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def NANNULL(x: str) -> str:
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


def CORR(a: str, b: str) -> str:
    return NANNULL(f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))")


def XCORR(a: str, b: str) -> str:
    """Correlation from exact integer moments (same formula as ``exact_corr``)."""
    x, y = f"CAST({a} AS HUGEINT)", f"CAST({b} AS HUGEINT)"
    n = f"CAST(count({x} * {y}) AS HUGEINT)"
    cov = f"CAST({n} * sum({x} * {y}) - sum({x} * CASE WHEN {y} IS NOT NULL THEN 1 END) * sum({y} * CASE WHEN {x} IS NOT NULL THEN 1 END) AS DOUBLE)"
    vx = f"CAST({n} * sum({x} * {x} * CASE WHEN {y} IS NOT NULL THEN 1 END) - sum({x} * CASE WHEN {y} IS NOT NULL THEN 1 END) * sum({x} * CASE WHEN {y} IS NOT NULL THEN 1 END) AS DOUBLE)"
    vy = f"CAST({n} * sum({y} * {y} * CASE WHEN {x} IS NOT NULL THEN 1 END) - sum({y} * CASE WHEN {x} IS NOT NULL THEN 1 END) * sum({y} * CASE WHEN {x} IS NOT NULL THEN 1 END) AS DOUBLE)"
    return NANNULL(f"{cov} / sqrt({vx} * {vy})")


def _in(vals) -> str:
    return ", ".join(repr(v) for v in vals)


SCOPE_SQL = f"""
sess AS (SELECT session_key FROM sessions WHERE meeting_key = {MEETING} AND session_name = 'Race'),
dim AS (SELECT driver_number, full_name, team_name FROM (
          SELECT driver_number, full_name, team_name,
                 row_number() OVER (PARTITION BY driver_number ORDER BY full_name, team_name) AS rn
          FROM drivers WHERE session_key IN (SELECT session_key FROM sess)) WHERE rn = 1),
dimm AS (SELECT driver_number, full_name, team_name FROM (
          SELECT driver_number, full_name, team_name,
                 row_number() OVER (PARTITION BY driver_number ORDER BY full_name, team_name) AS rn
          FROM drivers WHERE meeting_key = {MEETING}) WHERE rn = 1)"""


def W(body: str) -> str:
    """Adapter and scope CTEs, then the query's own CTEs (if any) and its SELECT."""
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return f"WITH {RACE_CTES}, {SCOPE_SQL}{sep}{body}"


def _t(spark, sf):
    return LazyTables(spark, sf)


QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ============================================================ projections and predicates

@register("project_filter", f"""
SELECT o.o_orderkey, o.o_custkey AS customer, {R('o.o_totalprice * 1.1', 2)} AS price_up,
       o.o_totalprice AS total, CAST(o.o_orderkey AS INTEGER) AS key_int, {MEETING} AS meeting_key
FROM orders o
WHERE o.o_orderstatus = 'F' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o.o_totalprice > 1000 AND o.o_custkey IS NOT NULL""")
def project_filter(spark, sf):
    """P1-P5, F1-F3, F4, F5, X8-X10."""
    o = read(spark, sf, "orders").alias("o")
    df = (o.filter((F.col("o.o_orderstatus") == "F") & F.col("o.o_orderpriority").isin("1-URGENT", "2-HIGH"))
          .filter(F.col("o.o_totalprice") > 1000).filter(F.col("o.o_custkey").isNotNull())
          .select(F.col("o.o_orderkey"), F.col("o.o_custkey").alias("customer"),
                  half_up(F.col("o.o_totalprice") * 1.1, 2).alias("price_up"),
                  F.struct(F.col("o.o_orderdate").alias("d"), F.col("o.o_totalprice").alias("p")).alias("s"),
                  F.col("o.o_orderkey").cast("int").alias("key_int"), F.lit(MEETING).alias("meeting_key")))
    return df.withColumn("total", F.col("s.p")).drop("s").select(
        "o_orderkey", "customer", "price_up", "total", "key_int", "meeting_key")


# ====================================================================== joins

@register("scope_inner_join", W(f"""
l AS (SELECT * FROM laps WHERE session_key IN (SELECT session_key FROM sess))
SELECT l.session_key, l.driver_number, l.lap_number, l.lap_duration, d.full_name AS drv_name, d.team_name AS drv_team
FROM l JOIN dim d ON l.driver_number = d.driver_number"""))
def scope_inner_join(spark, sf):
    """J1 session scoping, J2 driver enrichment, J5 role-playing dimension."""
    t = _t(spark, sf)
    s = race_sessions(t["sessions"], MEETING)
    dim = as_role(session_drivers(t["drivers"], sessions_f=s),
                  {D: D, "full_name": "drv_name", "team_name": "drv_team"})
    laps = scope_to_session(t["laps"], s).select("session_key", D, "lap_number", "lap_duration")
    return with_driver(laps, dim)


@register("session_drivers", W("SELECT * FROM dim"))
def session_drivers_q(spark, sf):
    """J3 + A13: dimension restricted to a session, one deterministic row per driver."""
    t = _t(spark, sf)
    return session_drivers(t["drivers"], sessions_f=race_sessions(t["sessions"], MEETING))


@register("left_join_renamed", """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c.c_custkey = o.o_custkey""")
def left_join_renamed_q(spark, sf):
    """Left equi-join on differently named keys."""
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    o = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select("o_custkey", "o_orderkey",
                                                                                 "o_totalprice")
    return left_join_renamed(c, o, "c_custkey", "o_custkey").select("c_custkey", "c_name", "o_orderkey",
                                                                     "o_totalprice")


@register("time_bucket_join", W(f"""
SELECT c.session_key, c.driver_number, c.date, c.speed,
       CAST(floor({SEC('c.date')} / {BUCKET_SECONDS}) AS BIGINT) AS date_sec, l.x, l.y
FROM car_data c LEFT JOIN location l
  ON c.session_key = l.session_key AND c.driver_number = l.driver_number
 AND floor({SEC('c.date')} / {BUCKET_SECONDS}) = floor({SEC('l.date')} / {BUCKET_SECONDS})"""))
def time_bucket_join(spark, sf):
    """J6 + X4: left join on (keys, time bucket), n:m per bucket."""
    t = _t(spark, sf)
    car = t["car_data"].select("session_key", D, "date", "speed")
    return join_on_time_bucket(car, t["location"], ["session_key", D], right_cols={"x": "x", "y": "y"},
                               seconds=BUCKET_SECONDS)


HOT_BUCKET = 150                    # rows of a key and bucket above which the hot variants split it

SKEWED_SQL = W(f"""
c AS (SELECT session_key, driver_number, date, speed FROM car_data),
r AS (SELECT CASE WHEN x % 3 = 0 THEN 0 ELSE session_key END AS session_key,
             CASE WHEN x % 3 = 0 THEN 1 ELSE driver_number END AS driver_number,
             CASE WHEN x % 3 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE date END AS date, x, y FROM location),
l AS (SELECT session_key, driver_number, date, speed FROM c
      UNION ALL SELECT 0, 1, TIMESTAMP '2024-01-02 00:00:00', -1 UNION ALL SELECT 0, NULL, date, speed FROM c WHERE speed = 0)
SELECT l.session_key, l.driver_number, l.date, l.speed, CAST(floor({SEC('l.date')} / {BUCKET_SECONDS}) AS BIGINT) AS date_sec, r.x, r.y
FROM l LEFT JOIN r ON l.session_key = r.session_key AND l.driver_number = r.driver_number
 AND floor({SEC('l.date')} / {BUCKET_SECONDS}) = floor({SEC('r.date')} / {BUCKET_SECONDS})""")


def skewed_sides(spark, sf):
    """Car samples (some without a driver), and all locations with a third of them moved to one key and instant."""
    t = _t(spark, sf)
    moved, at = F.col("x") % 3 == 0, F.lit("2024-01-02 00:00:00").cast(t["location"].schema["date"].dataType)
    right = t["location"].select(F.when(moved, 0).otherwise(F.col("session_key")).cast("int").alias("session_key"),
                                 F.when(moved, 1).otherwise(F.col(D)).cast("bigint").alias(D),
                                 F.when(moved, at).otherwise(F.col("date")).alias("date"), "x", "y")
    car = t["car_data"].select("session_key", D, "date", "speed")
    one = spark.range(1).select(F.lit(0).alias("session_key"), F.lit(1).cast("bigint").alias(D), at.alias("date"), F.lit(-1).cast("bigint").alias("speed"))
    lost = car.filter(F.col("speed") == 0).select(F.lit(0).alias("session_key"), F.lit(None).cast("bigint").alias(D), "date", "speed")
    return car.unionByName(one).unionByName(lost), right


@register("time_bucket_join_hot", SKEWED_SQL)
def time_bucket_join_hot(spark, sf):
    """J6 with a third of all right rows on one key and bucket, and many left rows without a key: both are dealt over cells."""
    left, right = skewed_sides(spark, sf)
    return join_on_time_bucket(left, right, ["session_key", D], right_cols={"x": "x", "y": "y"}, seconds=BUCKET_SECONDS, hot_rows=HOT_BUCKET)


@register("skew_join", """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, l.l_linenumber, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_custkey = l.l_suppkey""")
def skew_join_q(spark, sf):
    """An n:m left join over whole tables whose right keys are nearly all hot; customers without a supplier of their number stay."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("o_custkey"), "l_linenumber", "l_quantity", "l_orderkey")
    return skew_join(o, li, ["o_custkey"], hot_rows=HOT_BUCKET).drop("l_orderkey")


TOP_SQL = W("""
SELECT session_key, driver_number, date, speed, rpm, throttle,
       CAST(row_number() OVER (PARTITION BY driver_number, session_key ORDER BY speed DESC, date, rpm, throttle) AS INTEGER) AS place
FROM car_data QUALIFY place <= 3""")


def _top(spark, sf, strategy):
    car = _t(spark, sf)["car_data"].select("session_key", D, "date", "speed", "rpm", "throttle")
    return top_n(car, DS, (F.col("speed").desc(), "date", "rpm", "throttle"), 3, "place", strategy=strategy)


@register("top_n_per_group", TOP_SQL)
def top_n_per_group(spark, sf):
    """The three fastest samples of every driver and session; cut before the exchange."""
    return _top(spark, sf, "auto")


@register("top_n_chunks", TOP_SQL)
def top_n_chunks(spark, sf):
    """F6 in two levels: the best of every 32-row chunk, then of the chunks."""
    return _top(spark, sf, "chunks:32")


@register("top_n_ties", W("""
SELECT session_key, driver_number, lap_number, duration_sector_2,
       CAST(rank() OVER (PARTITION BY session_key ORDER BY duration_sector_2 DESC NULLS LAST, lap_number) AS INTEGER) AS place
FROM laps QUALIFY place <= 10"""))
def top_n_ties(spark, sf):
    """F6 with ties: all laps of a session whose rank is ten at most, from chunks of 64 rows of hot sessions."""
    laps = _t(spark, sf)["laps"].select("session_key", D, "lap_number", "duration_sector_2")
    return top_n(laps, ("session_key",), (F.col("duration_sector_2").desc(), "lap_number"), 10, "place", ties="rank", strategy="chunks:64")


RANKS_SQL = W("""
SELECT session_key, driver_number, lap_number, lap_duration,
       CAST(rank() OVER (PARTITION BY session_key ORDER BY lap_duration NULLS FIRST) AS INTEGER) AS field_rank,
       CAST(dense_rank() OVER (PARTITION BY session_key ORDER BY lap_duration NULLS FIRST) AS INTEGER) AS field_dense
FROM laps""")


def _ranks(spark, sf, strategy):
    laps = _t(spark, sf)["laps"].select("session_key", D, "lap_number", "lap_duration")
    return ranks(laps, ("session_key",), ("lap_duration",), dense="field_dense", rank="field_rank", strategy=strategy)


register("field_ranks", RANKS_SQL)(lambda spark, sf: _ranks(spark, sf, "auto"))
register("field_ranks_split", RANKS_SQL)(lambda spark, sf: _ranks(spark, sf, SPLIT))


@register("proximity_join_hot", W(f"""
i AS (SELECT driver_number % 4 AS driver_number, 0 AS session_key, date, gap_to_leader FROM intervals),
p AS (SELECT driver_number % 5 AS driver_number, 0 AS session_key, date, lap_number FROM pit WHERE lap_number % 4 = 0)
SELECT p.session_key, p.driver_number, p.date, p.lap_number, i.date AS i_date, i.gap_to_leader AS i_gap
FROM p LEFT JOIN i
  ON p.session_key = i.session_key AND p.driver_number = i.driver_number
 AND abs({SEC('i.date')} - {SEC('p.date')}) < 3600"""))
def proximity_join_hot(spark, sf):
    """J7 with few, hot keys: buckets above a bound take the dealt route, the others the one outer join."""
    t = _t(spark, sf)
    i = t["intervals"].select((F.col(D) % 4).alias(D), F.lit(0).alias("session_key"), "date", "gap_to_leader")
    pit = t["pit"].filter(F.col("lap_number") % 4 == 0).select(F.lit(0).alias("session_key"), (F.col(D) % 5).alias(D), "date", "lap_number")
    return proximity_join(pit, i, DS, 3600, right_cols={"date": "i_date", "gap_to_leader": "i_gap"}, hot_rows=8)


@register("proximity_join", W(f"""
SELECT p.session_key, p.driver_number, p.date, p.lap_number, i.date AS i_date, i.gap_to_leader AS i_gap
FROM pit p LEFT JOIN intervals i
  ON p.session_key = i.session_key AND p.driver_number = i.driver_number
 AND abs({SEC('i.date')} - {SEC('p.date')}) < {TOL_SECONDS}"""))
def proximity_join_q(spark, sf):
    """|dt| < tol, strict, left join."""
    t = _t(spark, sf)
    pit = t["pit"].select("session_key", D, "date", "lap_number")
    return proximity_join(pit, t["intervals"], DS, TOL_SECONDS,
                          right_cols={"date": "i_date", "gap_to_leader": "i_gap"})


@register("containment_join", W("""
SELECT l.session_key, l.driver_number, l.lap_number, l.lap_duration, s.stint_number, s.compound
FROM laps l LEFT JOIN stints s
  ON l.driver_number = s.driver_number AND l.session_key = s.session_key
 AND l.lap_number >= s.lap_start AND l.lap_number <= s.lap_end"""))
def containment_join_q(spark, sf):
    """Lo <= x <= hi, inclusive, left join (laps in no stint keep nulls)."""
    t = _t(spark, sf)
    laps = t["laps"].select("session_key", D, "lap_number", "lap_duration")
    return containment_join(laps, t["stints"], DS, "lap_number", "lap_start", "lap_end",
                            right_cols={"stint_number": "stint_number", "compound": "compound"})


@register("containment_join_hot", W("""
s AS (SELECT 0 AS k, lap_start + driver_number % 7 AS lo, lap_end + driver_number % 90 AS hi, driver_number, stint_number FROM stints WHERE session_key = 1),
l AS (SELECT driver_number % 2 AS k, lap_number * 2 AS at, lap_duration FROM laps WHERE session_key = 2 AND lap_number % 5 = 0)
SELECT l.k, l.at, l.lap_duration, s.driver_number AS stint_driver, s.stint_number FROM l LEFT JOIN s ON l.k = s.k AND l.at >= s.lo AND l.at <= s.hi"""))
def containment_join_hot(spark, sf):
    """J8 with all ranges on one key and few blocks, over several levels: hot blocks are dealt over cells."""
    t = _t(spark, sf)
    s = t["stints"].filter(F.col("session_key") == 1).select(
        F.lit(0).cast("bigint").alias("k"), (F.col("lap_start") + F.col(D) % 7).alias("lo"), (F.col("lap_end") + F.col(D) % 90).alias("hi"), D, "stint_number")
    laps = t["laps"].filter((F.col("session_key") == 2) & (F.col("lap_number") % 5 == 0)).select(
        (F.col(D) % 2).alias("k"), (F.col("lap_number") * 2).alias("at"), "lap_duration")
    return containment_join(laps, s, ["k"], "at", "lo", "hi", right_cols={D: "stint_driver", "stint_number": "stint_number"}, hot_rows=8)


NEAREST_SQL = W(f"""
j AS (SELECT o.session_key, o.overtaking_driver_number, o.date, c.date AS car_date, c.speed AS car_speed,
             c.drs AS car_drs,
             row_number() OVER (PARTITION BY o.session_key, o.overtaking_driver_number, o.date
                                ORDER BY abs({SEC('o.date')} - {SEC('c.date')}) NULLS FIRST, c.date NULLS FIRST,
                                         c.drs NULLS FIRST, c.speed NULLS FIRST) AS rn
      FROM overtakes o LEFT JOIN car_data c
        ON o.overtaking_driver_number = c.driver_number AND o.session_key = c.session_key)
SELECT session_key, overtaking_driver_number, date, car_date, car_drs, car_speed FROM j WHERE rn = 1""")


def _nearest(spark, sf, strategy):
    t = _t(spark, sf)
    car = t["car_data"].select(F.col(D).alias("overtaking_driver_number"), "session_key", "date", "drs", "speed")
    return nearest_join(t["overtakes"], car, ("overtaking_driver_number", "session_key"),
                        right_cols={"date": "car_date", "drs": "car_drs", "speed": "car_speed"},
                        strategy=strategy).select("session_key", "overtaking_driver_number", "date", "car_date",
                                                  "car_drs", "car_speed")


@register("nearest_join", NEAREST_SQL)
def nearest_join_q(spark, sf):
    """Nearest sample in either direction, ties to the earlier sample."""
    return _nearest(spark, sf, "auto")


@register("nearest_join_split", NEAREST_SQL)
def nearest_join_split(spark, sf):
    """J9 on the hot-key (split) strategy."""
    return _nearest(spark, sf, SPLIT)


# ================================================================ aggregation

@register("typed_ingest", """
SELECT l_orderkey, l_linenumber AS whole, true AS fraction_is_null, CAST(l_quantity AS INTEGER) AS quantity, l_tax AS tax,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS flagged,
       CASE WHEN l_returnflag = 'N' THEN 'N' END AS flagged_marker
FROM lineitem""")
def typed_ingest(spark, sf):
    """Declared types applied to the text forms of a whole table; whole numbers written with a fraction, markers."""
    li = read(spark, sf, "lineitem")
    texts = li.select(
        F.col("l_orderkey").cast("string"), F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("whole"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")).alias("part"), F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_tax").cast("string").alias("tax"),
        F.when(F.col("l_returnflag") == "N", "N").otherwise(F.col("l_linenumber").cast("string")).alias("flagged"))
    out = apply_types(texts, {"l_orderkey": "bigint", "whole": "int", "part": "int", "quantity": "int", "tax": "double", "flagged": "int"},
                      marked=("flagged",))
    return out.select("l_orderkey", "whole", F.col("part").isNull().alias("fraction_is_null"), "quantity", "tax", "flagged", "flagged_marker")


#: Text columns of a whole table, by name, in Spark's and DuckDB's SQL alike.
TEXT_COLUMNS = {
    "whole": "CAST(l_orderkey AS STRING)", "large": "CAST(l_orderkey * 10000000000 AS STRING)", "fraction": "CAST(l_tax AS STRING)",
    "price": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)", "padded": "concat(' 00', CAST(l_linenumber AS STRING), '.50 ')",
    "scientific": "concat(CAST(l_linenumber AS STRING), 'e', CAST(l_suppkey % 7 AS STRING))", "day": "substring(CAST(l_shipdate AS STRING), 1, 10)",
    "instant": "concat(substring(CAST(l_shipdate AS STRING), 1, 10), 'T0', CAST(l_linenumber AS STRING), ':00:00.5Z')",
    "mixed_days": "CASE WHEN l_linenumber = 1 THEN substring(CAST(l_shipdate AS STRING), 1, 10) ELSE concat(substring(CAST(l_shipdate AS STRING), 1, 10), ' 10:11') END",
    "not_a_day": "'2024-02-30'", "flag": "CASE WHEN l_returnflag = 'R' THEN 'TRUE' ELSE 'false' END",
    "marked": "CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN '+1 LAP' ELSE CAST(l_suppkey AS STRING) END",
    "word": "l_returnflag", "blank": "CASE WHEN l_linenumber = 2 THEN '  ' WHEN l_linenumber = 3 THEN '' END", "gaps": "CASE WHEN l_linenumber < 3 THEN '42' END",
}


def _inferred_sql() -> str:
    parts = []
    for name, text in TEXT_COLUMNS.items():
        count = lambda cond: f"count(CASE WHEN t <> '' AND {cond} THEN 1 END)"
        form = lambda pattern: f"regexp_matches(t, '{pattern}')"
        parts.append(f"""
SELECT '{name}' AS "column", count(*) AS rows, {count('true')} AS filled,
  {count(form(infer.WHOLE) + ' AND TRY_CAST(t AS INTEGER) IS NOT NULL')} AS ints,
  {count(form(infer.WHOLE) + ' AND TRY_CAST(t AS BIGINT) IS NOT NULL')} AS longs,
  {count(form(infer.NUMBER))} AS numbers, {count(form(infer.SCIENTIFIC) + ' AND TRY_CAST(t AS DOUBLE) IS NOT NULL')} AS doubles,
  {count(form(infer.DATE) + ' AND TRY_CAST(t AS DATE) IS NOT NULL')} AS dates,
  {count(form(infer.TIMESTAMP) + ' AND TRY_CAST(t AS TIMESTAMPTZ) IS NOT NULL')} AS timestamps, {count(form(infer.BOOLEAN))} AS booleans,
  coalesce(max(CASE WHEN {form(infer.NUMBER)} THEN length(regexp_extract(t, '^[+-]?0*([0-9]*)', 1)) END), 0) AS digits,
  coalesce(max(CASE WHEN {form(infer.NUMBER)} THEN length(regexp_extract(t, '[.]([0-9]*?)0*$', 1)) END), 0) AS scale
FROM (SELECT trim({text}) AS t FROM lineitem)""")
    return "WITH m AS (" + " UNION ALL ".join(parts) + """),
k AS (SELECT *, greatest(ints, longs, numbers, doubles, booleans, dates, timestamps) AS most FROM m)
SELECT "column", rows, filled,
  CASE WHEN filled = 0 THEN 'string' WHEN ints = filled THEN 'int' WHEN longs = filled THEN 'bigint'
       WHEN numbers = filled AND digits + scale <= 38 THEN 'decimal(' || greatest(digits + scale, 1) || ',' || scale || ')'
       WHEN doubles = filled THEN 'double' WHEN booleans = filled THEN 'boolean' WHEN dates = filled THEN 'date'
       WHEN timestamps = filled THEN 'timestamp' ELSE 'string' END AS type,
  CASE WHEN most = 0 THEN NULL WHEN ints = most THEN 'int' WHEN longs = most THEN 'bigint' WHEN numbers = most THEN 'number'
       WHEN doubles = most THEN 'double' WHEN booleans = most THEN 'boolean' WHEN dates = most THEN 'date' ELSE 'timestamp' END AS nearest,
  filled - most AS lost
FROM k"""


@register("inferred_types", _inferred_sql())
def inferred_types(spark, sf):
    """Types of a whole table's text form, joined per column in one partial aggregate, with what the nearest kind would lose."""
    li = read(spark, sf, "lineitem")
    return infer.inferred(li.select(*[F.expr(e).alias(c) for c, e in TEXT_COLUMNS.items()]))


@register("group_stats", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty, avg(l_quantity) AS avg_qty,
       min(l_discount) AS min_disc, max(l_discount) AS max_disc,
       CAST(sum(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS high_tax,
       avg(CAST(round(l_extendedprice * 100) AS BIGINT)) AS avg_price_cents
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_stats(spark, sf):
    """A1-A5: group-by, avg, min/max, count(*), sum of a flag."""
    li = read(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"), F.avg("l_quantity").alias("avg_qty"),
        F.min("l_discount").alias("min_disc"), F.max("l_discount").alias("max_disc"),
        F.sum(F.when(F.col("l_tax") > 0.05, 1).otherwise(0)).alias("high_tax"),
        F.avg(cents(F.col("l_extendedprice"))).alias("avg_price_cents"))


@register("conditional_aggs", f"""
SELECT user_id, count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
       avg(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END) AS avg_purchase,
       CAST(sum(CASE WHEN CAST(round(value * 100) AS BIGINT) - 1000 > 0
                     THEN CAST(round(value * 100) AS BIGINT) - 1000 ELSE 0 END) AS BIGINT) AS above,
       CAST(sum(CASE WHEN CAST(round(value * 100) AS BIGINT) - 1000 < 0
                     THEN CAST(round(value * 100) AS BIGINT) - 1000 ELSE 0 END) AS BIGINT) AS below,
       sum(CASE WHEN event_id % 16 IN (10, 12, 14) THEN 1 WHEN event_id % 16 = 8 THEN 0.5 ELSE 0 END)::DOUBLE AS drs_weight,
       {R("CASE WHEN count(*) > 0 THEN count(CASE WHEN event_type = 'error' THEN 1 END) / count(*) * 100 ELSE 0 END", 1)} AS error_pct
FROM events GROUP BY user_id""")
def conditional_aggs(spark, sf):
    """A6 count-if, A7 avg-if, A8 positive/negative parts, X6 chained when, X7 guarded percentage."""
    e = read(spark, sf, "events").withColumn("v", cents(F.col("value")) - 1000)
    g = e.groupBy("user_id").agg(
        count_if(F.col("event_type") == "click").alias("clicks"),
        avg_if(F.col("event_type") == "purchase", cents(F.col("value"))).alias("avg_purchase"),
        positive_sum("v").alias("above"), negative_sum("v").alias("below"),
        F.sum(drs_weight(F.col("event_id") % 16)).alias("drs_weight"),
        count_if(F.col("event_type") == "error").alias("_err"), F.count(F.lit(1)).alias("_n"))
    return g.withColumn("error_pct", guarded_pct("_err", "_n", 1)).drop("_err", "_n")


@register("arg_extrema", W("""
SELECT driver_number, session_key,
       struct_extract(max(CASE WHEN st_speed IS NOT NULL THEN {'v': st_speed, 'p': lap_number} END), 'p') AS lap_best_speed,
       struct_extract(min(CASE WHEN duration_sector_3 IS NOT NULL THEN {'v': duration_sector_3, 'p': lap_number} END), 'p') AS lap_best_s3
FROM laps GROUP BY driver_number, session_key"""))
def arg_extrema(spark, sf):
    """A9 arg-max (ties -> larger lap), A10 arg-min over non-null values (ties -> smaller lap)."""
    t = _t(spark, sf)
    return t["laps"].groupBy(D, "session_key").agg(
        arg_max_of(t["laps"], "st_speed", "lap_number").alias("lap_best_speed"),
        arg_min_of(t["laps"], "duration_sector_3", "lap_number").alias("lap_best_s3"))


@register("safe_corr", W(f"""
SELECT driver_number, session_key, {R(CORR('rpm', 'speed'), 6)} AS rpm_speed_corr,
       {CORR('throttle * 0', 'speed')} AS constant_corr, count(*) AS n
FROM car_data GROUP BY driver_number, session_key"""))
def safe_corr_q(spark, sf):
    """Guarded Pearson correlation; a constant input gives NULL instead of an error."""
    t = _t(spark, sf)
    return t["car_data"].groupBy(D, "session_key").agg(
        half_up(safe_corr("rpm", "speed"), 6).alias("rpm_speed_corr"),
        safe_corr(F.col("throttle") * 0, "speed").alias("constant_corr"), F.count(F.lit(1)).alias("n"))


@register("dedupe_ordered", """
SELECT user_id, event_type, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id, value, props) AS rn FROM events)
WHERE rn = 1""")
def dedupe_ordered_q(spark, sf):
    """One row per (user, type): the earliest under a declared order."""
    e = read(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value", "props")
    return dedupe_ordered(e, ("user_id", "event_type"), ("ts", "event_id", "value", "props")).drop("props")


# ============================================================== series windows

def _series_query(name, sql, build, split_too=True, isolate_too=False):
    register(name, sql)(lambda spark, sf: build(spark, sf, "auto"))
    if split_too:
        register(f"{name}_split", sql)(lambda spark, sf: build(spark, sf, SPLIT))
    if isolate_too:
        register(f"{name}_isolated", sql)(lambda spark, sf: build(spark, sf, ISOLATE))


def _peer_delta(spark, sf, strategy):
    t = _t(spark, sf)
    laps = t["laps"].filter(F.col("lap_duration").isNotNull()).select("session_key", D, "lap_number", "lap_duration")
    df = Series(("session_key", "lap_number"), (), strategy=strategy).apply(laps, peer_avg=whole("avg", "lap_duration"))
    df = df.withColumn("delta", F.col("lap_duration") - F.col("peer_avg"))
    return df.filter(F.col("delta") > 0)      # laps slower than the field: a filter after the field-wide value (F7)


_series_query("peer_delta", W("""
l AS (SELECT session_key, driver_number, lap_number, lap_duration FROM laps WHERE lap_duration IS NOT NULL),
w AS (SELECT *, avg(lap_duration) OVER (PARTITION BY session_key, lap_number) AS peer_avg FROM l)
SELECT *, lap_duration - peer_avg AS delta FROM w WHERE lap_duration - peer_avg > 0"""), _peer_delta)


def _rolling_trailing(spark, sf, strategy):
    t = _t(spark, sf)
    laps = t["laps"].select("session_key", D, "lap_number", "lap_duration")
    return Series(DS, ("lap_number",), strategy=strategy).apply(
        laps, rolling6=rolling("avg", "lap_duration", 5), rolling11_n=rolling("count", "lap_duration", 10))


_series_query("rolling_trailing", W("""
SELECT session_key, driver_number, lap_number, lap_duration,
       avg(lap_duration) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                               ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling6,
       count(lap_duration) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                                 ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS rolling11_n
FROM laps"""), _rolling_trailing, isolate_too=True)


def _rolling_centered(spark, sf, strategy):
    t = _t(spark, sf)
    car = t["car_data"].select("session_key", D, "date", "speed", "rpm")
    return Series(DS, ("date",), strategy=strategy).apply(
        car, smoothed_speed=rolling("avg", "speed", 8, 8), smoothed_rpm=rolling("avg", "rpm", 5, 5))


_series_query("rolling_centered", W("""
SELECT session_key, driver_number, date, speed, rpm,
       avg(speed) OVER (PARTITION BY driver_number, session_key ORDER BY date
                        ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS smoothed_speed,
       avg(rpm) OVER (PARTITION BY driver_number, session_key ORDER BY date
                      ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS smoothed_rpm
FROM car_data"""), _rolling_centered)


def _rolling_flag(spark, sf, strategy):
    t = _t(spark, sf)
    car = t["car_data"].select("session_key", D, "date", "drs")
    return Series(DS, ("date",), strategy=strategy).apply(
        car, drs_in_window=rolling("max", F.when(drs_open("drs"), 1).otherwise(0), 15, 15))


_series_query("rolling_flag", W("""
SELECT session_key, driver_number, date, drs,
       max(CASE WHEN drs IN (10, 12, 14) THEN 1 ELSE 0 END) OVER (PARTITION BY driver_number, session_key ORDER BY date
                      ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS drs_in_window
FROM car_data"""), _rolling_flag)


def _running_total(spark, sf, strategy):
    t = _t(spark, sf)
    ov = Series(("overtaking_driver_number", "session_key"), ("date",), strategy=strategy).apply(
        t["overtakes"], cumulative=running("sum", F.lit(1)), seen=running("count", "date"))
    return ov.groupBy("overtaking_driver_number", "session_key").agg(
        F.max("cumulative").alias("total_overtakes"), F.max("seen").alias("seen"), F.count(F.lit(1)).alias("n"))


_series_query("running_total", W("""
w AS (SELECT *, sum(1) OVER (PARTITION BY overtaking_driver_number, session_key ORDER BY date
                             ROWS UNBOUNDED PRECEDING) AS c FROM overtakes)
SELECT overtaking_driver_number, session_key, CAST(max(c) AS BIGINT) AS total_overtakes, CAST(max(c) AS BIGINT) AS seen,
       count(*) AS n
FROM w GROUP BY overtaking_driver_number, session_key"""), _running_total)


def _limb_sums(sums: str) -> str:
    """The order-free sum of doubles v in SQL: ``sums`` is a window or group sum with a place for its argument."""
    return " + ".join(f"CAST({sums.format(f'l{k}')} AS DOUBLE) * {2.0 ** e!r}::DOUBLE" for k, e in enumerate(LIMBS))


def _limb_ctes() -> str:
    rest, out = "v", []
    for k, e in enumerate(LIMBS):
        out.append(f"r{k} AS (SELECT *, CAST(trunc({rest} * {2.0 ** -e!r}::DOUBLE) AS HUGEINT) AS l{k} FROM {f'r{k - 1}' if k else 'r'})")
        rest = f"({rest} - CAST(l{k} AS DOUBLE) * {2.0 ** e!r}::DOUBLE)"
    return ", ".join(out)


def _running_doubles(spark, sf, strategy):
    e = read(spark, sf, "events").select("user_id", "ts", "event_id", (F.col("value") / 7).alias("v"))
    return Series(("user_id",), ("ts", "event_id"), strategy=strategy).apply(
        e, upto=running("sum", "v"), total=whole("sum", "v"), mean=whole("avg", "v"))


_series_query("running_doubles", f"""
WITH r AS (SELECT user_id, ts, event_id, value / 7 AS v FROM events), {_limb_ctes()}
SELECT user_id, ts, event_id, v, {_limb_sums('sum({}) OVER w')} AS upto, {_limb_sums('sum({}) OVER (PARTITION BY user_id)')} AS total,
       ({_limb_sums('sum({}) OVER (PARTITION BY user_id)')}) / count(v) OVER (PARTITION BY user_id) AS mean
FROM r{len(LIMBS) - 1} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""", _running_doubles, isolate_too=True)


MOMENTS = {"sx": "x", "sy": "y", "sxx": "x * x", "syy": "y * y", "sxy": "x * y"}


def _moment_sql() -> str:
    """Limb sums of every moment, one CTE each, joined by group."""
    ctes, cols = [], []
    for name, e in MOMENTS.items():
        rest, last = "v", f"{name}_"
        ctes.append(f"{last} AS (SELECT g, {e} AS v FROM pairs)")
        for k, p in enumerate(LIMBS):
            ctes.append(f"{name}_{k} AS (SELECT *, CAST(trunc({rest} * {2.0 ** -p!r}::DOUBLE) AS HUGEINT) AS l{k} FROM {last})")
            rest, last = f"({rest} - CAST(l{k} AS DOUBLE) * {2.0 ** p!r}::DOUBLE)", f"{name}_{k}"
        ctes.append(f"{name}_sum AS (SELECT g, {_limb_sums('sum({})')} AS {name} FROM {last} GROUP BY g)")
        cols.append(f"{name}_sum")
    joins = cols[0] + "".join(f" JOIN {c} USING (g)" for c in cols[1:])
    return ", ".join(ctes) + f", moments AS (SELECT * FROM {joins} JOIN (SELECT g, count(*) AS n FROM pairs GROUP BY g) USING (g))"


@register("order_free_corr", f"""
WITH pairs AS (SELECT l_returnflag || l_linestatus AS g, l_extendedprice / 3 AS x, l_tax / 7 + l_quantity AS y FROM lineitem),
{_moment_sql()},
v AS (SELECT *, n * sxx - sx * sx AS vx, n * syy - sy * sy AS vy FROM moments)
SELECT g, CASE WHEN vx > 0 AND vy > 0 THEN (n * sxy - sx * sy) / sqrt(vx * vy) END AS corr, n AS corr_n FROM v""")
def order_free_corr_q(spark, sf):
    """Correlation of doubles from moments that do not depend on the order of rows."""
    li = read(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("g"), (F.col("l_extendedprice") / 3).alias("x"),
                                            (F.col("l_tax") / 7 + F.col("l_quantity")).alias("y"))
    return order_free_corr(li, ["g"], "x", "y")


def _full_frame(spark, sf, strategy):
    t = _t(spark, sf)
    laps = t["laps"].select("session_key", D, "lap_number", "lap_duration")
    df = Series(DS, ("lap_number",), strategy=strategy).apply(
        laps, best_lap=whole("min", "lap_duration"), first_lap=first("lap_duration"),
        last_lap=last("lap_duration"), lap_in_session=row_number())
    return df.withColumn("change_since_start", F.col("lap_duration") - F.col("first_lap"))


_series_query("full_frame", W("""
SELECT session_key, driver_number, lap_number, lap_duration,
       min(lap_duration) OVER (PARTITION BY driver_number, session_key) AS best_lap,
       first_value(lap_duration) OVER w AS first_lap, last_value(lap_duration) OVER w AS last_lap,
       CAST(row_number() OVER (PARTITION BY driver_number, session_key ORDER BY lap_number) AS INTEGER) AS lap_in_session,
       lap_duration - first_value(lap_duration) OVER w AS change_since_start
FROM laps
WINDOW w AS (PARTITION BY driver_number, session_key ORDER BY lap_number
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""), _full_frame, isolate_too=True)


def _lag_lead(spark, sf, strategy):
    t = _t(spark, sf)
    return Series(DS, ("date", "gap_to_leader"), strategy=strategy).apply(
        t["intervals"], gap_prev=lag("gap_to_leader", 1), gap_5_before=lag("gap_to_leader", 5),
        gap_5_after=lead("gap_to_leader", 5))


_series_query("lag_lead", W("""
SELECT session_key, driver_number, date, gap_to_leader,
       lag(gap_to_leader, 1) OVER w AS gap_prev, lag(gap_to_leader, 5) OVER w AS gap_5_before,
       lead(gap_to_leader, 5) OVER w AS gap_5_after
FROM intervals
WINDOW w AS (PARTITION BY driver_number, session_key ORDER BY date, gap_to_leader NULLS FIRST)"""), _lag_lead)


def _step_change(spark, sf, strategy):
    t = _t(spark, sf)
    p = Series(DS, ("date", "position"), strategy=strategy).apply(t["position"], prev_position=lag("position", 1))
    return p.withColumn("position_change", step_change("prev_position", "position"))


_series_query("step_change", W("""
SELECT session_key, driver_number, date, position, prev_position,
       coalesce(prev_position - position, 0) AS position_change
FROM (SELECT *, lag(position, 1) OVER (PARTITION BY driver_number, session_key ORDER BY date, position) AS prev_position
      FROM position)"""), _step_change)


def _ordinal_zone(spark, sf, strategy):
    t = _t(spark, sf)
    loc = t["location"].withColumn("x_bin", bin_floor("x", 100))
    loc = Series(DS, ("date", "x", "y"), strategy=strategy).apply(loc, sample_no=row_number())
    return ranks(loc, (D,), ("x_bin",), dense="zone_index", strategy=strategy)


_series_query("ordinal_zone", W("""
SELECT session_key, driver_number, date, x, y, CAST(floor(x / 100) * 100 AS INTEGER) AS x_bin,
       CAST(row_number() OVER (PARTITION BY driver_number, session_key ORDER BY date, x, y) AS INTEGER) AS sample_no,
       CAST(dense_rank() OVER (PARTITION BY driver_number ORDER BY CAST(floor(x / 100) * 100 AS INTEGER) NULLS FIRST)
            AS INTEGER) AS zone_index
FROM location"""), _ordinal_zone)


def _nested_window(spark, sf, strategy):
    t = _t(spark, sf)
    laps = t["laps"].select("session_key", D, "lap_number", "lap_duration")
    return Series(DS, ("lap_number",), strategy=strategy).apply(
        laps, rolling6=rolling("avg", "lap_duration", 5), final_rolling=last("rolling6"))


_series_query("nested_window", W("""
w AS (SELECT session_key, driver_number, lap_number, lap_duration,
             avg(lap_duration) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                                     ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling6 FROM laps)
SELECT *, last_value(rolling6) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final_rolling
FROM w"""), _nested_window, isolate_too=True)


# ============================================================= sorts and scalars

@register("sorted_output", W("""
SELECT driver_number, count(*) AS laps, max(st_speed) AS top_speed FROM laps GROUP BY driver_number"""))
def sorted_output(spark, sf):
    """O1/O2: global sorts (ascending, descending); the check is order-insensitive, unit tests assert order."""
    t = _t(spark, sf)
    return (t["laps"].groupBy(D).agg(F.count(F.lit(1)).alias("laps"), F.max("st_speed").alias("top_speed"))
            .orderBy(F.col("laps").desc(), D))


@register("rounding", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {R('l_extendedprice * l_discount', 1)} AS r1, {R('l_extendedprice * l_discount', 2)} AS r2,
       {R('l_extendedprice * l_tax / 7', 3)} AS r3, {R('l_extendedprice / 3', 4)} AS r4,
       abs(l_discount - l_tax) AS abs_diff
FROM lineitem""")
def rounding(spark, sf):
    """X1 HALF_UP rounding to 1-4 digits, X3 abs."""
    li = read(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     half_up(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("r1"),
                     half_up(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("r2"),
                     half_up(F.col("l_extendedprice") * F.col("l_tax") / 7, 3).alias("r3"),
                     half_up(F.col("l_extendedprice") / 3, 4).alias("r4"),
                     F.abs(F.col("l_discount") - F.col("l_tax")).alias("abs_diff"))


# ============================================================= race analyses

def _dim_join(fact: str, dim: str = "dim", extra: str = "") -> str:
    return (f"SELECT f.*, d.full_name, d.team_name FROM {fact} f JOIN {dim} d ON f.driver_number = d.driver_number "
            f"WHERE f.session_key IN (SELECT session_key FROM sess) {extra}")


LAP_TIME_SQL = """
l AS ({src}),
w AS (SELECT *, avg(lap_duration) OVER (PARTITION BY session_key, lap_number) AS peer,
             avg(lap_duration) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                                     ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS roll FROM l),
w2 AS (SELECT *, lap_duration - peer AS delta,
              last_value(roll) OVER (PARTITION BY driver_number, session_key ORDER BY lap_number
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final_roll FROM w)
SELECT driver_number, full_name, {avg_lap} AS avg_lap, min(lap_duration) AS best_lap,
       {avg_delta} AS avg_delta_to_field, {roll_last} AS rolling5_last, {m} AS meeting_key
FROM w2 WHERE team_name = '{team}' GROUP BY driver_number, full_name"""


def _lap_time_sql(src: str) -> str:
    return W(LAP_TIME_SQL.format(src=src, avg_lap=R("avg(lap_duration)", 2), avg_delta=R("avg(delta)", 2),
                                 roll_last=R("max(final_roll)", 2), m=MEETING, team=TEAM))


def _race(fn, **kw):
    return lambda spark, sf: fn(_t(spark, sf), meeting_key=MEETING, **kw)


register("lap_time", _lap_time_sql(_dim_join("laps", extra="AND f.lap_duration IS NOT NULL")))(
    _race(race.lap_time, team=TEAM))
register("lap_time_split", _lap_time_sql(_dim_join("laps", extra="AND f.lap_duration IS NOT NULL")))(
    _race(race.lap_time, team=TEAM, strategy=SPLIT))
register("lap_time_all_drivers", _lap_time_sql(
    "SELECT f.*, d.full_name, d.team_name FROM laps f JOIN drivers d ON f.driver_number = d.driver_number "
    "WHERE f.session_key IN (SELECT session_key FROM sess) AND f.lap_duration IS NOT NULL"))(
    _race(race.lap_time, team=TEAM, driver_scope="raw"))

MAX_SPEED_SQL = """
l AS ({src})
SELECT driver_number, full_name, team_name, max(st_speed) AS best_speed_trap, {avg_speed} AS avg_speed_trap,
       min(duration_sector_3) AS best_s3_time, {avg_s3} AS avg_s3_time,
       max(lap_number) AS laps_completed,
       struct_extract(max(CASE WHEN st_speed IS NOT NULL THEN {{'v': st_speed, 'p': lap_number}} END), 'p') AS lap_best_speed_trap,
       struct_extract(min(CASE WHEN duration_sector_3 IS NOT NULL THEN {{'v': duration_sector_3, 'p': lap_number}} END), 'p') AS lap_best_s3_time,
       {m} AS meeting_key
FROM l GROUP BY driver_number, full_name, team_name"""


def _max_speed_sql(dim: str) -> str:
    return W(MAX_SPEED_SQL.format(src=_dim_join("laps", dim, extra=f"AND d.team_name IN ({_in(TEAMS)})"), avg_speed=R("avg(st_speed)", 2),
                                  avg_s3=R("avg(duration_sector_3)", 3), m=MEETING))


register("max_speed", _max_speed_sql("dim"))(_race(race.max_speed, teams=TEAMS))
# the literal join: every row of the drivers table, a session each (H2)
register("max_speed_all_drivers", _max_speed_sql("drivers"))(_race(race.max_speed, teams=TEAMS, driver_scope="raw"))

PIT_SQL = W(f"""
iv AS (SELECT f.*, lag(gap_to_leader, 5) OVER w AS b, lead(gap_to_leader, 5) OVER w AS a
       FROM ({_dim_join('intervals')}) f
       WINDOW w AS (PARTITION BY driver_number, session_key ORDER BY date, gap_to_leader NULLS FIRST)),
p AS ({_dim_join('pit')}),
j AS (SELECT p.driver_number, p.full_name, p.team_name, p.lap_number, p.stop_duration,
             iv.gap_to_leader AS g, iv.b, iv.a
      FROM p LEFT JOIN iv ON p.driver_number = iv.driver_number AND p.session_key = iv.session_key
       AND abs({SEC('iv.date')} - {SEC('p.date')}) < {TOL_SECONDS})
SELECT driver_number, full_name, team_name, lap_number, stop_duration, {R('avg(g)', 3)} AS gap_at_pit,
       {R('avg(b)', 3)} AS gap_before_pit, {R('avg(a)', 3)} AS gap_after_pit,
       {R('avg(a) - avg(b)', 3)} AS gap_change_after_pit, {MEETING} AS meeting_key
FROM j GROUP BY driver_number, full_name, team_name, lap_number, stop_duration""")
register("pit_intervals", PIT_SQL)(_race(race.pit_intervals, tol_seconds=TOL_SECONDS))
register("pit_intervals_split", PIT_SQL)(_race(race.pit_intervals, tol_seconds=TOL_SECONDS, strategy=SPLIT))

RPM_SQL = W(f"""
car AS ({_dim_join('car_data', extra=f"AND d.team_name = '{TEAM}'")}),
loc AS (SELECT * FROM location WHERE session_key IN (SELECT session_key FROM sess)),
j AS (SELECT car.*, loc.x, loc.y FROM car LEFT JOIN loc
        ON car.session_key = loc.session_key AND car.driver_number = loc.driver_number
       AND floor({SEC('car.date')} / {BUCKET_SECONDS}) = floor({SEC('loc.date')} / {BUCKET_SECONDS})),
s AS (SELECT *, CAST(floor(x / 100) * 100 AS INTEGER) AS x_bin,
             avg(speed) OVER w AS ss, avg(rpm) OVER w AS sr FROM j
      WINDOW w AS (PARTITION BY driver_number, session_key
                   ORDER BY date NULLS FIRST, x NULLS FIRST, y NULLS FIRST, rpm NULLS FIRST, speed NULLS FIRST,
                            throttle NULLS FIRST, drs NULLS FIRST
                   ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING)),
z AS (SELECT driver_number, full_name, x_bin, avg(ss) AS avg_speed, avg(sr) AS avg_rpm,
             {XCORR('rpm', 'speed')} AS rpm_speed_corr, avg(throttle) AS avg_throttle
      FROM s GROUP BY driver_number, full_name, x_bin)
SELECT driver_number, full_name, avg_speed, avg_rpm, rpm_speed_corr, avg_throttle, {MEETING} AS meeting_key,
       CAST(dense_rank() OVER (PARTITION BY driver_number ORDER BY x_bin NULLS FIRST) AS INTEGER) AS zone_index
FROM z""")
register("rpm_zones", RPM_SQL)(_race(race.rpm_zones, team=TEAM, bucket_seconds=BUCKET_SECONDS))
register("rpm_zones_split", RPM_SQL)(_race(race.rpm_zones, team=TEAM, bucket_seconds=BUCKET_SECONDS, strategy=SPLIT))


def _drs_overtakes_sql(window: bool) -> str:
    flag = "CASE WHEN drs IN (10, 12, 14) THEN 1 ELSE 0 END"
    if window:
        flag = (f"max({flag}) OVER (PARTITION BY driver_number, session_key ORDER BY date, drs, speed "
                "ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)")
    return W(f"""
ov AS (SELECT o.*, d.full_name AS overtaking_name, d.team_name AS overtaking_team FROM overtakes o
       JOIN dimm d ON o.overtaking_driver_number = d.driver_number
       WHERE o.session_key IN (SELECT session_key FROM sess) AND d.team_name IN ({_in(TEAMS)})),
car AS (SELECT driver_number, session_key, date, drs, speed, {flag} AS flag
        FROM car_data WHERE session_key IN (SELECT session_key FROM sess)),
j AS (SELECT ov.*, car.flag, car.speed,
             row_number() OVER (PARTITION BY ov.overtaking_driver_number, ov.session_key, ov.date
                                ORDER BY abs({SEC('ov.date')} - {SEC('car.date')}) NULLS FIRST, car.date NULLS FIRST,
                                         car.drs NULLS FIRST, car.flag NULLS FIRST, car.speed NULLS FIRST) AS rn
      FROM ov LEFT JOIN car ON ov.overtaking_driver_number = car.driver_number AND ov.session_key = car.session_key)
SELECT overtaking_driver_number, overtaking_name, overtaking_team, count(*) AS total_overtakes,
       CAST(sum(coalesce(flag, 0)) AS BIGINT) AS drs_overtakes, {R('avg(speed)', 3)} AS avg_speed_at_overtake,
       {R('CASE WHEN count(*) > 0 THEN sum(coalesce(flag, 0)) / count(*) * 100 ELSE 0 END', 1)} AS drs_overtake_pct,
       {MEETING} AS meeting_key
FROM j WHERE rn = 1 GROUP BY overtaking_driver_number, overtaking_name, overtaking_team""")


register("drs_overtakes", _drs_overtakes_sql(False))(_race(race.drs_overtakes, teams=TEAMS))
register("drs_overtakes_window", _drs_overtakes_sql(True))(_race(race.drs_overtakes, teams=TEAMS, match="window"))
register("drs_overtakes_split", _drs_overtakes_sql(True))(
    _race(race.drs_overtakes, teams=TEAMS, match="window", strategy=SPLIT))

GAP_CTE = f"""
iv0 AS ({_dim_join('intervals', extra=f"AND d.team_name IN ({_in(TEAMS)})")}),
iv1 AS (SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY driver_number, session_key, date
                                       ORDER BY gap_to_leader NULLS FIRST, full_name, team_name) AS rn FROM iv0)
        WHERE rn = 1),
iv2 AS (SELECT * REPLACE (coalesce(gap_to_leader, 0) AS gap_to_leader) FROM iv1),
w AS (SELECT *, avg(gap_to_leader) OVER (PARTITION BY driver_number, session_key ORDER BY date
                                         ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS a10,
             lag(gap_to_leader, 5) OVER (PARTITION BY driver_number, session_key ORDER BY date) AS g5,
             first_value(gap_to_leader) OVER (PARTITION BY driver_number, session_key ORDER BY date
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS g0
      FROM iv2)"""

register("gap_timeline", W(f"""{GAP_CTE}
SELECT driver_number, full_name, team_name, date, gap_to_leader, {R('a10', 3)} AS avg_gap_last10,
       g5 AS gap_5_ago, {MEETING} AS meeting_key FROM w"""))(
    lambda spark, sf: race.gap_timeline(_t(spark, sf), meeting_key=MEETING, teams=TEAMS))
register("gap_summary", W(f"""{GAP_CTE}
SELECT driver_number, full_name, team_name, {R('avg(gap_to_leader)', 3)} AS avg_gap_overall,
       {R('avg(a10)', 3)} AS avg_rolling10_gap, {R('avg(g0)', 3)} AS gap_race_start,
       count(CASE WHEN gap_to_leader = 0 THEN 1 END) AS records_as_leader, {MEETING} AS meeting_key
FROM w GROUP BY driver_number, full_name, team_name"""))(
    lambda spark, sf: race.gap_summary(_t(spark, sf), meeting_key=MEETING, teams=TEAMS))

register("overtake_totals", W(f"""
ov AS (SELECT o.*, d.full_name FROM overtakes o LEFT JOIN (SELECT driver_number, full_name FROM dim) d
         ON o.overtaking_driver_number = d.driver_number
       WHERE o.session_key IN (SELECT session_key FROM sess) AND o.overtaking_driver_number IN ({_in(DRIVERS)})),
w AS (SELECT *, count(*) OVER (PARTITION BY overtaking_driver_number, session_key ORDER BY date
                               ROWS UNBOUNDED PRECEDING) AS c FROM ov)
SELECT overtaking_driver_number, full_name, session_key, CAST(max(c) AS BIGINT) AS total_overtakes,
       {MEETING} AS meeting_key
FROM w GROUP BY overtaking_driver_number, full_name, session_key"""))(
    _race(race.overtake_totals, drivers=DRIVERS))

register("position_change", W(f"""
p AS ({_dim_join('position', extra=f"AND f.driver_number IN ({_in(DRIVERS)})")}),
w AS (SELECT *, coalesce(lag(position, 1) OVER (PARTITION BY driver_number, session_key ORDER BY date, position)
                         - position, 0) AS pc FROM p)
SELECT driver_number, full_name, CAST(sum(CASE WHEN pc > 0 THEN pc ELSE 0 END) AS BIGINT) AS total_positions_gained,
       CAST(sum(CASE WHEN pc < 0 THEN pc ELSE 0 END) AS BIGINT) AS total_positions_lost, {MEETING} AS meeting_key
FROM w GROUP BY driver_number, full_name"""))(_race(race.position_change, drivers=DRIVERS))

def _sector_sql(dim: str) -> str:
    return W(f"""
dimall AS (SELECT driver_number, full_name, team_name FROM drivers
           QUALIFY row_number() OVER (PARTITION BY driver_number ORDER BY full_name, team_name) = 1),
l AS ({_dim_join('laps', dim, extra=f"AND d.team_name = '{TEAM}'")}),
w AS (SELECT *, avg(duration_sector_1) OVER wr AS r1, avg(duration_sector_2) OVER wr AS r2,
             avg(duration_sector_3) OVER wr AS r3, min(duration_sector_1) OVER wp AS b1,
             min(duration_sector_2) OVER wp AS b2, min(duration_sector_3) OVER wp AS b3,
             min(lap_duration) OVER wp AS best_lap
      FROM l
      WINDOW wr AS (PARTITION BY driver_number, session_key ORDER BY lap_number ROWS BETWEEN 10 PRECEDING AND CURRENT ROW),
             wp AS (PARTITION BY driver_number, session_key))
SELECT driver_number, full_name, lap_number, lap_duration, best_lap, {R('duration_sector_1', 3)} AS s1,
       duration_sector_2 AS s2, duration_sector_3 AS s3, {R('r1', 3)} AS rolling_avg_s1, {R('r2', 3)} AS rolling_avg_s2,
       {R('r3', 3)} AS rolling_avg_s3, b1 AS best_s1, b2 AS best_s2, b3 AS best_s3,
       {R('r1 - b1', 3)} AS loss_s1, {R('r2 - b2', 3)} AS loss_s2, {R('r3 - b3', 3)} AS loss_s3,
       {R(R('r1 - b1', 3) + ' + ' + R('r2 - b2', 3) + ' + ' + R('r3 - b3', 3), 3)} AS total_loss,
       {MEETING} AS meeting_key
FROM w""")


register("sector_loss", _sector_sql("dim"))(_race(race.sector_loss, team=TEAM))
register("sector_loss_split", _sector_sql("dim"))(_race(race.sector_loss, team=TEAM, strategy=SPLIT))
# the literal join: one row per driver of all sessions (H6)
register("sector_loss_all_drivers", _sector_sql("dimall"))(_race(race.sector_loss, team=TEAM, driver_scope="all"))

register("drs_correlation", W(f"""
c AS ({_dim_join('car_data', extra=f"AND d.team_name = '{TEAM}' AND f.speed > 0")}),
c1 AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY driver_number, session_key, date
                                      ORDER BY drs, speed, rpm, throttle, full_name, team_name) AS rn FROM c)
       WHERE rn = 1),
c2 AS (SELECT *, CASE WHEN drs IN (10, 12, 14) THEN 1.0 WHEN drs = 8 THEN 0.5 ELSE 0.0 END::DOUBLE AS drs_on
       FROM c1 WHERE drs IN (0, 1, 8, 10, 12, 14)),
w AS (SELECT *, avg(speed) OVER (PARTITION BY driver_number, session_key ORDER BY date
                                 ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS sma FROM c2)
SELECT driver_number, full_name, {XCORR('CAST(drs_on * 2 AS BIGINT)', 'speed')} AS drs_speed_correlation,
       avg(speed) AS avg_speed,
       avg(sma) AS avg_speed_moving, count(CASE WHEN drs_on > 0 THEN 1 END) AS drs_activations,
       avg(CASE WHEN drs_on > 0 THEN speed END) AS avg_speed_when_drs_on,
       avg(CASE WHEN drs_on = 0 THEN speed END) AS avg_speed_when_drs_off, count(*) AS total_samples,
       {MEETING} AS meeting_key
FROM w GROUP BY driver_number, full_name"""))(_race(race.drs_correlation, team=TEAM))

STINT_SQL = W(f"""
s AS ({_dim_join('stints', 'dimm', extra=f"AND d.team_name = '{TEAM}'")}),
l AS ({_dim_join('laps', 'dimm', extra=f"AND d.team_name = '{TEAM}' AND f.lap_duration IS NOT NULL")}),
j AS (SELECT l.driver_number, l.session_key, l.full_name, l.lap_number, l.lap_duration, s.stint_number, s.compound
      FROM l LEFT JOIN s ON l.driver_number = s.driver_number AND l.session_key = s.session_key
       AND l.lap_number >= s.lap_start AND l.lap_number <= s.lap_end),
w AS (SELECT *, lap_duration - first_value(lap_duration) OVER wf AS loss, last_value(lap_duration) OVER wf AS last_lap
      FROM j WINDOW wf AS (PARTITION BY driver_number, session_key, stint_number ORDER BY lap_number
                           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT driver_number, full_name, stint_number, compound, count(*) AS laps_in_stint,
       {R('avg(lap_duration)', 3)} AS avg_lap_time, min(lap_duration) AS best_lap_time, max(loss) AS max_degradation,
       {R('avg(loss)', 3)} AS avg_degradation, max(last_lap) AS last_lap_time, {MEETING} AS meeting_key
FROM w GROUP BY driver_number, full_name, stint_number, compound""")
register("stint_length", STINT_SQL)(_race(race.stint_length, team=TEAM))
register("stint_length_split", STINT_SQL)(_race(race.stint_length, team=TEAM, strategy=SPLIT))
