"""Race-shaped tables derived with Spark from the driver's TPC-H-style test data.

The driver ships ``region customer lineitem events ...`` Parquet files, not race
telemetry. Each race table below is a lazy DataFrame over those files, so its
size grows with them. ``RACE_CTES`` is the same derivation in SQL, used by the
DuckDB oracle; the two must stay in step.

Mapping (measures are integer cents, so sums and averages are exact in both engines):

=============  ==============================================================
sessions       region: session_key = r_regionkey, meeting_key = 1265 + key,
               'Race' for keys 0-2, 'Sprint' otherwise
drivers        distinct (session, user) of events joined to customer:
               full_name = c_name, team_name = c_mktsegment
laps           lineitem per (supplier, ship-year session), lap_number = ordinal
               by ship date; durations/sectors in cents, null for returned
               first lines; st_speed = rounded price
stints         20-lap blocks of laps, stint 2 left out (laps in no stint)
car_data       events: speed (0 for errors), drs, rpm, throttle from event_id
location       events except views: x, y from event_id
intervals      events except purchases: gap in cents, null for errors
pit            purchases: lap_number = event_id, stop_duration in cents
overtakes      signups by user
position       views and clicks: position 1..20
=============  ==============================================================
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators.series import Series, row_number
from pitwall.session import ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# ---- fixed values of the mapping ------------------------------------------------------
FIRST_MEETING = 1265        # meeting_key of session 0
RACE_SESSIONS = 3           # sessions 0, 1, 2 are races, the rest sprints
STINT_LAPS = 20             # laps per stint block
SKIPPED_STINT = 2           # stint left out so some laps have no stint
COMPOUNDS = ("SOFT", "MEDIUM", "HARD")   # compound of stint n is COMPOUNDS[n % 3]
LAP_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(c) -> F.Column:
    return F.round(c * 100).cast("bigint")


def _events(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.withColumn("session_key", F.floor((F.dayofmonth("ts") - 1) / 10).cast("int"))


def _store(spark: SparkSession, sf_dir: str) -> str:
    """Folder for the curated race tables of one source folder, below the checkpoint dir."""
    parts = [os.path.abspath(sf_dir)]
    for t in TABLES:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            st = os.stat(p)
            parts.append(f"{t}:{st.st_size}:{int(st.st_mtime)}")
    tag = hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/race-tables-{tag}"


_LOCKS: dict = {}


class LazyTables(dict):
    """Race tables built on first access.

    With ``materialize`` (the default) a table is derived once, written as
    Parquet to the session's checkpoint folder (the shared folder on a
    cluster) and read back, like the curated zone the ingest job writes;
    later queries of the same session read the written table. Without it
    every query re-derives the tables from the source files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, lap_strategy: str = "auto", materialize: bool = True):
        super().__init__()
        self._spark, self._sf, self._lap_strategy = spark, sf_dir, lap_strategy
        self._materialize = materialize
        self._all = None

    def derive(self, name: str) -> DataFrame:
        if name == "stints":                 # from the (written) laps table
            return _stints(self["laps"])
        if self._all is None:
            self._all = _race_tables(self._spark, self._sf, self._lap_strategy)
        return self._all[name]() if callable(self._all[name]) else self._all[name]

    def __missing__(self, name):
        if not self._materialize:
            df = self.derive(name)
        else:
            path = f"{_store(self._spark, self._sf)}/{name}.parquet"
            with _LOCKS.setdefault(path, threading.Lock()):     # concurrent queries of one session
                try:
                    df = self._spark.read.parquet(path)
                except AnalysisException:
                    self.derive(name).write.mode("overwrite").parquet(path)
                    df = self._spark.read.parquet(path)
        self[name] = df
        return df


    def build_all(self, names=None, threads: int = 4) -> "LazyTables":
        """Derive and write several tables at once: independent Spark jobs submitted
        from a few driver threads share the executors (``laps`` first: ``stints`` reads it)."""
        from concurrent.futures import ThreadPoolExecutor
        names = [n for n in (names or RACE_TABLES) if n not in self]
        if "laps" in names:
            self["laps"]
        with ThreadPoolExecutor(max_workers=threads) as pool:
            list(pool.map(self.__getitem__, [n for n in names if n != "laps"]))
        return self


def race_tables(spark: SparkSession, sf_dir: str, lap_strategy: str = "auto") -> dict[str, DataFrame]:
    """All race tables as DataFrames."""
    t = LazyTables(spark, sf_dir, lap_strategy)
    return {name: t[name] for name in RACE_TABLES}


RACE_TABLES = ("sessions", "drivers", "laps", "stints", "car_data", "location", "intervals", "pit", "overtakes",
               "position")


def _race_tables(spark: SparkSession, sf_dir: str, lap_strategy: str = "auto") -> dict:
    """Race tables; ``laps`` and ``stints`` are thunks so the lap ordinal runs only when used."""
    region = read(spark, sf_dir, "region")
    customer = read(spark, sf_dir, "customer")
    li = read(spark, sf_dir, "lineitem")
    ev = _events(spark, sf_dir)

    sessions = region.select(
        F.col("r_regionkey").alias("session_key"),
        (F.lit(FIRST_MEETING) + F.col("r_regionkey")).alias("meeting_key"),
        F.when(F.col("r_regionkey") < RACE_SESSIONS, "Race").otherwise("Sprint").alias("session_name"))

    drivers = (ev.select("session_key", "user_id").distinct()
               .join(customer, F.col("user_id") == F.col("c_custkey"))
               .select("session_key", (F.lit(FIRST_MEETING) + F.col("session_key")).alias("meeting_key"),
                       F.col("user_id").alias("driver_number"), F.col("c_name").alias("full_name"),
                       F.col("c_mktsegment").alias("team_name")))

    cache = {}

    def laps_df():
        if "laps" not in cache:
            cache["laps"] = _laps(li, lap_strategy)
        return cache["laps"]

    def stints_df():
        return _stints(laps_df())

    base = ev.select("session_key", F.col("user_id").alias("driver_number"), F.col("ts").alias("date"),
                     "event_id", "event_type", "value")
    car_data = base.select(
        "session_key", "driver_number", "date",
        F.when(F.col("event_type") == "error", F.lit(0).cast("bigint")).otherwise(cents(F.col("value"))).alias("speed"),
        (F.col("event_id") * 7919 % 12000).alias("rpm"),
        (F.col("event_id") % 101).alias("throttle"),
        (F.col("event_id") % 16).alias("drs"))
    location = base.filter(F.col("event_type") != "view").select(
        "session_key", "driver_number", "date",
        (F.col("event_id") * 31 % 1000 - 500).alias("x"), (F.col("event_id") % 500).alias("y"))
    intervals = base.filter(F.col("event_type") != "purchase").select(
        "session_key", "driver_number", "date",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(cents(F.col("value"))).alias("gap_to_leader"))
    pit = base.filter(F.col("event_type") == "purchase").select(
        "session_key", "driver_number", "date", F.col("event_id").alias("lap_number"),
        cents(F.col("value")).alias("stop_duration"))
    overtakes = base.filter(F.col("event_type") == "signup").select(
        "session_key", F.col("driver_number").alias("overtaking_driver_number"), "date")
    position = base.filter(F.col("event_type").isin("view", "click")).select(
        "session_key", "driver_number", "date", (F.col("event_id") % 20 + 1).alias("position"))

    return dict(sessions=sessions, drivers=drivers, laps=laps_df, stints=stints_df, car_data=car_data,
                location=location, intervals=intervals, pit=pit, overtakes=overtakes, position=position)


def _laps(li: DataFrame, lap_strategy: str) -> DataFrame:
    """Laps: an ordinal per (supplier, session) by ship date (a series job of its own)."""
    nulled = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    lap_rows = li.select(
        F.col("l_suppkey").alias("driver_number"),
        F.least(F.lit(4), F.year("l_shipdate") - 1995).cast("int").alias("session_key"),
        *LAP_ORDER)
    lap_rows = Series(("driver_number", "session_key"), LAP_ORDER, strategy=lap_strategy).apply(
        lap_rows, lap_number=row_number())
    laps = lap_rows.select(
        "session_key", "driver_number", "lap_number",
        F.when(nulled, F.lit(None)).otherwise(cents(F.col("l_extendedprice"))).alias("lap_duration"),
        F.col("l_quantity").alias("duration_sector_1"),
        cents(F.col("l_discount")).alias("duration_sector_2"),
        F.when(nulled, F.lit(None)).otherwise(cents(F.col("l_tax"))).alias("duration_sector_3"),
        F.round("l_extendedprice").cast("bigint").alias("st_speed"))

    return laps


def _stints(laps: DataFrame) -> DataFrame:
    stint_no = (F.floor((F.col("lap_number") - 1) / STINT_LAPS) + 1).cast("int")
    compounds = F.array(*[F.lit(c) for c in COMPOUNDS])
    stints = (laps.groupBy("driver_number", "session_key", stint_no.alias("stint_number"))
              .agg(F.min("lap_number").alias("lap_start"), F.max("lap_number").alias("lap_end"))
              .filter(F.col("stint_number") != SKIPPED_STINT)
              .withColumn("compound", F.element_at(compounds, (F.col("stint_number") % 3 + 1).cast("int"))))
    return stints


# The same derivation as SQL (DuckDB dialect) for the oracle. ``epoch`` is floored
# like Spark's unix_seconds.
RACE_CTES = f"""
sessions AS (
  SELECT r_regionkey AS session_key, {FIRST_MEETING} + r_regionkey AS meeting_key,
         CASE WHEN r_regionkey < {RACE_SESSIONS} THEN 'Race' ELSE 'Sprint' END AS session_name
  FROM region),
ev AS (
  SELECT *, CAST(floor((day(ts) - 1) / 10) AS INTEGER) AS session_key FROM events),
drivers AS (
  SELECT DISTINCT e.session_key, {FIRST_MEETING} + e.session_key AS meeting_key, e.user_id AS driver_number,
         c.c_name AS full_name, c.c_mktsegment AS team_name
  FROM (SELECT DISTINCT session_key, user_id FROM ev) e JOIN customer c ON e.user_id = c.c_custkey),
laps AS (
  SELECT CAST(least(4, year(l_shipdate) - 1995) AS INTEGER) AS session_key, l_suppkey AS driver_number,
         CAST(row_number() OVER (PARTITION BY l_suppkey, least(4, year(l_shipdate) - 1995)
              ORDER BY {', '.join(c + ' NULLS FIRST' for c in LAP_ORDER)}) AS INTEGER) AS lap_number,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
              ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS lap_duration,
         l_quantity AS duration_sector_1,
         CAST(round(l_discount * 100) AS BIGINT) AS duration_sector_2,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
              ELSE CAST(round(l_tax * 100) AS BIGINT) END AS duration_sector_3,
         CAST(round(l_extendedprice) AS BIGINT) AS st_speed
  FROM lineitem),
stints AS (
  SELECT driver_number, session_key, stint_number, lap_start, lap_end,
         ['{"', '".join(COMPOUNDS)}'][stint_number % 3 + 1] AS compound
  FROM (SELECT driver_number, session_key,
               CAST(floor((lap_number - 1) / {STINT_LAPS}) + 1 AS INTEGER) AS stint_number,
               min(lap_number) AS lap_start, max(lap_number) AS lap_end
        FROM laps GROUP BY ALL)
  WHERE stint_number <> {SKIPPED_STINT}),
evb AS (
  SELECT session_key, user_id AS driver_number, ts AS date, event_id, event_type, value FROM ev),
car_data AS (
  SELECT session_key, driver_number, date,
         CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT) ELSE CAST(round(value * 100) AS BIGINT) END AS speed,
         event_id * 7919 % 12000 AS rpm, event_id % 101 AS throttle, event_id % 16 AS drs
  FROM evb),
location AS (
  SELECT session_key, driver_number, date, event_id * 31 % 1000 - 500 AS x, event_id % 500 AS y
  FROM evb WHERE event_type <> 'view'),
intervals AS (
  SELECT session_key, driver_number, date,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS gap_to_leader
  FROM evb WHERE event_type <> 'purchase'),
pit AS (
  SELECT session_key, driver_number, date, event_id AS lap_number,
         CAST(round(value * 100) AS BIGINT) AS stop_duration
  FROM evb WHERE event_type = 'purchase'),
overtakes AS (
  SELECT session_key, driver_number AS overtaking_driver_number, date FROM evb WHERE event_type = 'signup'),
position AS (
  SELECT session_key, driver_number, date, event_id % 20 + 1 AS position
  FROM evb WHERE event_type IN ('view', 'click'))
"""
