"""Curated lake access (S6): ``Lake(base).table("laps")`` is a Parquet scan.

Scans are lazy; filters on ``session_key`` and column selections written later
reach the scan as ``PushedFilters`` / a pruned ``ReadSchema`` (and prune
partitions when the table was written partitioned by ``session_key``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pitwall.sources.catalog import SHORT


# fixed value: the curated zone's folder below the lake base
CURATED_ZONE = "transformed/f1_2025"


class Lake:
    def __init__(self, spark: SparkSession, base: str, zone: str = CURATED_ZONE):
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{zone.strip('/')}" if zone else base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{SHORT.get(name, name)}.parquet"

    def table(self, name: str) -> DataFrame:
        """The batch table and, where files were ingested as a stream, the rows of those."""
        parts = []
        for path in (self.path(name), self.path(name).removesuffix(".parquet") + ".stream.parquet"):
            try:
                parts.append(self.spark.read.parquet(path))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        if not parts:
            raise FileNotFoundError(self.path(name))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def tables(self) -> "LakeTables":
        return LakeTables(self)


def write_bucketed(df: DataFrame, table: str, path: str, keys=("session_key", "driver_number"), order=("date",), buckets: int = 64) -> DataFrame:
    """``df`` as a catalog table of Parquet files below ``path``, bucketed by ``keys`` and sorted by ``order`` in every bucket.

    Later windows and joins on these keys find their rows together and need no exchange of the table. One exchange here
    puts each bucket into one file (a hot key makes its bucket's file large: choose such tables' keys accordingly).
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table))
    return df.sparkSession.table(table)


class LakeTables(dict):
    """Race tables of a lake, opened on first use (the analyses take this dict)."""

    def __init__(self, lake: Lake):
        super().__init__()
        self.lake = lake

    def __missing__(self, name):
        df = self.lake.table(name)
        self[name] = df
        return df
