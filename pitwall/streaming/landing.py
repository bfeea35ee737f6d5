"""Incremental ingest with Structured Streaming.

The batch ingest replaces whole tables. For raw CSV files that keep landing
(one file per upload), ``stream_ingest`` treats the raw folder as a file
stream: only files not seen before are read, curated with the same steps as
the batch path (names, drops, types), and appended to ``<stem>.stream.parquet`` beside the batch table,
which ``Lake`` reads together with it: a Parquet sink's log hides files it did
not write, so the two never share a folder. ``availableNow`` processes
everything landed so far and stops, so it runs from any scheduler. A file
whose header does not have the given columns in their order fails the run.

The checkpoint records which files are done. It lies in a folder that stays
the same between applications: the one given, or ``stream-ingest`` directly
below ``spark.checkpoint.dir`` (not Spark's sub-folder of one application), so a
later or restarted run goes on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from pitwall.sources.catalog import DROPS, MARKED, SCHEMAS
from pitwall.sources.ingest import apply_types, drop_if_present, normalize_names


def raw_schema(columns) -> StructType:
    """All-string raw schema of a table (streams need the schema up front)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def curated_stream(spark: SparkSession, raw_dir: str, stem: str, raw_columns) -> DataFrame:
    """Streaming DataFrame of newly landed ``<stem>*.csv`` files, curated."""
    s = (spark.readStream.schema(raw_schema(raw_columns)).option("header", True).option("enforceSchema", False)
         .option("pathGlobFilter", f"{stem}*.csv").csv(raw_dir))
    s = drop_if_present(normalize_names(s), DROPS.get(stem, ()))
    return apply_types(s, SCHEMAS.get(stem, {}), MARKED.get(stem, ()))


def configured(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names, the same for every application that sets it."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def stream_ingest(spark: SparkSession, raw_dir: str, curated_dir: str, stem: str, raw_columns,
                  checkpoint: str | None = None):
    """Append newly landed files of one table to its curated table; returns the finished query."""
    base = checkpoint or configured(spark)
    if not base:
        raise ValueError("stream_ingest needs a checkpoint folder, or spark.checkpoint.dir")
    base = base.rstrip("/") + ("" if checkpoint else "/stream-ingest")
    q = (curated_stream(spark, raw_dir, stem, raw_columns).writeStream.format("parquet")
         .option("path", f"{curated_dir.rstrip('/')}/{stem}.stream.parquet")
         .option("checkpointLocation", f"{base}/{stem}")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
