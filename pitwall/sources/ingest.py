"""Raw CSV -> curated Parquet (S1-S5) and the landing check.

Per table the whole step is one lazy plan: CSV scan -> column-name
normalisation -> drops -> typed projection -> Parquet write. There is no
shuffle: every file split is read, projected and written by one task, so the
step scales with the number of splits.
"""

from __future__ import annotations

import warnings
from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitwall.session import ensure_checkpoint_dir
from pitwall.sources.catalog import DROPS, HEAVY, LIGHT, MARKED, SCHEMAS
from pitwall.sources.infer import inferred_types


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Headered CSV (S1). Without inference every column is a string and types are
    applied by ``apply_types``; inference (an extra pass over the data) is optional."""
    return spark.read.option("header", True).option("inferSchema", infer).csv(path)


def normalize_name(name: str) -> str:
    """Lower case; space, '-' and '.' become '_'."""
    return name.lower().replace(" ", "_").replace("-", "_").replace(".", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename every column at once (S3); two names colliding after normalisation is an error."""
    new = [normalize_name(c) for c in df.columns]
    dup = [n for n, k in Counter(new).items() if k > 1]
    if dup:
        raise ValueError(f"columns collide after normalisation: {dup}")
    return df.toDF(*new)


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop columns that exist, ignore the rest."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


WHOLE = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def typed(c: str, kind: str):
    """``c`` as ``kind``, NULL where it has no such form; whole numbers may be written with a fraction of zeros ("310.0")."""
    plain = F.col(c).try_cast(kind)
    if kind not in WHOLE:
        return plain
    number = F.col(c).try_cast("decimal(38,10)")
    return F.coalesce(plain, F.when(number == F.floor(number), F.floor(number).try_cast(kind)))


def apply_types(df: DataFrame, types: dict, marked=()) -> DataFrame:
    """Cast declared columns: an unparsable value is NULL, not a job failure.

    For a ``marked`` column the unparsable non-empty text is kept in ``<column>_marker``.
    """
    cols = [(typed(c, types[c]) if c in types else F.col(c)).alias(c) for c in df.columns]
    for c in marked:
        if c in df.columns:
            raw = F.trim(F.col(c))
            cols.append(F.when((raw != "") & typed(c, types.get(c, "double")).isNull(), raw).alias(f"{c}_marker"))
    return df.select(*cols)


def _lost(df: DataFrame, types: dict) -> dict:
    """Per declared column, the aggregate of its non-empty texts without a form of its type."""
    return {c: F.count(F.when((F.trim(F.col(c)) != "") & typed(c, types[c]).isNull(), 1)).alias(c) for c in df.columns if c in types}


def losses(df: DataFrame, types: dict) -> DataFrame:
    """The ingest report: per declared column, how many non-empty texts have no form of its type (one partial aggregate)."""
    own = _lost(df, types)
    if not own:
        return df.sparkSession.createDataFrame([], "column string, lost long")
    counts = df.agg(*own.values())
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("lost")) for c in own])).alias("r")).select("r.*")


class LostValues(ValueError):
    """Texts of a raw table have no form of their declared type; ``lost`` counts them by column."""

    def __init__(self, stem: str, lost: dict):
        super().__init__(f"{stem}: values without a form of their type: {lost}")
        self.stem, self.lost = stem, lost


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of a table's data files (a listing: no content is read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))


def write_parquet(df: DataFrame, path: str, partition_by=None, replace: str = "table") -> None:
    """Write a curated table (S4); optionally partitioned (e.g. by session_key for pruning).

    ``replace="table"`` replaces all of it. ``replace="partitions"`` replaces only the partitions that ``df`` has rows
    of (dynamic overwrite) and leaves every other file as it is; that is checked against the files listed before,
    and a RuntimeError names how many differ.
    """
    if replace not in ("table", "partitions") or (replace == "partitions" and not partition_by):
        raise ValueError("replace is 'table', or 'partitions' of a partitioned table")
    spark, before = df.sparkSession, None
    if replace == "partitions":
        ensure_checkpoint_dir(spark)
        try:
            before = _files(spark, path).checkpoint(eager=True)     # listed files may go with the write
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if partition_by:  # one writer per table partition, or several for a large one, instead of a file from every task
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace == "partitions":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    if before is not None:
        after = _files(spark, path)
        gone = before.join(after, ["path", "length", "modificationTime"], "left_anti").select(_partition(partition_by))
        # a partition with new files was in the batch; any other may have lost none
        new = after.join(before, "path", "left_anti").select(_partition(partition_by)).distinct()
        touched = gone.join(new, "partition", "left_anti").count()
        if touched:
            raise RuntimeError(f"{touched} files of partitions outside the batch changed under {path}")


def _partition(keys):
    """The partition folders of a data file's path."""
    return F.concat_ws("/", *[F.regexp_extract("path", f"/({k}=[^/]+)/", 1) for k in keys]).alias("partition")


def texts(spark: SparkSession, raw_path: str, stem: str) -> DataFrame:
    """A raw table as text, with curated names and without the dropped columns."""
    return drop_if_present(normalize_names(read_csv(spark, raw_path)), DROPS.get(stem, ()))


def curate(spark: SparkSession, raw_path: str, stem: str, typed: bool = True, infer: bool = False) -> DataFrame:
    """The lazy curated DataFrame of one raw table: with its declared types, with types inferred from all its values (one
    aggregate over the table, when this is called), or as text."""
    df = texts(spark, raw_path, stem)
    if typed:
        return apply_types(df, SCHEMAS.get(stem, {}), MARKED.get(stem, ()))
    return apply_types(df, inferred_types(df)) if infer else df


def ingest(spark: SparkSession, raw_dir: str, curated_dir: str, stems=HEAVY + LIGHT, typed: bool = True,
           partition_by: dict | None = None, on_loss: str = "report", replace: str = "table", report=None) -> dict:
    """Batch ingest over a table manifest (S5): one Spark job per table.

    Values without a form of their declared type become NULL, and are counted while the table is written (an
    observation on the same job, no second pass): ``on_loss="report"`` warns and calls ``report(stem, {column: lost})``
    if given; ``"fail"`` counts first and raises ``LostValues`` before anything is written; ``"ignore"`` counts nothing.
    ``replace="partitions"`` replaces only the partitions (sessions) that the raw tables hold, for tables with an
    entry in ``partition_by``. Undeclared types (``typed=False``) are inferred and lose nothing.

    Returns {stem: written column list}.
    """
    if on_loss not in ("report", "fail", "ignore"):
        raise ValueError("on_loss is 'report', 'fail' or 'ignore'")
    raw_dir, curated_dir = raw_dir.rstrip("/"), curated_dir.rstrip("/")
    written = {}
    for stem in stems:
        path, types = f"{raw_dir}/{stem}.csv", SCHEMAS.get(stem, {}) if typed else {}
        raw, seen = texts(spark, path, stem), None
        marked = MARKED.get(stem, ())
        counted = {c: e for c, e in _lost(raw, types).items() if c not in marked}       # a marker keeps its text
        if on_loss == "fail" and counted:
            lost = {k: v for k, v in raw.agg(*counted.values()).first().asDict().items() if v}
            if lost:
                raise LostValues(stem, lost)
        if on_loss == "report" and counted:
            seen = Observation(stem)
            raw = raw.observe(seen, *counted.values())
        df = apply_types(raw, types, marked) if typed else apply_types(raw, inferred_types(raw))
        parts = (partition_by or {}).get(stem)
        write_parquet(df, f"{curated_dir}/{stem}.parquet", parts, replace if parts else "table")
        written[stem] = df.columns
        if seen is not None:
            lost = {k: v for k, v in seen.get.items() if v}
            if lost:
                warnings.warn(f"{stem}: values without a form of their type became null: {lost}", stacklevel=2)
                if report:
                    report(stem, lost)
    return written


def landed_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Landed raw files (path, length) under ``path``; raises if there are none.

    ``binaryFile`` lists through the cluster file system; the file content column
    is never selected, so no file is read.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"no {glob} files landed under {path}")
    return files
