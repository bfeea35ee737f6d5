"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from inspect import signature
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step holds; longer single texts form a step of their own.
STEP_BYTES = 1 << 20
#: Rows of one file of a small checkpointed table.
FILE_ROWS = 1 << 14
#: Bytes of one Arrow batch between Spark and its Python workers, where the session names no bound: 10,000 long texts
#: would be held several times on both sides.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a scratch folder of its own only in a local session without one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-", dir=os.environ.get("TMPDIR", "/tmp")))
        named = sc.getCheckpointDir()
    return named


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; survives lost executors.

    A table known to have ``rows`` rows at most is written in as many files as that needs, not in one for every
    shuffle partition: tables of links and ids are small beside their documents, and each file is opened again.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, whatever their path holds; bound the batches."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    if getattr(sc, "_pitwall_shipped", None) == sc.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="pitwall-")) / "pitwall.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._pitwall_shipped = sc.applicationId


def release() -> None:
    """Freed memory back to the system: Python workers outlive their tasks, and idle ones would keep their largest step's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def grouped(run: Callable) -> Callable:
    """A function of one whole group, or of two (``applyInArrow``), that keeps no freed memory after a group of some size."""
    def tidy(*tables: pa.Table) -> pa.Table:
        out = run(*tables)
        if sum(t.nbytes for t in tables) > STEP_BYTES:
            release()
        return out

    def one(table):
        return tidy(table)

    def two(left, right):
        return tidy(left, right)

    return two if len(signature(run).parameters) == 2 else one


def arrow_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, which keep no freed memory after a task."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    ship(df.sparkSession)
    return df.mapInArrow(tidy, schema)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose text adds up to about ``limit`` bytes (one row at least), nulls as they are."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        total = np.cumsum(sizes)
        start, n = 0, batch.num_rows
        while start < n:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def cut(sizes: dict[int, tuple[int, int]], most: int) -> int:
    """The least power of two such that at most ``most`` entries have that count or more; ``sizes`` (entries and their sum)
    by floor of the count's log2."""
    at, inside = max(sizes, default=0) + 1, 0
    while sizes and at > 0 and inside + sizes.get(at - 1, (0, 0))[0] <= most:
        at -= 1
        inside += sizes.get(at, (0, 0))[0]
    return at
