"""Result sinks (S7) and console preview.

A result collection is fully replaced on every run. ``fmt`` is any DataFrame
writer format: ``parquet``/``json``/``csv`` write below ``base/name``; a
document-store connector (e.g. ``mongodb`` with its Spark connector on the
classpath) takes ``database``/``collection`` options instead of a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PATH_FORMATS = ("parquet", "json", "csv", "orc", "noop")


def write_collection(df: DataFrame, name: str, fmt: str = "parquet", base: str | None = None,
                     options: dict | None = None) -> str:
    w = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    if fmt in PATH_FORMATS:
        if fmt == "noop":
            w.save()
            return name
        if not base:
            raise ValueError(f"format {fmt} needs a base path")
        target = f"{base.rstrip('/')}/{name}"
        w.save(target)
        return target
    w.option("collection", name).save()
    return name


def preview(df: DataFrame, n: int = 60) -> None:
    """Print the first ``n`` rows untruncated (a bounded ``limit``; the only driver-side rows)."""
    df.show(n, truncate=False)
