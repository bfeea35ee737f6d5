"""Jobs: one analysis or a group of analyses that share a parent, written to sinks.

Two jobs have two outputs: the gap job (timeline + summary over one enriched
parent) and the overtakes job (totals + position changes). A parent consumed by
more than one output is materialised once with a reliable ``checkpoint`` into
the session's checkpoint folder instead of being recomputed per output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitwall.plans import race
from pitwall.session import ensure_checkpoint_dir
from pitwall.sources.catalog import COLLECTIONS
from pitwall.sources.sinks import preview, write_collection

JOBS = {
    "lap_time": ("lap_time",), "max_speed": ("max_speed",), "pit_intervals": ("pit_intervals",),
    "rpm_correlation": ("rpm_zones",), "drs_overtakes": ("drs_overtakes",),
    "gap_to_leader": ("gap_timeline", "gap_summary"), "overtakes": ("overtake_totals", "position_change"),
    "sector_loss": ("sector_loss",), "drs_correlation": ("drs_correlation",), "stint_length": ("stint_length",),
}

#: Jobs whose result is printed too, and the form in which it is.
PREVIEWS = {"sector_loss": lambda df: df, "drs_correlation": race.drs_correlation_display}


def outputs(tables: dict, job: str, **params) -> dict[str, DataFrame]:
    """Lazy result DataFrames of a job, keyed by collection name."""
    names = JOBS[job]
    if job == "gap_to_leader":
        df, sc = race.gap_enriched(tables, **params)
        ensure_checkpoint_dir(df.sparkSession)
        shared = (df.checkpoint(eager=True), sc)
        return {COLLECTIONS["gap_timeline"]: race.gap_timeline(tables, enriched=shared),
                COLLECTIONS["gap_summary"]: race.gap_summary(tables, enriched=shared)}
    return {COLLECTIONS[n]: race.ANALYSES[n](tables, **params) for n in names}


def run(tables: dict, job: str, fmt: str = "parquet", base: str | None = None, options: dict | None = None,
        show: bool = False, **params) -> dict[str, str]:
    """Write the job's collections; with ``show`` print the first rows of those that have a preview (S8). What is
    printed is computed once, with what is written."""
    written = {}
    for name, df in outputs(tables, job, **params).items():
        if show and job in PREVIEWS:
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint(eager=True)
        written[name] = write_collection(df, name, fmt=fmt, base=base, options=options)
        if show and job in PREVIEWS:
            preview(PREVIEWS[job](df))
    return written
