"""pitwall: race-timing and telemetry analytics as lazy Spark DataFrame plans.

Layout
------
sources/    CSV ingest, curated lake, result sinks, driver-data adapter
functions/  column expressions (rounding, epoch seconds, guarded corr, ...)
operators/  DataFrame -> DataFrame building blocks (scoping, joins, series windows)
plans/      the composed race analyses (lap time, speed trap, pit gaps, ...)
streaming/  incremental landing of raw CSV files with Structured Streaming
"""

__version__ = "0.1.0"
