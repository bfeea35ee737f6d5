"""Registered queries against their DuckDB oracle SQL on the smallest driver data set.

Set PITWALL_ORACLE_ALL=1 to run every registered query (slow); by default one
query per operator family and every race analysis run.
"""
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from pitwall.plans import catalog

SF = os.environ.get("PITWALL_ORACLE_SF", "/root/testdata/sf0.001")
DEFAULT = ["project_filter", "left_join_renamed", "proximity_join", "containment_join", "nearest_join_split",
           "conditional_aggs", "arg_extrema", "safe_corr", "rolling_centered_split", "running_total_split",
           "full_frame_split", "lag_lead", "ordinal_zone", "nested_window_split", "lap_time", "max_speed", "pit_intervals", "rpm_zones",
           "drs_overtakes_window", "gap_summary", "overtake_totals", "position_change", "sector_loss",
           "drs_correlation", "stint_length_split"]
NAMES = sorted(catalog.ORACLE) if os.environ.get("PITWALL_ORACLE_ALL") else DEFAULT


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].astype(object).itertuples(index=False):
        out.append(tuple(None if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x))
                         else (round(x, 9) if isinstance(x, float) else x) for x in r))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    exp = con.execute(catalog.ORACLE[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["driver_number", "full_name", "avg_lap", "best_lap", "avg_delta_to_field",
                          "rolling5_last", "meeting_key"]
    df.collect()


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
