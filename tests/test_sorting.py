"""O1/O2: analyses that sort their result keep the declared order (the oracle check is order-insensitive)."""
import pytest

from pitwall.plans import catalog

SF = "/root/testdata/sf0.001"


def _key(v, desc=False):
    # Spark's ascending order puts nulls first, descending puts them last
    return (v is not None, v) if not desc else (v is None, -v if v is not None else 0)


@pytest.mark.parametrize("name,cols,desc", [
    ("lap_time", ["avg_lap"], False),
    ("max_speed", ["best_speed_trap"], True),
    ("pit_intervals", ["driver_number", "lap_number"], False),
    ("rpm_zones", ["driver_number", "zone_index"], False),
    ("drs_overtakes", ["overtaking_team", "overtaking_name"], False),
    ("gap_summary", ["avg_gap_overall"], False),
    ("sector_loss", ["driver_number", "lap_number"], False),
    ("drs_correlation", ["drs_speed_correlation"], True),
    ("stint_length", ["driver_number", "stint_number"], False),
    ("sorted_output", ["laps"], True),
])
def test_declared_order(spark, name, cols, desc):
    rows = catalog.QUERIES[name](spark, SF).collect()
    assert rows
    keys = [tuple(_key(r[c], desc) for c in cols) for r in rows]
    assert keys == sorted(keys)
