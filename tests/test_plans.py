"""Plan shape: what the engine promises about physical plans."""
import pytest

from pitwall.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pairing_joins_or_python(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", ["lap_time", "max_speed", "sector_loss", "stint_length"])
def test_scope_reaches_the_scan(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(session_key,0)" in text or "In(session_key" in text
    # the laps scan reads only the columns the analysis needs
    scans = [l for l in text.splitlines() if l.startswith("ReadSchema") and "lap_number" in l]
    assert scans and all("st_speed" not in s or name == "max_speed" for s in scans)


def test_field_average_is_not_a_shuffle_of_laps(spark):
    # few (session, lap) groups: partial aggregate + broadcast, one exchange of the laps for the driver windows
    plan = _plan(catalog.QUERIES["peer_delta"](spark, SF))
    assert "BroadcastHashJoin" in plan and "Window" not in plan


def test_no_estimate_based_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"


def test_no_frame_from_the_row_to_the_end(spark):
    # such a frame is recomputed for every row; backward fills use the reversed order instead
    for name in ("nearest_join", "nearest_join_split", "drs_overtakes", "drs_overtakes_split"):
        plan = _plan(catalog.QUERIES[name](spark, SF))
        assert "currentrow$(), unboundedfollowing" not in plan and "specifiedwindowframe(RowFrame, 1, unboundedfollowing" not in plan


@pytest.mark.parametrize("name,scans,exchanges", [("lap_time_split", 4, 8), ("drs_overtakes_split", 6, 12), ("stint_length_split", 4, 8),
                                                  ("pit_intervals", 4, 6), ("proximity_join", 2, 2)])
def test_facts_are_read_once(spark, name, scans, exchanges):
    """Chunk summaries are computed first; the plan itself reads every source once (dimensions once a side)."""
    plan = _plan(catalog.QUERIES[name](spark, SF))
    assert plan.count("FileScan") <= scans and plan.count("Exchange hashpartitioning") <= exchanges


def test_arg_extrema_are_hashed(spark):
    assert "SortAggregate" not in _plan(catalog.QUERIES["arg_extrema"](spark, SF))
