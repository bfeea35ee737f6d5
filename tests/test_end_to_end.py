"""A hand-made race lake: raw CSV -> ingest -> every job -> JSON collections.

Exercises the real column names and types (double durations, timestamps,
int codes) that the driver-data adapter does not have.
"""
import os

import pytest

from pitwall.plans.jobs import JOBS, run
from pitwall.sources.ingest import ingest
from pitwall.sources.lake import Lake

M = 1268          # meeting of the fixture
S = 9158          # its race session
T = "2025-07-27T13:{:02d}:{:02d}Z"


def t(sec):
    return T.format(sec // 60, sec % 60)


def raw_tables():
    rows = {}
    rows["sessions_second_half_2025"] = ["session_key,meeting_key,session_name,Circuit Key,year",
                                         f"{S},{M},Race,7,2025", f"{S - 1},{M},Qualifying,7,2025"]
    rows["drivers_second_half_2025"] = ["session_key,meeting_key,driver_number,full_name,team_name,headshot_url",
                                        f"{S},{M},16,Charles LECLERC,Ferrari,x", f"{S},{M},44,Lewis HAMILTON,Ferrari,x",
                                        f"{S},{M},1,Max VERSTAPPEN,Red Bull Racing,x",
                                        f"{S - 1},{M},16,Charles LECLERC,Ferrari,x"]
    rows["meetings_second_half_2025"] = ["meeting_key,meeting_name,circuit_key", f"{M},Test GP,7"]
    rows["race_sessions_2025"] = ["session_key,meeting_key", f"{S},{M}"]
    laps = ["session_key,meeting_key,driver_number,lap_number,lap_duration,duration_sector_1,duration_sector_2,"
            "duration_sector_3,st_speed,i1_speed"]
    data = {16: [(90.0, 30.0, 30.0, 30.0, 310), (91.0, 30.5, 30.0, 30.5, 312), ("", 31.0, 30.0, "", 300),
                 (92.0, 31.0, 31.0, 30.0, 312)],
            44: [(95.0, 32.0, 32.0, 31.0, 305), (94.0, 31.0, 32.0, 31.0, 306), (93.0, 31.0, 31.0, 31.0, 307),
                 (96.0, 32.0, 32.0, 32.0, 304)],
            1: [(89.0, 29.0, 30.0, 30.0, 320), (89.5, 29.5, 30.0, 30.0, 321), (90.0, 30.0, 30.0, 30.0, 322),
                (90.5, 30.0, 30.5, 30.0, 323)]}
    for d, laps_d in data.items():
        for n, (dur, s1, s2, s3, st) in enumerate(laps_d, 1):
            laps.append(f"{S},{M},{d},{n},{dur},{s1},{s2},{s3},{st},200")
    rows["laps_race_only_2025"] = laps
    rows["stints_race_only_2025"] = ["session_key,driver_number,stint_number,compound,lap_start,lap_end",
                                     f"{S},16,1,SOFT,1,2", f"{S},16,2,HARD,4,60", f"{S},44,1,MEDIUM,1,4"]
    rows["pit_race_only_2025"] = ["session_key,driver_number,date,lap_number,stop_duration",
                                  f"{S},16,{t(60)},2,2.5", f"{S},44,{t(600)},3,3.1"]
    iv = ["session_key,driver_number,date,gap_to_leader"]
    for i in range(0, 120, 4):
        iv.append(f"{S},16,{t(i)},{'' if i == 0 else 1.0 + i / 100}")
        iv.append(f"{S},44,{t(i + 1)},{'+1 LAP' if i == 40 else 2.0 + i / 100}")
    rows["intervals_race_only_2025"] = iv
    rows["overtakes_race_only_2025"] = ["session_key,overtaking_driver_number,overtaken_driver_number,date",
                                        f"{S},16,1,{t(10)}", f"{S},16,44,{t(50)}", f"{S},44,1,{t(70)}"]
    rows["position_race_only_2025"] = ["session_key,driver_number,date,position",
                                       *[f"{S},16,{t(i * 10)},{p}" for i, p in enumerate([5, 3, 3, 6])],
                                       *[f"{S},44,{t(i * 10)},{p}" for i, p in enumerate([2, 2, 1])]]
    car = ["session_key,driver_number,date,speed,rpm,throttle,drs,brake,n_gear"]
    loc = ["session_key,driver_number,date,x,y,z"]
    for i in range(0, 100):
        for d, base in ((16, 280), (44, 270), (1, 290)):
            drs = 12 if 40 <= i < 60 else (8 if i % 10 == 0 else 1)
            car.append(f"{S},{d},{t(i)},{base + (i % 7) * 3},{10000 + (i % 5) * 300},{60 + i % 40},{drs},0,7")
            loc.append(f"{S},{d},{t(i)},{(i * 37) % 900 - 450},{i % 50},0")
    rows["car_data_race_only_2025"] = car
    rows["location_race_only_2025"] = loc
    return rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw = os.path.join(root, "raw")
    os.makedirs(raw)
    for stem, lines in raw_tables().items():
        with open(os.path.join(raw, f"{stem}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    ingest(spark, raw, os.path.join(root, "transformed", "f1_2025"))
    return root


PARAMS = {
    "lap_time": dict(meeting_key=M, team="Ferrari"),
    "max_speed": dict(meeting_key=M),
    "pit_intervals": dict(meeting_key=M),
    "rpm_correlation": dict(meeting_key=M, team="Ferrari"),
    "drs_overtakes": dict(meeting_key=M),
    "gap_to_leader": dict(meeting_key=M),
    "overtakes": dict(meeting_key=M),
    "sector_loss": dict(meeting_key=M, team="Ferrari"),
    "drs_correlation": dict(meeting_key=M, team="Ferrari"),
    "stint_length": dict(meeting_key=M, team="Ferrari"),
}

COLUMNS = {
    "f1_lap_time": ["driver_number", "full_name", "avg_lap", "best_lap", "avg_delta_to_field", "rolling5_last",
                    "meeting_key"],
    "f1_max_speed": ["driver_number", "full_name", "team_name", "best_speed_trap", "avg_speed_trap", "best_s3_time",
                     "avg_s3_time", "laps_completed", "lap_best_speed_trap", "lap_best_s3_time", "meeting_key"],
    "f1_pit_intervals": ["driver_number", "full_name", "team_name", "lap_number", "stop_duration", "gap_at_pit",
                         "gap_before_pit", "gap_after_pit", "gap_change_after_pit", "meeting_key"],
    "f1_rpm_correlation": ["driver_number", "full_name", "avg_speed", "avg_rpm", "rpm_speed_corr", "avg_throttle",
                           "meeting_key", "zone_index"],
    "f1_drs_overtakes": ["overtaking_driver_number", "overtaking_name", "overtaking_team", "total_overtakes",
                         "drs_overtakes", "avg_speed_at_overtake", "drs_overtake_pct", "meeting_key"],
    "f1_gap_timeline": ["driver_number", "full_name", "team_name", "date", "gap_to_leader", "avg_gap_last10",
                        "gap_5_ago", "meeting_key"],
    "f1_gap_to_leader": ["driver_number", "full_name", "team_name", "avg_gap_overall", "avg_rolling10_gap",
                         "gap_race_start", "records_as_leader", "meeting_key"],
    "f1_overtakes": ["overtaking_driver_number", "full_name", "session_key", "total_overtakes", "meeting_key"],
    "f1_position_change": ["driver_number", "full_name", "total_positions_gained", "total_positions_lost",
                           "meeting_key"],
    "f1_sector_loss": ["driver_number", "full_name", "lap_number", "lap_duration", "best_lap", "s1", "s2", "s3",
                       "rolling_avg_s1", "rolling_avg_s2", "rolling_avg_s3", "best_s1", "best_s2", "best_s3",
                       "loss_s1", "loss_s2", "loss_s3", "total_loss", "meeting_key"],
    "f1_drs_correlation": ["driver_number", "full_name", "drs_speed_correlation", "avg_speed", "avg_speed_moving",
                           "drs_activations", "avg_speed_when_drs_on", "avg_speed_when_drs_off", "total_samples",
                           "meeting_key"],
    "f1_stint_length": ["driver_number", "full_name", "stint_number", "compound", "laps_in_stint", "avg_lap_time",
                        "best_lap_time", "max_degradation", "avg_degradation", "last_lap_time", "meeting_key"],
}


@pytest.fixture(scope="module")
def results(spark, lake):
    out = os.path.join(lake, "results")
    tables = Lake(spark, lake).tables()
    for job in JOBS:
        run(tables, job, fmt="json", base=out, **PARAMS[job])
    res = {}
    for name in COLUMNS:
        df = spark.read.json(os.path.join(out, name))
        res[name] = (df.columns, [r.asDict() for r in df.collect()])
    return res


def test_every_collection_written_with_its_columns(results):
    for name, cols in COLUMNS.items():
        got_cols, rows = results[name]
        assert sorted(got_cols) == sorted(cols), name
        assert rows, name


def _by(rows, key):
    return {r[key]: r for r in rows}


def test_lap_time_values(results):
    r = _by(results["f1_lap_time"][1], "driver_number")
    assert set(r) == {16, 44}                      # Ferrari only, after the field-wide average
    assert r[16]["avg_lap"] == 91.0 and r[16]["best_lap"] == 90.0   # the null lap is dropped
    # field average of lap 1 = (90 + 95 + 89) / 3; delta of 16 on lap 1 = 90 - 91.333...
    assert r[44]["rolling5_last"] == 94.5          # laps 1..4 of 44 are inside the 6-lap frame


def test_max_speed_values(results):
    r = _by(results["f1_max_speed"][1], "driver_number")
    assert r[16]["best_speed_trap"] == 312 and r[16]["lap_best_speed_trap"] == 4   # tie on 312 -> larger lap
    assert r[16]["best_s3_time"] == 30.0 and r[16]["lap_best_s3_time"] == 1        # null s3 on lap 3 skipped
    assert r[1]["laps_completed"] == 4


def test_overtakes_and_positions(results):
    ov = _by(results["f1_overtakes"][1], "overtaking_driver_number")
    assert ov[16]["total_overtakes"] == 2 and ov[44]["total_overtakes"] == 1
    pc = _by(results["f1_position_change"][1], "driver_number")
    assert (pc[16]["total_positions_gained"], pc[16]["total_positions_lost"]) == (2, -3)
    assert (pc[44]["total_positions_gained"], pc[44]["total_positions_lost"]) == (1, 0)


def test_gap_summary_leader_and_lapped(results):
    g = _by(results["f1_gap_to_leader"][1], "driver_number")
    assert g[16]["records_as_leader"] == 1         # the empty gap counts as leader (0.0)
    assert g[16]["gap_race_start"] == 0.0
    # A lapped marker ("+1 LAP") is kept as gap_to_leader_marker at ingest: that sample
    # keeps a null gap and is not counted as leading (unlike the empty gap of 16's first sample).
    assert g[44]["records_as_leader"] == 0


def test_stints_and_pits(results):
    st = {(r["driver_number"], r["stint_number"]): r for r in results["f1_stint_length"][1]}
    assert st[(16, 1)]["laps_in_stint"] == 2 and st[(16, 1)]["max_degradation"] == 1.0
    assert st[(16, 2)]["laps_in_stint"] == 1 and st[(16, 2)]["last_lap_time"] == 92.0
    assert st[(44, 1)]["laps_in_stint"] == 4 and st[(44, 1)]["avg_lap_time"] == 94.5
    pits = _by(results["f1_pit_intervals"][1], "driver_number")
    assert pits[16]["stop_duration"] == 2.5 and pits[16]["gap_at_pit"] is not None
    assert pits[44]["gap_at_pit"] is None          # no interval sample within 30 s of 44's stop at 10:00


def test_cli_run_and_landing(spark, lake, capsys):
    from pitwall.cli import main
    out = os.path.join(lake, "cli-results")
    assert main(["run", "max_speed", "--base", lake, "--out", out, "--format", "parquet",
                 "--param", f"meeting_key={M}", "--param", "teams=('Ferrari',)"], stop=False) == 0
    got = spark.read.parquet(os.path.join(out, "f1_max_speed"))
    assert sorted(r.driver_number for r in got.collect()) == [16, 44]
    assert main(["landing", "--raw", os.path.join(lake, "raw")], stop=False) == 0
    assert "12 files landed" in capsys.readouterr().out


def test_preview_prints_rows(spark, capsys):
    from pitwall.sources.sinks import preview
    preview(spark.range(70), 60)
    text = capsys.readouterr().out
    assert "only showing top 60 rows" in text and "|59 |" in text
