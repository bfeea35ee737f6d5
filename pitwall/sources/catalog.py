"""Table catalogue of a race lake: file stems, ingest drops and curated schemas.

Raw zone: one headered CSV per table. Curated zone: one Parquet directory per
table with the same stem. Types are declared here (schema on write), so a bad
value becomes NULL through ``try_cast`` instead of turning a whole column into
strings (hazard H10).
"""

from __future__ import annotations

# ---- fixed values: table stems and the columns dropped at ingest ----------------------
# large telemetry tables
HEAVY = ("car_data_race_only_2025", "location_race_only_2025", "position_race_only_2025")
# small tables
LIGHT = ("laps_race_only_2025", "sessions_second_half_2025", "drivers_second_half_2025",
         "meetings_second_half_2025", "intervals_race_only_2025", "overtakes_race_only_2025",
         "pit_race_only_2025", "race_sessions_2025", "stints_race_only_2025")
DROPS = {
    "car_data_race_only_2025": ("brake", "n_gear"),
    "location_race_only_2025": ("z",),
    "laps_race_only_2025": ("i1_speed", "i2_speed", "segments_sector_1", "segments_sector_2", "segments_sector_3"),
    "sessions_second_half_2025": ("circuit_key", "circuit_short_name", "country_code", "country_key", "gmt_offset",
                                  "date_end", "meeting_official_name", "is_cancelled", "year"),
    "drivers_second_half_2025": ("broadcast_name", "headshot_url", "name_acronym", "team_colour"),
    "meetings_second_half_2025": ("meeting_official_name", "circuit_key", "circuit_image", "circuit_info_url",
                                  "circuit_type", "country_code", "country_flag", "country_key", "gmt_offset",
                                  "date_start", "date_end", "is_cancelled"),
}
# short names used by the analyses -> stems
SHORT = {
    "laps": "laps_race_only_2025", "sessions": "sessions_second_half_2025", "drivers": "drivers_second_half_2025",
    "meetings": "meetings_second_half_2025", "intervals": "intervals_race_only_2025",
    "overtakes": "overtakes_race_only_2025", "pit": "pit_race_only_2025", "race_sessions": "race_sessions_2025",
    "stints": "stints_race_only_2025", "car_data": "car_data_race_only_2025",
    "location": "location_race_only_2025", "position": "position_race_only_2025",
}
# result collections written by the analyses
COLLECTIONS = {
    "lap_time": "f1_lap_time", "max_speed": "f1_max_speed", "pit_intervals": "f1_pit_intervals",
    "rpm_zones": "f1_rpm_correlation", "drs_overtakes": "f1_drs_overtakes", "gap_timeline": "f1_gap_timeline",
    "gap_summary": "f1_gap_to_leader", "overtake_totals": "f1_overtakes", "position_change": "f1_position_change",
    "sector_loss": "f1_sector_loss", "drs_correlation": "f1_drs_correlation", "stint_length": "f1_stint_length",
}

# Numeric columns whose raw feed uses text markers (a lapped car's "+1 LAP"): the marker is
# kept in <column>_marker so it is not mistaken for a missing value.
MARKED = {"intervals_race_only_2025": ("gap_to_leader",)}

# Curated column types (columns not listed keep their raw string form).
TS = "timestamp"
SCHEMAS = {
    "sessions_second_half_2025": {"session_key": "int", "meeting_key": "int", "session_name": "string"},
    "drivers_second_half_2025": {"session_key": "int", "meeting_key": "int", "driver_number": "int",
                                 "full_name": "string", "team_name": "string"},
    "meetings_second_half_2025": {"meeting_key": "int"},
    "laps_race_only_2025": {"session_key": "int", "meeting_key": "int", "driver_number": "int", "lap_number": "int",
                            "lap_duration": "double", "duration_sector_1": "double", "duration_sector_2": "double",
                            "duration_sector_3": "double", "st_speed": "int"},
    "stints_race_only_2025": {"session_key": "int", "driver_number": "int", "stint_number": "int",
                              "compound": "string", "lap_start": "int", "lap_end": "int"},
    "pit_race_only_2025": {"session_key": "int", "driver_number": "int", "date": TS, "lap_number": "int",
                           "stop_duration": "double"},
    "intervals_race_only_2025": {"session_key": "int", "driver_number": "int", "date": TS,
                                 "gap_to_leader": "double"},
    "overtakes_race_only_2025": {"session_key": "int", "overtaking_driver_number": "int", "date": TS},
    "position_race_only_2025": {"session_key": "int", "driver_number": "int", "date": TS, "position": "int"},
    "car_data_race_only_2025": {"session_key": "int", "driver_number": "int", "date": TS, "speed": "int",
                                "rpm": "int", "throttle": "int", "drs": "int"},
    "location_race_only_2025": {"session_key": "int", "driver_number": "int", "date": TS, "x": "int", "y": "int"},
    "race_sessions_2025": {},
}
