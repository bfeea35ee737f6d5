"""Task-time summary from a Spark event log (no UI): per job group, the stages'
task counts, the longest task and the sum of task times.

usage: python tools/stage_times.py <event log file or dir>
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines of a log file, a rolling log directory, or a folder holding one of those."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("events_")
                       or f.startswith("local-") or f.startswith("app-"))
    else:
        files = [path]
    for name in files:
        if name.endswith(".zstd"):
            import io

            import zstandard
            with open(name, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(name) as f:
                yield from f


def summarize(path: str) -> dict:
    stage_group, tasks = {}, defaultdict(list)
    for line in _lines(path):
        if not line.strip():
            continue
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            info = e["Task Info"]
            tasks[e["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    out = defaultdict(lambda: {"stages": 0, "tasks": 0, "max_task_ms": 0, "task_ms": 0})
    for sid, durations in tasks.items():
        g = out[stage_group.get(sid)]
        g["stages"] += 1
        g["tasks"] += len(durations)
        g["max_task_ms"] = max(g["max_task_ms"], max(durations))
        g["task_ms"] += sum(durations)
    return dict(out)


if __name__ == "__main__":
    for group, s in summarize(sys.argv[1]).items():
        print(group, s)
