"""Summarise a Spark event log: per job group, jobs, stages, tasks and stage time.

Usage: python scripts/eventlog_summary.py EVENT_LOG_FILE_OR_FOLDER
"""

import glob
import json
import os
import sys
from collections import defaultdict

groups = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0, "max_task_ms": 0})
stage_group = {}
job_group = {}
path = sys.argv[1]
files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]


def read_lines(f):
    """Lines of a plain or zstd-compressed event log file."""
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


lines = (line for f in files if not os.path.basename(f).startswith("appstatus")
         for line in read_lines(f))
for line in lines:
    ev = json.loads(line)
    kind = ev.get("Event")
    if kind == "SparkListenerJobStart":
        g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
        groups[g]["jobs"] += 1
        for sid in ev.get("Stage IDs", []):
            stage_group[sid] = g
    elif kind == "SparkListenerStageCompleted":
        info = ev["Stage Info"]
        g = stage_group.get(info["Stage ID"], "-")
        if "Completion Time" in info and "Submission Time" in info:
            groups[g]["stages"] += 1
            groups[g]["stage_ms"] += info["Completion Time"] - info["Submission Time"]
    elif kind == "SparkListenerTaskEnd":
        g = stage_group.get(ev["Stage ID"], "-")
        t = ev["Task Info"]
        groups[g]["tasks"] += 1
        groups[g]["max_task_ms"] = max(groups[g]["max_task_ms"], t["Finish Time"] - t["Launch Time"])
for g, v in sorted(groups.items(), key=lambda kv: -kv[1]["stage_ms"]):
    print(f"{g:28s} jobs={v['jobs']:3d} stages={v['stages']:3d} tasks={v['tasks']:4d} "
          f"stage_ms={v['stage_ms']:6d} max_task_ms={v['max_task_ms']:5d}")
