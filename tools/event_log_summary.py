"""Summarize a Spark event log (uncompressed JSON lines): jobs, stages, task time.

Usage: python tools/event_log_summary.py EVENT_LOG_DIR_OR_FILE [--top N]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f))
    for f in files:
        with open(f) as fh:
            for line in fh:
                try:
                    yield json.loads(line)
                except json.JSONDecodeError:
                    continue


def main():
    path = sys.argv[1]
    top = int(sys.argv[sys.argv.index("--top") + 1]) if "--top" in sys.argv else 15
    stages, task_ms, jobs = {}, {}, {}
    for e in events(path):
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"], si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0))
        elif ev == "SparkListenerTaskEnd":
            info = e["Task Info"]
            sid = e["Stage ID"]
            task_ms[sid] = task_ms.get(sid, 0) + info["Finish Time"] - info["Launch Time"]
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
    wall = sum(b - a for a, b in jobs.values() if b)
    print(f"jobs {len(jobs)}, stages {len(stages)}, job wall time {wall / 1000:.2f} s, "
          f"task time {sum(task_ms.values()) / 1000:.2f} s")
    print(f"{'stage':>6} {'tasks':>6} {'wall ms':>8} {'task ms':>8}  name")
    for sid, (name, n, ms) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]:
        print(f"{sid:>6} {n:>6} {ms:>8} {task_ms.get(sid, 0):>8}  {name[:60]}")


if __name__ == "__main__":
    main()
