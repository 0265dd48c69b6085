"""Summarise stage times from a Spark event log written to a scratch folder.

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch>``,
then: python tools/stages.py <scratch> [last_n]
Prints, per completed stage: id, task count, duration and start/end offsets.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def stage_times(log_root: str) -> list:
    app = sorted(glob.glob(os.path.join(log_root, "*")), key=os.path.getmtime)[-1]
    files = sorted(glob.glob(os.path.join(app, "events*"))) if os.path.isdir(app) else [app]
    stages = {}
    for f in files:
        for line in _lines(f):
            try:
                ev = json.loads(line)
            except ValueError:
                continue
            if ev.get("Event") == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"], si["Submission Time"], si["Completion Time"])
    return sorted(stages.items())


def main() -> None:
    rows = stage_times(sys.argv[1])
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    rows = rows[-n:]
    if not rows:
        return
    base = rows[0][1][1]
    for sid, (tasks, start, end) in rows:
        print(f"stage {sid:5d} tasks {tasks:5d} dur {(end - start) / 1000:7.3f}s  at {(start - base) / 1000:8.3f}-{(end - base) / 1000:8.3f}")


if __name__ == "__main__":
    main()
