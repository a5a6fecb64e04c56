"""Per-stage shuffle and skew figures from a Spark event log.

    spark-submit --conf spark.eventLog.enabled=true --conf spark.eventLog.dir=<scratch> …
    python tools/stage_metrics.py <scratch>

Prints, per stage: tasks, input records, shuffle records read (total and
largest task), shuffle records written, and task run time (max / median).
A largest-task share far above 1/tasks marks a skewed key. Job groups set
with ``setJobGroup`` label the stages.
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
        raw = open(path, "rb")
        yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main() -> None:
    root = sys.argv[1]
    files = sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)) or \
        sorted(f for f in glob.glob(os.path.join(root, "*")) if os.path.isfile(f))
    tasks: dict[int, list[tuple[int, int, int, int]]] = {}
    group: dict[int, str | None] = {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    group[sid] = g
            elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = e["Task Metrics"]
                tasks.setdefault(e["Stage ID"], []).append((
                    m.get("Input Metrics", {}).get("Records Read", 0),
                    m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0),
                    m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0),
                    m.get("Executor Run Time", 0),
                ))
    for sid in sorted(tasks):
        t = tasks[sid]
        rin, rr, rw, ms = (list(x) for x in zip(*t))
        med = sorted(ms)[len(ms) // 2]
        print(f"{str(group.get(sid)):24s} stage {sid:4d} tasks {len(t):5d} in {sum(rin):11d} "
              f"shuffle-read {sum(rr):11d} (max task {max(rr):10d}) shuffle-write {sum(rw):11d} "
              f"ms max {max(ms):7d} med {med:7d}")


if __name__ == "__main__":
    main()
