"""Summarise a Spark event log (as written by ``BENCH_EVENT_LOG=1 python bench.py``).

Prints job and stage counts, total stage time and the slowest stages, reading the log
offline (no UI or REST endpoint). Usage: python tools/stage_times.py <event-log dir> [top]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        yield from data.decode().splitlines()
    else:
        with open(path) as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
             if os.path.isfile(f) and "appstatus" not in os.path.basename(f)]
    jobs, stages = 0, []
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerJobStart":
                jobs += 1
            elif e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages.append((ms, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:60]))
    print(f"jobs {jobs}  stages {len(stages)}  stage time {sum(s[0] for s in stages) / 1000:.1f} s")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"  stage {sid:5d}  {ms:7d} ms  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
