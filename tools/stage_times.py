"""Stage and task times from a Spark event log (no UI needed).

Usage: BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py "$BENCH_EVENT_LOG" [top_n]
Reads every event file under the folder (plain or .zstd) and prints the stage count,
the sum and distribution of stage durations, executor run time, and the slowest stages.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys


def events(folder: str):
    for f in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if os.path.isdir(f) or os.path.basename(f).startswith("appstatus"):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, run_ms, tasks = [], 0, 0
    for e in events(folder):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages.append((si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Number of Tasks"],
                           si["Stage Name"][:90]))
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            run_ms += e["Task Metrics"]["Executor Run Time"]
            tasks += 1
    if not stages:
        print("no completed stages found")
        return
    d = sorted(s[0] for s in stages)
    print(f"stages {len(stages)}  tasks {tasks}  sum stage ms {sum(d)}  executor run ms {run_ms}")
    print(f"stage ms: median {statistics.median(d)}  p90 {d[int(0.9 * (len(d) - 1))]}  max {d[-1]}")
    for ms, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:>8} ms  {n:>5} tasks  {name}")


if __name__ == "__main__":
    main()
