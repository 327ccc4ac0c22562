"""Summarise a Spark event log: per job group (query) the number of stages
run and their wall time, and the slowest stages overall.

Usage: BENCH_EVENT_LOG=/tmp/evlog python bench.py; python scripts/stage_times.py /tmp/evlog
(bench.py tags every timed query with its name as the job group).
"""

from __future__ import annotations

import collections
import glob
import json
import os
import signal
import sys

signal.signal(signal.SIGPIPE, signal.SIG_DFL)  # quiet when piped into head


def events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        base = os.path.basename(path)
        if not (base.startswith("events") or base.startswith("local-") or base.startswith("app-")) or os.path.isdir(path):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    group_of, stages = {}, {}
    for e in events(folder):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id") or "-"
            for si in e["Stage Infos"]:
                group_of[si["Stage ID"]] = g
        elif kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Submission Time" in si and "Completion Time" in si:
                stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"], si["Completion Time"] - si["Submission Time"])
    per = collections.defaultdict(lambda: [0, 0])
    for sid, (_, _, ms) in stages.items():
        g = group_of.get(sid, "-")
        per[g][0] += 1
        per[g][1] += ms
    print(f"{'query':32s} {'stages':>6s} {'stage ms':>9s}")
    for g, (n, ms) in sorted(per.items(), key=lambda kv: -kv[1][1]):
        print(f"{g:32s} {n:6d} {ms:9d}")
    print("\nslowest stages:")
    for sid, (name, tasks, ms) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:10]:
        print(f"  stage {sid:5d} {ms:7d} ms {tasks:5d} tasks  [{group_of.get(sid, '-')}] {name}")


if __name__ == "__main__":
    main()
