"""Summarise stage and task times from a Spark event log.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX)/ev python bench.py
    python tools/stage_times.py <that folder> [last_n_stages]

Prints, per stage: task count, wall time, slowest task and summed task time,
which is where skew (one slow task) and serial work (one task) show up.
"""

from __future__ import annotations

import collections
import io
import json
import os
import sys


def _event_files(folder: str):
    for root, _, names in os.walk(folder):
        for n in sorted(names):
            if n.startswith(("events_", "eventlog", "local-", "app-")) and not n.endswith(".crc"):
                yield os.path.join(root, n)


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        yield from io.TextIOWrapper(raw, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main(argv) -> None:
    folder = argv[1]
    last = int(argv[2]) if len(argv) > 2 else 20
    stages, tasks = {}, collections.defaultdict(list)
    for path in _event_files(folder):
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[e["Stage ID"]].append(ti["Finish Time"] - ti["Launch Time"])
    for sid in sorted(stages)[-last:]:
        name, n, wall = stages[sid]
        t = tasks[sid]
        print(f"stage {sid:4d}  tasks {n:4d}  wall {wall:7d} ms  max task {max(t) if t else 0:7d} ms  "
              f"sum {sum(t):8d} ms  {name}")


if __name__ == "__main__":
    main(sys.argv)
