"""Stage and task times from a Spark event log (no UI, no REST server).

Usage:
    BENCH_EVENTLOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py q1 q2
    python tools/stage_profile.py $BENCH_EVENTLOG_DIR [min_stage_ms]

Prints every stage that ran at least ``min_stage_ms`` (default 500):
duration, task count, the operators it covers, and its slowest tasks with
input / shuffle-read record counts. A stage with one long task and many
empty ones is a single-split scan; one with a single task far above the
others is a hot key.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "eventlog*", "events_*"))) or sorted(
        glob.glob(os.path.join(path, "*"))
    )
    for name in files:
        if os.path.isdir(name):
            continue
        if name.endswith(".zstd"):
            import zstandard

            with open(name, "rb") as fh:
                yield from io.TextIOWrapper(
                    zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8"
                )
        else:
            with open(name, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    min_ms = float(sys.argv[2]) if len(sys.argv) > 2 else 500.0
    stages: dict[int, tuple[int, int, list[str]]] = {}
    tasks: dict[int, list[tuple[int, int, int]]] = collections.defaultdict(list)
    for line in _lines(path):
        event = json.loads(line)
        kind = event["Event"]
        if kind == "SparkListenerStageCompleted":
            info = event["Stage Info"]
            duration = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            scopes: list[str] = []
            for rdd in info["RDD Info"]:
                scope = rdd.get("Scope")
                if scope:
                    name = json.loads(scope)["name"]
                    if name not in scopes:
                        scopes.append(name)
            stages[info["Stage ID"]] = (duration, info["Number of Tasks"], scopes)
        elif kind == "SparkListenerTaskEnd":
            info, metrics = event["Task Info"], event.get("Task Metrics") or {}
            read = metrics.get("Input Metrics", {}).get("Records Read", 0)
            shuffled = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            tasks[event["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], read, shuffled))
    for stage_id, (duration, n_tasks, scopes) in sorted(stages.items()):
        if duration < min_ms:
            continue
        print(f"stage {stage_id}: {duration} ms, {n_tasks} tasks, {scopes}")
        slowest = sorted(tasks[stage_id], reverse=True)[:8]
        print("   slowest tasks (ms, input records, shuffle records):", slowest)


if __name__ == "__main__":
    main()
