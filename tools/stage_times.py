"""Job and stage timings from a Spark event log (plain or zstd-compressed).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder>
"""

from __future__ import annotations

import collections
import glob
import io
import json
import sys


def _lines(path: str):
    with open(path, "rb") as f:
        raw = f.read()
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()


def main() -> None:
    root = sys.argv[1]
    files = sorted(glob.glob(f"{root}/**/events_*", recursive=True)) or \
        sorted(glob.glob(f"{root}/*local-*"))
    jobs, stages = {}, {}
    tasks = collections.defaultdict(list)
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
            elif kind == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                stages[info["Stage ID"]] = (info["Stage Name"][:40], info["Number of Tasks"],
                                            info["Completion Time"] - info["Submission Time"])
            elif kind == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                tasks[e["Stage ID"]].append((m.get("Executor Run Time", 0),
                                             m.get("Executor CPU Time", 0) / 1e6,
                                             m.get("JVM GC Time", 0)))
    for job_id, (start, end, stage_ids) in sorted(jobs.items()):
        print(f"job {job_id}: {(end or start) - start} ms, stages {stage_ids}")
    for sid in sorted(stages):
        name, n, ms = stages[sid]
        t = tasks[sid] or [(0, 0, 0)]
        print(f"  stage {sid:4d} {name:40s} tasks={n:5d} wall={ms:6d} ms "
              f"max_task={max(x[0] for x in t)} ms cpu={sum(x[1] for x in t):.0f} ms "
              f"gc={sum(x[2] for x in t)} ms")


if __name__ == "__main__":
    main()
