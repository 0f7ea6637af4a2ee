"""Stage/task times from a Spark event log (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing at a scratch folder, then:

    python tools/eventlog_summary.py <event-log file or folder>

Prints per job its duration and stages, and per stage task count, wall
time, summed and maximum task run time (a max far above sum/count means a
straggler or a skewed partition).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events*"))) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode().splitlines()


def summarize(path: str) -> dict:
    jobs, stages, tasks = {}, {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["ms"] = e["Completion Time"] - jobs[e["Job ID"]]["start"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = {"name": si["Stage Name"], "tasks": si["Number of Tasks"],
                                      "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0)}
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            tasks.setdefault(e["Stage ID"], []).append(e["Task Metrics"]["Executor Run Time"])
    for sid, st in stages.items():
        t = tasks.get(sid, [])
        st.update(task_ms_sum=sum(t), task_ms_max=max(t) if t else 0)
    return {"jobs": jobs, "stages": stages}


def main() -> None:
    path = sys.argv[1]
    if os.path.isdir(path) and not glob.glob(os.path.join(path, "events*")):
        path = sorted(glob.glob(os.path.join(path, "eventlog_v2_*")) or glob.glob(os.path.join(path, "*")))[-1]
    s = summarize(path)
    t0 = min((j["start"] for j in s["jobs"].values()), default=0)
    for jid, j in sorted(s["jobs"].items()):
        print(f"job {jid:4d} +{j['start'] - t0:7d} ms  {j.get('ms', -1):7d} ms  stages {j['stages']}")
    for sid, st in sorted(s["stages"].items()):
        print(f"stage {sid:4d} tasks {st['tasks']:5d} wall {st['ms']:7d} ms  task sum {st['task_ms_sum']:8d} "
              f"max {st['task_ms_max']:7d}  {st['name'][:50]}")


if __name__ == "__main__":
    main()
