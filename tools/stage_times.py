"""Summarise a Spark event log (zstd or plain): slowest stages and job times.

Usage: python tools/stage_times.py <event-log-dir> [job-group]
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def events(path: str):
    for f in sorted(glob.glob(f"{path}/**/events*", recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    group = sys.argv[2] if len(sys.argv) > 2 else None
    stages, jobs = {}, {}
    for e in events(path):
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"],
                                      si["Stage Name"][:70])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], (e.get("Properties") or {}).get("spark.jobGroup.id"), None]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][2] = e["Completion Time"] - jobs[e["Job ID"]][0]
    print("stages", len(stages), "sum of stage ms", sum(v[0] for v in stages.values()))
    for k, v in sorted(stages.items(), key=lambda kv: -kv[1][0])[:15]:
        print(" stage", k, v)
    sel = [(k, v[2]) for k, v in jobs.items() if group is None or v[1] == group]
    print("jobs", len(sel), "ms", sum(d or 0 for _, d in sel))
    print(sel[:40])


if __name__ == "__main__":
    main()
