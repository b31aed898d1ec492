"""Per-query seconds, shuffle bytes and exchange counts at one scale factor.

Usage: python tools/plan_stats.py [sf_dir] [runs]

Runs each bench stage on staged sources with a ``noop`` write (materialisation
points on, as in the bench), tags it with a job group, and reads shuffle bytes
and the number of shuffle stages actually executed (exchanges after AQE reuse)
from the Spark event log written to a fresh scratch folder.
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import STAGES  # noqa: E402
from provgraph.config import PipelineConfig  # noqa: E402
from provgraph.plans.pipeline import AffiliationPipeline  # noqa: E402
from provgraph.plans.publish import Materializer  # noqa: E402
from provgraph.session import local_session  # noqa: E402
from provgraph.sources.adapter import load_testdata  # noqa: E402
from tools.stage_times import events  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    work = tempfile.mkdtemp(prefix="provgraph-stats-")
    spark = local_session(8, shuffle_partitions=16, checkpoint_dir=f"{work}/ckpt", event_log_dir=f"{work}")
    cfg = PipelineConfig.for_testdata()
    staged = load_testdata(spark, sf_dir).stage_all()
    rows = []
    for name, stage in STAGES.items():
        times = []
        for i in range(runs):
            p = AffiliationPipeline(spark, staged, cfg, Materializer(spark))
            spark.sparkContext.setJobGroup(f"{name}#{i}", name)
            t = time.perf_counter()
            # building the stage runs its materialisation points, so it is timed too
            stage(p).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        rows.append([name, statistics.median(times)])
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    stage_group, shuffle_bytes, shuffle_stages = {}, defaultdict(int), defaultdict(set)
    jobs, stages = defaultdict(int), defaultdict(set)
    for e in events(work):
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            jobs[g] += 1
            for s_id in e.get("Stage IDs", []):
                stage_group[s_id] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            g = stage_group.get(e["Stage ID"])
            stages[g].add(e["Stage ID"])
            m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
            written = m.get("Shuffle Bytes Written", 0)
            if g and written:
                shuffle_bytes[g] += written
                shuffle_stages[g].add(e["Stage ID"])
    print("| query | seconds (median) | shuffle bytes / run | shuffle stages / run | jobs / run | stages / run |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, sec in rows:
        per_run = statistics.median(shuffle_bytes.get(f"{name}#{i}", 0) for i in range(runs))
        n_stages = statistics.median(len(shuffle_stages.get(f"{name}#{i}", ())) for i in range(runs))
        n_jobs = statistics.median(jobs[f"{name}#{i}"] for i in range(runs))
        n_all = statistics.median(len(stages[f"{name}#{i}"]) for i in range(runs))
        print(f"| {name} | {sec:.2f} | {per_run / 1e6:.1f} MB | {n_stages:g} | {n_jobs:g} | {n_all:g} |")


if __name__ == "__main__":
    main()
