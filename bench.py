"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "final_affiliations_end_to_end", "value": sec, "unit": "sec",
 "queries": {...}, "sf": ...}

``value`` is the end-to-end time of the flagship (derive and stage the
source roles from the given tables, then build the published table).  Each
entry in ``queries`` runs one stage on the staged sources and forces full
execution with a ``noop`` write (no collect to the driver).  Times are the
median of ``$BENCH_RUNS`` warm runs (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from provgraph.config import PipelineConfig  # noqa: E402
from provgraph.plans.pipeline import AffiliationPipeline  # noqa: E402
from provgraph.plans.publish import Materializer  # noqa: E402
from provgraph.session import local_session  # noqa: E402
from provgraph.sources.adapter import StagedSources, derive_sources  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

STAGES = {
    "commercial_edges": lambda p: p.commercial_edges,
    "medicare_edges": lambda p: p.medicare_edges,
    "affiliation_summary": lambda p: p.affiliations,
    "claim_shares": lambda p: p.shares,
    "unique_patients_commercial": lambda p: p.patients_commercial,
    "unique_patients_medicare": lambda p: p.patients_medicare,
    "hospital_affiliations": lambda p: p.hospital_affiliations,
    "final_affiliations": lambda p: p.final,
    "scored": lambda p: p.scored,
}


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    work = os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="provgraph-bench-")
    cores = int(CPUS) if CPUS.isdigit() else 8
    spark = local_session(CPUS, shuffle_partitions=max(8, cores * 2), checkpoint_dir=f"{work}/ckpt")
    cfg = PipelineConfig.for_testdata()

    def end_to_end() -> None:
        m = Materializer(spark)
        src = StagedSources(spark, derive_sources(spark, SF_DIR), m)
        _noop(AffiliationPipeline(spark, src, cfg, m).final)

    end_to_end()  # warm-up (JIT, file listing caches)
    e2e = statistics.median(_timed(end_to_end) for _ in range(RUNS))

    m = Materializer(spark)
    staged = StagedSources(spark, derive_sources(spark, SF_DIR), m).stage_all()
    results = {}
    for name, stage in STAGES.items():
        times = []
        for _ in range(RUNS):
            # A fresh pipeline (and materialiser) per run: no reuse of earlier output.
            p = AffiliationPipeline(spark, staged, cfg, Materializer(spark))
            times.append(_timed(lambda: _noop(stage(p))))
        results[name] = round(statistics.median(times), 3)
    results["stage_sources"] = round(
        statistics.median(_timed(lambda: StagedSources(spark, derive_sources(spark, SF_DIR), Materializer(spark)).stage_all())
                          for _ in range(RUNS)),
        3,
    )
    m_sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "final_affiliations_end_to_end",
        "value": round(e2e, 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m_sf.group(1)) if m_sf else SF_DIR,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
