"""Run the pipeline and publish every result table.

    python -m provgraph --roles s3://bucket/roles --out s3://bucket/affiliations
    spark-submit --py-files provgraph.zip provgraph/__main__.py --roles ... --out ...

``--roles`` holds one Parquet dataset per source role (see
``sources.Sources.from_parquet``); ``--testdata`` derives the roles from the
driver's TPC-H-style tables instead.  The session is the one the cluster
provides (``getOrCreate``), so its shuffle partitions and broadcast threshold
apply.  ``--work`` names the shared work folder where the session has no
``spark.checkpoint.dir``; one of the two is required.  Each table is a folder
below ``--out`` with a manifest per version; the data of a run is written once,
below ``_data``.  ``--mode append --run-id 2024`` adds a load to the tables;
repeating it, after a failure or not, leaves no row twice.
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession

from provgraph.config import PipelineConfig
from provgraph.plans.pipeline import run_and_publish
from provgraph.plans.publish import KEEP
from provgraph.sources.adapter import load_testdata
from provgraph.sources.tables import Sources


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="provgraph", description=__doc__.split("\n\n")[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--roles", help="folder with one Parquet dataset per source role")
    src.add_argument("--testdata", help="folder with the driver's *.parquet tables")
    p.add_argument("--out", required=True, help="folder of the published tables")
    p.add_argument("--work", help="shared work folder")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--run-id", help="names the load; required with --mode append")
    p.add_argument("--keep", type=int, default=KEEP, help="versions that stay readable")
    p.add_argument("--as-of", type=date.fromisoformat, help="UPDATE_DATE stamp (default: today)")
    p.add_argument("--min-claim-year", type=int)
    p.add_argument("--vintage-floor", type=int)
    p.add_argument("--min-claim-month", type=date.fromisoformat)
    args = p.parse_args(argv)
    if args.mode == "append" and not args.run_id:
        p.error("--mode append needs --run-id")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName("provgraph").config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark = (builder.config("spark.checkpoint.dir", args.work) if args.work else builder).getOrCreate()
    cfg = PipelineConfig.for_testdata() if args.testdata else PipelineConfig()
    overrides = {
        "as_of": args.as_of,
        "min_claim_year": args.min_claim_year,
        "vintage_floor": args.vintage_floor,
        "min_claim_month": args.min_claim_month,
    }
    cfg = replace(cfg, **{k: v for k, v in overrides.items() if v is not None})
    sources = load_testdata(spark, args.testdata) if args.testdata else Sources.from_parquet(spark, args.roles)
    run_and_publish(spark, sources, cfg, args.out, mode=args.mode, run_id=args.run_id, keep=args.keep)


if __name__ == "__main__":
    main()
