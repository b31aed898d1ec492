"""Registry: one query per operator, each run on the whole given tables.

Every query builds the sources from ``{sf_dir}/*.parquet`` with the adapter,
runs the pipeline up to its stage, and projects the stage's published
columns with the shared column types.  Doubles are rounded here, where two
engines are compared; the flagship of ``entry()`` is not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import rounded
from provgraph.operators import edges as E
from provgraph.plans.columns import COMPARE_DIGITS, column_type
from provgraph.plans.oracle import QUERIES as ORACLE_QUERIES
from provgraph.plans.pipeline import FUSED, AffiliationPipeline
from provgraph.sources.adapter import load_testdata


def pipeline_for(spark: SparkSession, sf_dir: str, cfg: PipelineConfig | None = None, key: str | None = None) -> AffiliationPipeline:
    """``key``: the query that alone is asked for; only what it reads several times is written then."""
    cfg = cfg or PipelineConfig.for_testdata()
    if key not in READ_AGAIN:
        return AffiliationPipeline(spark, load_testdata(spark, sf_dir), cfg)
    sources = load_testdata(spark, sf_dir, read_once=("commercial_claims",))
    return AffiliationPipeline(spark, sources, cfg, written=READ_AGAIN[key], by_physician=True)


def _typed(query: str, df: DataFrame, cols: list[str]) -> DataFrame:
    out = []
    for c in cols:
        t = column_type(query, c)
        e = F.col(c).cast(t)
        if t == "double":
            e = rounded(e, COMPARE_DIGITS)
        out.append(e.alias(c))
    return df.select(*out)


# query key -> stage of the pipeline
STAGES: dict[str, Callable[[AffiliationPipeline], DataFrame]] = {
    "commercial_billing_edges": lambda p: E.commercial_edges_by_role(p.commercial_grain, ("billing",)),
    "commercial_facility_edges": lambda p: E.commercial_edges_by_role(p.commercial_grain, ("service_facility",)),
    "vintage_selection": lambda p: p.vintages,
    "medicare_normalised_claims": lambda p: p.medicare_events,
    "medicare_attending_edges": lambda p: E.medicare_edges_by_role(E.medicare_events(p.medicare_grain, ("attending",))),
    "medicare_operating_edges": lambda p: E.medicare_edges_by_role(E.medicare_events(p.medicare_grain, ("operating",))),
    "medicare_rendering_edges": lambda p: E.medicare_edges_by_role(E.medicare_events(p.medicare_grain, ("rendering",))),
    "unified_edges": lambda p: p.unified_edges,
    "monthly_rollup": lambda p: p.monthly,
    "affiliation_summary": lambda p: p.affiliations,
    "physician_totals_commercial": lambda p: p.totals_commercial,
    "physician_totals_medicare": lambda p: p.totals_medicare,
    "claim_shares": lambda p: p.shares,
    "unique_patients_commercial": lambda p: p.patients_commercial,
    "unique_patients_medicare": lambda p: p.patients_medicare,
    "crosswalk_zero_filled": lambda p: p.crosswalk_zero_filled,
    "hospital_affiliations": lambda p: p.hospital_affiliations,
    "group_affiliations": lambda p: p.group_affiliations,
    "surgery_center_affiliations": lambda p: p.surgery_center_affiliations,
    "imaging_center_affiliations": lambda p: p.imaging_center_affiliations,
    "analysis_dates": lambda p: p.dates,
    "affiliation_decay": lambda p: p.decay,
    "affiliation_score": lambda p: p.scored,
    "score_buckets": lambda p: p.scored,
    "assembled_affiliations": lambda p: p.assembled,
    "other_source_flag": lambda p: p.assembled,
    "current_flag": lambda p: p.assembled,
    "firm_type_rank": lambda p: p.assembled,
    "directory_only_affiliations": lambda p: p.directory_only,
    "bucket_uplift": lambda p: p.final,
    "inclusion_flag": lambda p: p.final,
    "final_affiliations": lambda p: p.final,
}

# Queries on affiliations -> stages that they read several times.  The others are computed where they are used.
READ_AGAIN: dict[str, tuple[str, ...]] = {
    **dict.fromkeys(("monthly_rollup", "affiliation_summary", "affiliation_decay", "affiliation_score"), ()),
    "claim_shares": ("commercial_grain", "medicare_edges"),
    "score_buckets": ("affiliations",),
    **dict.fromkeys(
        ("assembled_affiliations", "other_source_flag", "current_flag", "firm_type_rank", "directory_only_affiliations",
         "bucket_uplift", "inclusion_flag", "final_affiliations"),
        FUSED,
    ),
}

FLAGSHIP = "final_affiliations"


def _make(key: str) -> Callable[[SparkSession, str], DataFrame]:
    cols = ORACLE_QUERIES[key][1]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _typed(key, STAGES[key](pipeline_for(spark, sf_dir, key=key)), cols)

    run.__name__ = key
    return run


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table as the pipeline computes it."""
    return pipeline_for(spark, sf_dir, key=FLAGSHIP).final


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _make(k) for k in STAGES}
