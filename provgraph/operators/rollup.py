"""Edge unification, monthly rollup and affiliation summary (OP-08 .. OP-10).

Plan shape: the five edge lists are unioned first, so the physician whitelist
and the crosswalk are each joined once (joins distribute over UNION ALL).
The unified edges are dealt once, by (npi, company): the monthly ``groupBy``,
the LAG window and the summary find their rows there.  Edges are counted by
role, vintage and month already, so a pair has at most a few for each month and
organisation of its company.  Companies are joined after the summary, or with
the organisations where the edges are dealt by physician alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import month_diff
from provgraph.operators.edges import EDGE_COLUMNS

UNIFIED_COLUMNS = [
    "physician_npi",
    "company_id",
    "claim_month",
    "min_service_to_date",
    "max_service_to_date",
    "commercial_claims",
    "medicare_claims",
    "min_date_comm",
    "min_date_mcr",
    "max_date_comm",
    "max_date_mcr",
]

#: What the assembly adds by (physician, company), as columns that rows of their own may bring along with the edges.
FEATURES = {"in_directory": "boolean", "patients_comm": "long", "patients_mcr": "long"}
#: What a company's id determines, as columns that may come along with the organisations.
NAMES = ["hospital_name", "firm_type"]

SUMMARY_COLUMNS = [
    "physician_npi",
    "company_id",
    "hospital_name",
    "firm_type",
    "min_date",
    "max_date",
    "min_date_comm",
    "max_date_comm",
    "min_date_mcr",
    "max_date_mcr",
    "avg_month_lag",
    "min_month_lag",
    "max_month_lag",
    "months",
    "months_mcr",
    "months_comm",
    "months_denom",
    "comm_claims",
    "mcr_claims",
]


def unify_edges(
    commercial_edges: DataFrame,
    medicare_edges: DataFrame,
    physicians: DataFrame,
    crosswalk: DataFrame,
    by_physician: bool = False,
    features: DataFrame | None = None,
    companies: DataFrame | None = None,
) -> DataFrame:
    """OP-08: all edge lists in one shape, physicians whitelisted, orgs resolved to companies.

    ``commercial_edges`` / ``medicare_edges`` carry :data:`EDGE_COLUMNS` (any
    extra role column is ignored).  Commercial measures are zero and its dates
    NULL on Medicare rows and vice versa.

    ``by_physician``: organisations are resolved first, then the rows are dealt
    by physician, narrow as they are, for the whitelist and all that follows
    (months, summary, totals, rank).  Blank ids (NPI 0), the one id that any
    number of claims can share, are dropped before unless they are on the list.
    ``features``: rows (physician, company, :data:`FEATURES`) without a month,
    dealt with the edges, so that no join by both keys has to bring them.
    ``companies``: its names come along with the organisations, and edges of
    other companies go; then no later join by company has to deal the wider
    rows of the summary.  Features have no names; a pair that has nothing else
    is no affiliation.
    """
    edges = commercial_edges.select(F.lit(True).alias("is_comm"), *EDGE_COLUMNS).unionByName(
        medicare_edges.select(F.lit(False).alias("is_comm"), *EDGE_COLUMNS)
    )
    whitelist = physicians.select(F.col("npi").alias("physician_npi"))
    companies_of = crosswalk.select(F.col("npi").alias("org_npi"), "company_id")
    comm = F.col("is_comm")
    brought: list[str] = []
    if companies is not None:
        companies_of, brought = companies_of.join(_names_of(companies), "company_id"), NAMES
    if by_physician:
        blank_listed = physicians.select(F.coalesce(F.max(F.col("npi") == 0), F.lit(False))).scalar()
        rows = edges.filter((F.col("physician_npi") != 0) | blank_listed).join(companies_of, "org_npi").drop("org_npi")
        if features is not None:
            rows, brought = rows.unionByName(features, allowMissingColumns=True), [*brought, *FEATURES]
        resolved = rows.repartition("physician_npi").join(whitelist, "physician_npi")
    else:
        resolved = edges.join(whitelist, "physician_npi").join(companies_of, "org_npi")
    return (
        resolved.select(
            "physician_npi",
            "company_id",
            "claim_month",
            "min_service_to_date",
            "max_service_to_date",
            F.when(comm, F.col("claims")).otherwise(F.lit(0)).cast("long").alias("commercial_claims"),
            F.when(comm, F.lit(0)).otherwise(F.col("claims")).cast("long").alias("medicare_claims"),
            F.when(comm, F.col("min_service_to_date")).alias("min_date_comm"),
            F.when(~comm, F.col("min_service_to_date")).alias("min_date_mcr"),
            F.when(comm, F.col("max_service_to_date")).alias("max_date_comm"),
            F.when(~comm, F.col("max_service_to_date")).alias("max_date_mcr"),
            *brought,
        )
    )


def _names_of(companies: DataFrame) -> DataFrame:
    return companies.select(F.col("hospital_id").alias("company_id"), *NAMES)


def _brought_names(df: DataFrame) -> list[str]:
    return [c for c in NAMES if c in df.columns]


def _features_of(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


def monthly_rollup(unified: DataFrame, claim_availability: DataFrame, cfg: PipelineConfig, by_physician: bool = False) -> DataFrame:
    """OP-09: one row per (physician, company, month) with the gap to the previous month.

    Months are kept from ``cfg.min_claim_month`` up to the latest available
    claim date of any analysis type (Q9); the bound is a scalar subquery, not
    a driver round trip.  ``by_physician``: ``unified`` is dealt already.
    Features of a pair (:func:`unify_edges`) stay a row without a month.
    """
    max_claim_date = claim_availability.select(F.max("claim_date")).scalar()
    month = F.col("claim_month")
    features = _features_of(unified)
    kept = (month >= F.lit(cfg.min_claim_month)) & (month <= max_claim_date)
    for c in features:
        kept = kept | F.col(c).isNotNull()
    rows = unified.filter(kept)
    monthly = (
        (rows if by_physician else rows.repartition("physician_npi", "company_id"))
        .groupBy("physician_npi", "company_id", "claim_month")
        .agg(
            F.min("min_service_to_date").alias("min_date"),
            F.max("max_service_to_date").alias("max_date"),
            F.min("min_date_comm").alias("min_date_comm"),
            F.max("max_date_comm").alias("max_date_comm"),
            F.min("min_date_mcr").alias("min_date_mcr"),
            F.max("max_date_mcr").alias("max_date_mcr"),
            F.sum("commercial_claims").alias("commercial_claims"),
            F.sum("medicare_claims").alias("medicare_claims"),
            *[F.max(c).alias(c) for c in (*_brought_names(unified), *features)],
        )
    )
    w = Window.partitionBy("physician_npi", "company_id").orderBy("claim_month")
    return monthly.withColumn("last_mth", F.lag("claim_month").over(w)).withColumn(
        "months_between", month_diff("claim_month", "last_mth")
    )


def affiliation_summary(monthly: DataFrame, companies: DataFrame) -> DataFrame:
    """OP-10: one row per (physician, company) with 19 measures.

    Rows of ``monthly`` are unique per (physician, company, month), so the
    three distinct month counts of the original are plain (conditional)
    counts.  Companies must be keyed by ``hospital_id`` (as the company
    dimension is); the join then keeps one row per affiliation.  It is left out
    if ``monthly`` has the names already.  Features are taken over; a pair that
    has nothing else is no affiliation.
    """
    month, features = F.col("claim_month"), _features_of(monthly)
    # Aggregates, so that a query without the names does not carry them.
    named = _brought_names(monthly)
    summary = monthly.groupBy("physician_npi", "company_id").agg(
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.min("min_date_comm").alias("min_date_comm"),
        F.max("max_date_comm").alias("max_date_comm"),
        F.min("min_date_mcr").alias("min_date_mcr"),
        F.max("max_date_mcr").alias("max_date_mcr"),
        F.avg("months_between").alias("avg_month_lag"),
        F.min("months_between").alias("min_month_lag"),
        F.max("months_between").alias("max_month_lag"),
        F.count(month).alias("months"),
        F.count(F.when(F.coalesce(F.col("medicare_claims"), F.lit(0)) > 0, month)).alias("months_mcr"),
        F.count(F.when(F.coalesce(F.col("commercial_claims"), F.lit(0)) > 0, month)).alias("months_comm"),
        (month_diff(F.max(month), F.min(month)) + 1).cast("long").alias("months_denom"),
        F.sum("commercial_claims").alias("comm_claims"),
        F.sum("medicare_claims").alias("mcr_claims"),
        *[F.max(c).alias(c) for c in (*named, *features)],
    )
    if features:
        summary = summary.filter(F.col("months") > 0)
    if not named:
        summary = summary.join(_names_of(companies), "company_id")
    return summary.select(*SUMMARY_COLUMNS, *features)
