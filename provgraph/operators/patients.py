"""Unique patients per affiliation (OP-14 .. OP-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import canonical_long
from provgraph.operators.edges import (
    MEDICARE_ROLES,
    billed_by_other,
    commercial_claim_grain,
    commercial_roles,
    expand_roles,
    medicare_claim_grain,
    selected_claims,
)


def unique_patients_commercial(
    claims: DataFrame | None, crosswalk: DataFrame | None, cfg: PipelineConfig, resolved: DataFrame | None = None
) -> DataFrame:
    """OP-14: distinct (physician, company, patient) through the billing id and
    through the facility id, counted per (physician, company).

    Both halves require billing <> rendering, so a facility claim without a
    billing id is lost (Q10).  A NULL patient counts once (COUNT(*) over
    distinct rows, Q11).  The DISTINCT runs partial + final, so a dominant
    (physician, company) pair is collapsed map-side before the count.
    ``resolved``: :func:`edges.commercial_claim_grain` of the claims, if at hand.
    """
    if resolved is None:
        resolved = commercial_claim_grain(claims, crosswalk, cfg)
    billed = commercial_roles(resolved.filter(billed_by_other()))
    return (
        billed.filter(F.col("org_company_id").isNotNull())
        .select("physician_npi", F.col("org_company_id").alias("company_id"), "dpid")
        .dropDuplicates()
        .groupBy("physician_npi", "company_id")
        .agg(F.count(F.lit(1)).alias("patients_comm"))
    )


def crosswalk_zero_filled(crosswalk: DataFrame) -> DataFrame:
    """OP-16: (NPI, company) with a missing company as 0 (Q13)."""
    return crosswalk.select("npi", F.coalesce(F.col("company_id"), F.lit(0)).cast("long").alias("company_id"))


def unique_patients_medicare(
    claims: DataFrame | None, available: DataFrame | None, crosswalk: DataFrame, cfg: PipelineConfig, grain: DataFrame | None = None
) -> DataFrame:
    """OP-15: distinct patients per (raw physician id string, company) over all
    roles, claim types and selected vintages.

    No role filter, no cast, blank and NULL physician ids kept (Q12), trailing
    blanks ignored; the org id joins the zero-filled crosswalk by its string
    form, done here as an exact numeric join on the canonical value.
    ``grain``: :func:`edges.medicare_claim_grain` of the selected claims, if at hand.
    """
    if grain is None:
        grain = medicare_claim_grain(selected_claims(claims, available, cfg))
    roles = expand_roles(grain, {r: {"physician_npi": c} for r, c in MEDICARE_ROLES.items()}, "role")
    return (
        roles.select("physician_npi", canonical_long("org_npi_num").alias("npi"), "desy_sort_key")
        .join(crosswalk_zero_filled(crosswalk), "npi")
        .groupBy("physician_npi", "company_id")
        .agg(F.count_distinct("desy_sort_key").alias("patients_mcr"))
    )
