"""Directory (non-claim) affiliations (OP-17 .. OP-20)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECTORY_COLUMNS = ["npi", "hospital_id", "hospital_name", "firm_type", "hq_city", "hq_state"]

# Directory columns holding the physician's hospitals, by affiliation rank.
RANKED_ID_COLUMNS = [
    "primary_affiliation_hospital_id",
    "hospital_id2",
    "hospital_id3",
    "hospital_id4",
    "hospital_id5",
]


def _company_attrs(companies: DataFrame) -> DataFrame:
    return companies.select("hospital_id", "hospital_name", "firm_type", "hq_city", "hq_state")


def hospital_affiliations(physicians: DataFrame, companies: DataFrame, as_of: date) -> DataFrame:
    """OP-17: ranked directory affiliations, one row per (npi, company, rank).

    The five id columns become rows with ranks 1..5 (an ``inline`` in the row), join the
    company dimension and are de-duplicated (UNION semantics).
    """
    ranked = F.array(*[
        F.struct(F.col(c).alias("hospital_id"), F.lit(i + 1).alias("affiliation_rank"))
        for i, c in enumerate(RANKED_ID_COLUMNS)
    ])
    rows = physicians.select("npi", F.inline(ranked)).filter(F.col("hospital_id").isNotNull())
    return (
        rows.join(_company_attrs(companies), "hospital_id")
        .select(*DIRECTORY_COLUMNS, "affiliation_rank", F.lit(as_of).alias("update_date"))
        .distinct()
    )


def group_affiliations(
    group_practice: DataFrame, physicians: DataFrame, companies: DataFrame, as_of: date
) -> DataFrame:
    """OP-18: group-practice links of directory physicians (a bag, Q31)."""
    return (
        group_practice.join(physicians.select("npi"), "npi")
        .join(_company_attrs(companies), "hospital_id")
        .select(*DIRECTORY_COLUMNS, F.lit(as_of).alias("update_date"))
    )


def child_site_affiliations(
    physicians: DataFrame,
    group_practice: DataFrame,
    physician_groups: DataFrame,
    sites: DataFrame,
    companies: DataFrame,
    as_of: date,
) -> DataFrame:
    """OP-19 / OP-20: sites (surgery or imaging centres) owned by a physician
    group the physician practises in: physician -> group practice -> physician
    group -> site with that parent -> company.  A bag, like the original."""
    links = group_practice.select("npi", F.col("hospital_id").alias("group_id"))
    groups = physician_groups.select(F.col("hospital_id").alias("group_id"))
    owned = sites.select("hospital_id", F.col("pg_parent_id").alias("group_id"))
    return (
        physicians.select("npi")
        .join(links, "npi")
        .join(groups, "group_id")
        .join(owned, "group_id")
        .join(_company_attrs(companies), "hospital_id")
        .select(*DIRECTORY_COLUMNS, F.lit(as_of).alias("update_date"))
    )
