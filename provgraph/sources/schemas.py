"""Source-role schemas (only the columns the pipeline reads)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMERCIAL_CLAIMS = _schema(
    ("claim_year", I),
    ("service_to_date", I),  # packed YYYYMMDD
    ("rendering_npiid", L),
    ("billing_npiid", L),
    ("service_facility_npiid", L),
    ("dpid", L),  # patient
)

# One dataset for all Medicare claim files: partition columns vintage,
# release ('annual' / 'quarterly') and claim_type replace the year- and
# type-suffixed table names.
MEDICARE_CLAIMS = _schema(
    ("vintage", I),
    ("release", S),
    ("claim_type", S),
    ("clm_thru_dt", D),
    ("at_physn_npi", S),
    ("op_physn_npi", S),
    ("rndrng_physn_npi", S),
    ("org_npi_num", S),
    ("desy_sort_key", L),  # patient
)

# What Medicare files exist: one row per (vintage, release) with the latest
# service date in it.  Only for claims that are not partitioned by them:
# otherwise the folders tell the files (``sources.catalog``).
MEDICARE_AVAILABILITY = _schema(("vintage", I), ("release", S), ("max_clm_thru_dt", D))

# The same files without their dates, as folder names tell them.
MEDICARE_FILES = _schema(("vintage", I), ("release", S))

CROSSWALK = _schema(("npiid", L), ("npi", L), ("company_id", L))
PHYSICIANS = _schema(("npi", L))
COMPANIES = _schema(
    ("hospital_id", L), ("hospital_name", S), ("firm_type", S), ("hq_city", S), ("hq_state", S)
)
CLAIM_AVAILABILITY = _schema(("claim_date", D), ("analysis_type_id", I))
DIRECTORY_PHYSICIANS = _schema(
    ("npi", L),
    ("primary_affiliation_hospital_id", L),
    ("hospital_id2", L),
    ("hospital_id3", L),
    ("hospital_id4", L),
    ("hospital_id5", L),
)
GROUP_PRACTICE = _schema(("npi", L), ("hospital_id", L))
PHYSICIAN_GROUPS = _schema(("hospital_id", L))
CHILD_SITES = _schema(("hospital_id", L), ("pg_parent_id", L))

ROLE_SCHEMAS = {
    "commercial_claims": COMMERCIAL_CLAIMS,
    "medicare_claims": MEDICARE_CLAIMS,
    "medicare_availability": MEDICARE_AVAILABILITY,
    "crosswalk": CROSSWALK,
    "physicians": PHYSICIANS,
    "companies": COMPANIES,
    "claim_availability": CLAIM_AVAILABILITY,
    "directory_physicians": DIRECTORY_PHYSICIANS,
    "group_practice": GROUP_PRACTICE,
    "physician_groups": PHYSICIAN_GROUPS,
    "surgery_centers": CHILD_SITES,
    "imaging_centers": CHILD_SITES,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the schema's columns; fails fast on a missing column."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source is missing columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
