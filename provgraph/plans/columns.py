"""Result column types shared by the query registry and the SQL oracle.

Column names are the same across all stages, so one map fixes the type of
every published column in both engines.
"""

from __future__ import annotations

COLUMN_TYPES: dict[str, str] = {
    "physician_npi": "bigint",
    "npi": "bigint",
    "company_id": "bigint",
    "hospital_id": "bigint",
    "org_npi": "bigint",
    "org_role": "string",
    "role": "string",
    "claim_month": "date",
    "claims": "bigint",
    "min_service_to_date": "date",
    "max_service_to_date": "date",
    "vintage": "int",
    "release": "string",
    "claim_type": "string",
    "service_to_date": "date",
    "patient": "bigint",
    "commercial_claims": "bigint",
    "medicare_claims": "bigint",
    "min_date": "date",
    "max_date": "date",
    "min_date_comm": "date",
    "max_date_comm": "date",
    "min_date_mcr": "date",
    "max_date_mcr": "date",
    "last_mth": "date",
    "months_between": "int",
    "hospital_name": "string",
    "firm_type": "string",
    "hq_city": "string",
    "hq_state": "string",
    "avg_month_lag": "double",
    "min_month_lag": "int",
    "max_month_lag": "int",
    "months": "bigint",
    "months_mcr": "bigint",
    "months_comm": "bigint",
    "months_denom": "bigint",
    "comm_claims": "bigint",
    "mcr_claims": "bigint",
    "physician_total_claims_comm": "bigint",
    "physician_total_claims_mcr": "bigint",
    "pct_claims": "double",
    "pct_claims_mcr": "double",
    "pct_claims_comm": "double",
    "patients_comm": "bigint",
    "patients_mcr": "bigint",
    "affiliation_rank": "int",
    "update_date": "date",
    "dt_comm": "date",
    "dt_mcr": "date",
    "current_month_lag": "int",
    "decay_rate": "double",
    "current_decay_remaining_val": "double",
    "log_pct_months_mcr": "double",
    "log_pct_months_comm": "double",
    "log_months": "double",
    "log_claims": "double",
    "log_avg_month_lag": "double",
    "score": "double",
    "score_bucket": "bigint",
    "other_source_flag": "int",
    "current_flag": "int",
    "firm_type_rank": "int",
    "include_flag": "int",
}

DUCKDB_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR"}

# Doubles are compared after rounding to this many places in both engines.
COMPARE_DIGITS = 6

# Per-query overrides: Medicare patients keep the raw physician id string.
OVERRIDES = {"unique_patients_medicare": {"physician_npi": "string"}}


def column_type(query: str, column: str) -> str:
    return OVERRIDES.get(query, {}).get(column, COLUMN_TYPES[column])
