"""Analysis dates and time decay (OP-21, OP-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
DECAY_COLUMNS = [
    "physician_npi",
    "company_id",
    "current_month_lag",
    "avg_month_lag",
    "max_month_lag",
    "decay_rate",
    "current_decay_remaining_val",
    "update_date",
]


def analysis_dates(
    claim_availability: DataFrame, medicare_availability: DataFrame, cfg: PipelineConfig
) -> DataFrame:
    """OP-21: one row with the commercial and Medicare analysis dates.

    Commercial: latest claim date of analysis type 1, minus
    ``cfg.commercial_lag_months`` months, plus one day.  Medicare: latest
    service date of the newest vintage's quarterly file (of its annual file
    only where it has no quarterly one), plus one day (Q30); this is not the
    release that OP-03 picks for the claims.
    """
    newest = F.max(F.struct("vintage", (F.col("release") == "quarterly").alias("quarterly"), "max_clm_thru_dt"))
    medicare = medicare_availability.filter(F.col("vintage") > cfg.vintage_floor).agg(newest.alias("file"))
    commercial = claim_availability.filter(F.col("analysis_type_id") == 1).agg(F.max("claim_date").alias("last"))
    return commercial.select(
        F.date_add(F.add_months("last", -cfg.commercial_lag_months), 1).alias("dt_comm"),
        medicare.select(F.date_add(F.col("file.max_clm_thru_dt"), 1)).scalar().alias("dt_mcr"),
    )


def _month_index(date: Column | str) -> Column:
    """Calendar months since year 0; differences are month boundaries crossed."""
    return F.year(date) * 12 + F.month(date)


def with_decay(affiliations: DataFrame, dates: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Add ``current_month_lag``, ``decay_rate`` and ``current_decay_remaining_val``.

    ``rate = floor^(1/(max_lag+1)) - 1`` (max_lag NULL -> 1).  The clock is
    the analysis date of the source that owns MAX_DATE (commercial on ties,
    Q17); the remaining value is 1 while the current lag is within the
    average gap, else ``(1+rate)^lag`` (Q15: the formula as written).  The
    one-row ``dates`` frame is read as a single struct, as month indexes.
    """
    clocks = dates.select(F.struct(_month_index("dt_comm").alias("comm"), _month_index("dt_mcr").alias("mcr"))).scalar()
    max_lag = F.coalesce(F.col("max_month_lag"), F.lit(1)).cast("double")
    rate = F.pow(F.lit(cfg.decay_floor), F.lit(1.0) / (max_lag + 1)) - 1
    comm_owns = F.coalesce(F.col("max_date_comm"), F.lit("1900-01-01").cast("date")) == F.col("max_date")
    with_clock = affiliations.withColumn("_clock", clocks)
    lag = F.when(comm_owns, F.col("_clock.comm")).otherwise(F.col("_clock.mcr")) - _month_index("max_date")
    with_lag = with_clock.withColumns({"current_month_lag": lag, "decay_rate": rate}).drop("_clock")
    remaining = F.when(
        F.col("current_month_lag") <= F.coalesce(F.col("avg_month_lag"), F.lit(1.0)), F.lit(1.0)
    ).otherwise(F.pow(1 + F.col("decay_rate"), F.col("current_month_lag")))
    return with_lag.withColumn("current_decay_remaining_val", remaining)


def decay_table(decayed: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """OP-22: the decay measures per affiliation, stamped."""
    return decayed.withColumn("update_date", F.lit(cfg.as_of)).select(*DECAY_COLUMNS)


def decay(affiliations: DataFrame, dates: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return decay_table(with_decay(affiliations, dates, cfg), cfg)
