"""Affiliation score and equal-width buckets (OP-23, OP-24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from provgraph.config import PipelineConfig
from provgraph.functions.dialect import month_diff, rounded

SCORE_PARTS = ["log_pct_months_mcr", "log_pct_months_comm", "log_months", "log_claims", "log_avg_month_lag"]


def _log_pct_months(months: str, lo: str, hi: str) -> Column:
    span = month_diff(hi, lo) + 1
    pct = F.col(months).cast("double") / span * 100
    return F.when(F.col(hi).isNull(), F.lit(0.0)).when(span == 1, F.lit(0.0)).otherwise(F.log10(pct))


def with_score(affiliations: DataFrame) -> DataFrame:
    """OP-23: add the five log terms and ``score``.

    score = log10(100 * active months / span) per source (0 if the source is
    absent or spans one month) + log10(months) + log10(claims)
    - log10(avg gap) (0 without a gap).  The formula, not the comment of the
    original, is what is computed (Q19).
    """
    parts = {
        "log_pct_months_mcr": _log_pct_months("months_mcr", "min_date_mcr", "max_date_mcr"),
        "log_pct_months_comm": _log_pct_months("months_comm", "min_date_comm", "max_date_comm"),
        "log_months": F.log10(F.col("months").cast("double")),
        "log_claims": F.log10((F.col("comm_claims") + F.col("mcr_claims")).cast("double")),
        "log_avg_month_lag": F.when(F.col("avg_month_lag").isNull(), F.lit(0.0)).otherwise(
            F.log10(F.col("avg_month_lag"))
        ),
    }
    scored = affiliations.withColumns(parts)
    c = [F.col(p) for p in SCORE_PARTS]
    return scored.withColumn("score", c[0] + c[1] + c[2] + c[3] - c[4])


def observe_score(affiliations: DataFrame, seen: Observation) -> DataFrame:
    """The same rows; ``seen`` gets the least (``lo``) and greatest (``hi``) score while they are written."""
    return observe_bounds(with_score(affiliations), seen).select(*affiliations.columns)


def observe_bounds(scored: DataFrame, seen: Observation) -> DataFrame:
    return scored.observe(seen, F.min("score").alias("lo"), F.max("score").alias("hi"))


def equal_width_bucket(df: DataFrame, value: str, n: int, digits: int, bounds: Column | None = None) -> DataFrame:
    """OP-24: add ``score_bucket`` = ``ceil((v - min) / ((max - min) / n))``, values below 1 raised to 1.

    min and max are the struct ``bounds`` (``lo``, ``hi``) if they are known,
    else that of one aggregate over ``df``, never from a keyless window.  The quotient is rounded to ``digits`` places before
    ``ceil`` so that last-bit differences cannot move a row across a bucket
    edge (Q20); a degenerate range (all values equal) puts every row in
    bucket 1.
    """
    if bounds is None:
        bounds = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = F.col("_bounds.lo"), F.col("_bounds.hi")
    width = (hi - lo) / F.lit(float(n))
    raw = F.ceil(rounded(F.try_divide(F.col(value) - lo, width), digits)).cast("long")
    one = F.lit(1).cast("long")
    bucket = F.when(F.col(value).isNull(), F.lit(None).cast("long")).when(width == 0, one).when(raw < 1, one).otherwise(raw)
    return df.withColumn("_bounds", bounds).withColumn("score_bucket", bucket).drop("_bounds")


def with_score_bucket(scored: DataFrame, cfg: PipelineConfig, seen: Observation | None = None) -> DataFrame:
    """``seen``: that of :func:`observe_score`, once the affiliations are written."""
    bounds = None if seen is None else F.struct(*[F.lit(seen.get[x]).cast("double").alias(x) for x in ("lo", "hi")])
    return equal_width_bucket(scored, "score", cfg.n_buckets, cfg.boundary_digits, bounds)
