"""Named parameters of the pipeline (literals in the original SQL)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class PipelineConfig:
    # Commercial claims are kept from this CLAIM_YEAR on.
    min_claim_year: int = 2016
    # Medicare vintages (file years) strictly greater than this are used.
    vintage_floor: int = 2015
    # Monthly rollup keeps months on or after this date.
    min_claim_month: date = date(2016, 1, 1)
    # Commercial analysis date = max claim date - N months + 1 day.
    commercial_lag_months: int = 3
    # Decay reaches this remaining value one month after the maximum gap.
    decay_floor: float = 0.1
    # An affiliation is "current" when its remaining value is at least this.
    current_threshold: float = 0.1
    # Share of practice above which an affiliation may be included.
    share_threshold: float = 0.05
    # Number of equal-width score buckets.
    n_buckets: int = 10
    # Stamp for UPDATE_DATE columns (CURRENT_DATE in the original).
    as_of: date = field(default_factory=date.today)
    # Decimal places used to make float boundaries deterministic (Q16, Q20, Q22).
    boundary_digits: int = 9
    # Without effect: the rollup always deals the unified edges by (physician, company).
    copartition_rollup: bool = False

    @staticmethod
    def for_testdata() -> "PipelineConfig":
        """Cut-offs shifted to the driver's 1995-2001 date range."""
        return PipelineConfig(
            min_claim_year=1996,
            vintage_floor=1995,
            min_claim_month=date(1996, 1, 1),
            as_of=date(2001, 11, 5),
        )
