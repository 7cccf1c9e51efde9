"""Business constants, in one place so a caller can vary any of them."""

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# Delinquency buckets from best to worst, and the groups used in rates.
BUCKETS = ("DPD_0", "DPD_1_29", "DPD_30_59", "DPD_60_89", "DPD_90_PLUS")
BUCKETS_30P = BUCKETS[2:]
BUCKETS_60P = BUCKETS[3:]
BUCKETS_90P = BUCKETS[4:]


def _default_pd() -> dict:
    # Annual default probability per bucket; the last one also catches NULL.
    return {
        "DPD_0": Decimal("0.01"),
        "DPD_1_29": Decimal("0.03"),
        "DPD_30_59": Decimal("0.10"),
        "DPD_60_89": Decimal("0.30"),
        "DPD_90_PLUS": Decimal("0.55"),
    }


@dataclass(frozen=True)
class Params:
    # Missed-installment counts at which the 30, 60 and 90 day buckets begin.
    dpd_cutoffs: tuple = (1.0, 2.0, 3.0)
    funding_rate: Decimal = Decimal("0.055")
    lgd: Decimal = Decimal("0.55")
    pd_by_bucket: dict = field(default_factory=_default_pd)
    # Calendar of month starts.
    calendar_start: date = date(2022, 1, 1)
    calendar_stop: date = date(2026, 12, 1)
    # Reporting.
    min_segment_loans: int = 200
    migration_month: date = date(2025, 12, 31)
    vintage_from: date = date(2023, 1, 31)
    vintage_to: date = date(2024, 12, 31)
    histogram_bins: int = 50
    top_risk_loans: int = 100
    # Early-warning model.
    lookback_months: int = 3
    horizon_months: int = 3
    training_months: int = 24
    test_share: Decimal = Decimal("0.25")
    split_seed: int = 42
    max_iter: int = 300
    fit_tolerance: float = 1e-10
    threshold: float = 0.5


DEFAULTS = Params()
