"""The named marts, registered in dependency order as temporary views."""

from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession

from ..operators import balance, commercial, delinquency, risk
from ..params import DEFAULTS, Params
from ..tables import Tables

# Name -> builder, in dependency order.
MARTS: dict[str, Callable[[Tables, Params], DataFrame]] = {
    "v_month_ends": lambda t, p: delinquency.month_ends(t.loans.sparkSession, p),
    "mart_loan_due_paid": lambda t, p: delinquency.loan_due_paid(t),
    "mart_loan_arrears": lambda t, p: delinquency.loan_arrears(t),
    "mart_loan_dpd_bucket": delinquency.loan_dpd_bucket,
    "mart_portfolio_snapshot": delinquency.portfolio_snapshot,
    "mart_dpd_migration": delinquency.dpd_migration,
    "mart_vintage_60plus": delinquency.vintage_60plus,
    "mart_principal_paid_by_month": lambda t, p: balance.principal_paid_by_month(t),
    "mart_balance_eop": lambda t, p: balance.balance_eop(t),
    "mart_portfolio_snapshot_v2": balance.portfolio_snapshot_v2,
    "risk_pay_behaviour_monthly": lambda t, p: risk.pay_behaviour_monthly(t),
    "risk_features_3m": risk.features_3m,
    "risk_labels_60p_3m": risk.labels_60p_3m,
    "comm_interest_income_monthly": commercial.interest_income_monthly,
    "comm_nii_monthly": commercial.nii_monthly,
    "comm_rar_monthly": commercial.rar_monthly,
}


def build_marts(t: Tables, params: Params = DEFAULTS, scores: Optional[DataFrame] = None) -> dict:
    """Every mart as a lazy frame; the watchlist needs a scored table."""
    marts = {name: build(t, params) for name, build in MARTS.items()}
    if scores is not None:
        marts["risk_watchlist"] = risk.risk_watchlist(marts["mart_portfolio_snapshot_v2"], scores)
    return marts


def register_marts(
    spark: SparkSession, t: Tables, params: Params = DEFAULTS, scores: Optional[DataFrame] = None
) -> list[str]:
    """Register base tables and marts for use from spark.sql(...); returns the mart names."""
    for name, df in t.by_name().items():
        df.createOrReplaceTempView(name)
    if scores is not None:
        scores.createOrReplaceTempView("risk_scores")
    marts = build_marts(t, params, scores)
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    return list(marts)
