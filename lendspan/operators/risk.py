"""Risk features and labels per loan and month."""

from datetime import date
from typing import Callable, Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flag, money, no_cents
from ..params import DEFAULTS, Params
from ..tables import Tables
from .ledger import by_loan, flag_60p, loan_months, monthly_flows

FEATURE_COLUMNS = (
    "loan_id",
    "month_end",
    "dpd_bucket",
    "arrears_amt",
    "eop_balance",
    "product_type",
    "channel",
    "interest_rate_apr",
    "credit_score",
    "annual_income_nzd",
    "employment_type",
    "roll3_paid_full_rate",
    "roll3_missed_cnt",
    "roll3_avg_arrears",
)
CUSTOMER_COLUMNS = ("credit_score", "annual_income_nzd", "employment_type")
LABEL = "will_be_60p_in_3m"


def _paid_full() -> Column:
    return flag(F.col("paid") >= F.col("due"))


def pay_behaviour_monthly(t: Tables) -> DataFrame:
    return monthly_flows(t).select(
        "loan_id",
        "month_end",
        money(F.col("due")).alias("scheduled_amt"),
        money(F.col("paid")).alias("paid_amt"),
        _paid_full().alias("paid_full_flag"),
    )


def _rolling(months: DataFrame, params: Params) -> DataFrame:
    """Rolling columns over the loan's current and preceding rows; short histories use fewer."""
    recent = by_loan().rowsBetween(1 - params.lookback_months, Window.currentRow)
    return months.select(
        "*",
        F.avg(_paid_full().cast("double")).over(recent).alias("roll3_paid_full_rate"),
        F.sum(1 - _paid_full()).over(recent).alias("roll3_missed_cnt"),
        (
            F.sum("arrears").over(recent).cast("double") / 100 / F.count("arrears").over(recent)
        ).alias("roll3_avg_arrears"),
    )


def _label(params: Params) -> Column:
    """60+ in any of the next rows of the loan; the end of history counts as good."""
    ahead = by_loan().rowsBetween(1, params.horizon_months)
    return F.coalesce(F.max(flag_60p()).over(ahead), no_cents()).cast("int")


def _customer_loans(t: Tables) -> DataFrame:
    # Joined at loan grain: a busy customer meets one row per loan, not per loan-month.
    return t.loans.join(t.customers.select("customer_id", *CUSTOMER_COLUMNS), "customer_id")


def _feature_months(
    t: Tables, params: Params, as_of: Optional[date], widen: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    months = loan_months(t, params, as_of, _customer_loans(t), CUSTOMER_COLUMNS, widen)
    return months.withColumn("arrears_amt", money(F.col("arrears")))


def features_3m(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return _feature_months(t, params, as_of, lambda m: _rolling(m, params)).select(*FEATURE_COLUMNS)


def rolling_months(
    t: Tables,
    params: Params = DEFAULTS,
    as_of: Optional[date] = None,
    all_loans: bool = False,
    columns: tuple = CUSTOMER_COLUMNS,
) -> DataFrame:
    """Ledger rows with the rolling features and the given customer columns, cut from one ledger.

    With `all_loans`, loans of unknown customers stay, their customer columns NULL.
    """
    customers = t.customers.select("customer_id", *columns)
    loans = t.loans.join(customers, "customer_id", "left" if all_loans else "inner")
    return loan_months(t, params, as_of, loans, columns, lambda m: _rolling(m, params))


def labels_60p_3m(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    months = loan_months(t, params, as_of, widen=lambda m: m.withColumn(LABEL, _label(params)))
    return months.select("loan_id", "month_end", LABEL)


def _latest_month(t: Tables, loans: DataFrame, as_of: Optional[date]) -> DataFrame:
    """Latest ledger month of the given loans; from the stored flows if there are any."""
    if t.flows is not None and as_of is None:
        months = t.flows.groupBy("loan_id").agg(F.max("month_end").alias("last"))
    else:
        schedule = t.schedule if as_of is None else t.schedule.where(F.col("due_date") <= as_of)
        months = schedule.groupBy("loan_id").agg(F.last_day(F.max("due_date")).alias("last"))
    return months.join(loans.select("loan_id"), "loan_id", "left_semi").agg(F.max("last").alias("latest"))


def training_window(
    df: DataFrame, months: int = DEFAULTS.training_months, latest: Optional[DataFrame] = None
) -> DataFrame:
    """Rows of the last `months` months. `latest` may give the newest month as a one-value frame."""
    newest = latest if latest is not None else df.agg(F.max("month_end").alias("latest"))
    return df.where(F.col("month_end") >= F.add_months(newest.scalar(), -months))


def recent_features(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return training_window(
        features_3m(t, params, as_of), params.training_months, _latest_month(t, _customer_loans(t), as_of)
    )


def recent_labels(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return training_window(
        labels_60p_3m(t, params, as_of), params.training_months, _latest_month(t, t.loans, as_of)
    )


def labelled_features(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    """Features with their label, both cut from the same ledger row, so without a join."""
    months = _feature_months(
        t, params, as_of, lambda m: _rolling(m.withColumn(LABEL, _label(params)), params)
    )
    return months.select(*FEATURE_COLUMNS, LABEL)


def training_set(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    """Recent labelled rows with their rolling features known.

    Every feature row is also a label row, so the newest label month is never the
    earlier one and its window alone decides.
    """
    return training_window(
        labelled_features(t, params, as_of), params.training_months, _latest_month(t, t.loans, as_of)
    ).dropna(subset=["roll3_paid_full_rate", "roll3_avg_arrears"])


def risk_watchlist(snapshot_v2: DataFrame, scores: DataFrame) -> DataFrame:
    return snapshot_v2.join(
        scores.select("loan_id", "month_end", "risk_score"), ["loan_id", "month_end"]
    ).select(
        "month_end", "loan_id", "product_type", "channel", "dpd_bucket", "eop_balance", "risk_score"
    )
