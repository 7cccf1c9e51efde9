"""The loan-month ledger that the marts are cut from.

Schedule and payment rows are stacked and summed per loan and month in one
aggregation. Its map-side combine leaves at most one row per loan and month from
each input split, so a loan that holds a large share of the raw rows reaches the
later loan windows as no more rows than there are months. All loan windows use the
same partitioning and order, so they share one exchange on loan_id.
"""

from datetime import date
from typing import Callable, Optional

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import cents, dpd_bucket, flag, in_buckets, money, no_cents
from ..params import BUCKETS_60P, DEFAULTS, Params
from ..tables import Tables

LOAN_COLUMNS = (
    "customer_id",
    "product_type",
    "channel",
    "origination_date",
    "principal_nzd",
    "interest_rate_apr",
    "term_months",
)


def by_loan() -> WindowSpec:
    return Window.partitionBy("loan_id").orderBy("month_end")


def running() -> WindowSpec:
    return by_loan().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole_life() -> WindowSpec:
    return by_loan().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


FLOW_SUMS = ("due", "principal", "paid", "installments")


def _flow_rows(t: Tables, as_of: Optional[date] = None) -> DataFrame:
    """Schedule and payment rows stacked, in cents."""
    due = t.schedule.select(
        "loan_id",
        F.last_day("due_date").alias("month_end"),
        cents("scheduled_amount").alias("due"),
        cents("scheduled_principal").alias("principal"),
        no_cents().alias("paid"),
        F.lit(1).cast("long").alias("installments"),
        *([(F.col("due_date") <= as_of).alias("in_scope")] if as_of else []),
    )
    paid = t.payments.select(
        "loan_id",
        F.last_day("payment_date").alias("month_end"),
        no_cents().alias("due"),
        no_cents().alias("principal"),
        cents("paid_amount").alias("paid"),
        no_cents().alias("installments"),
        *([(F.col("payment_date") <= as_of).alias("in_scope")] if as_of else []),
    )
    return due.unionByName(paid)


def month_sums(t: Tables) -> DataFrame:
    """Due, principal and paid cents per loan and month, also of months with payments alone."""
    return _flow_rows(t).groupBy("loan_id", "month_end").agg(*[F.sum(c).alias(c) for c in FLOW_SUMS])


def monthly_flows(t: Tables, as_of: Optional[date] = None) -> DataFrame:
    """Due, principal and paid cents per loan and scheduled month.

    Payments of a month without an installment do not appear. With `as_of`, later
    installments and payments are left out; `life_due` and `life_count` still
    describe the whole schedule.
    """
    if as_of is None:
        return month_sums(t).where(F.col("installments") > 0) if t.flows is None else t.flows
    life = Window.partitionBy("loan_id")
    return (
        _flow_rows(t, as_of)
        .groupBy("loan_id", "month_end")
        .agg(
            *[F.sum(F.when(F.col("in_scope"), F.col(c)).otherwise(no_cents())).alias(c) for c in FLOW_SUMS],
            F.sum("due").alias("month_due"),
            F.sum("installments").alias("month_count"),
        )
        .select(
            "*",
            F.sum("month_due").over(life).alias("life_due"),
            F.sum("month_count").over(life).alias("life_count"),
        )
        .where(F.col("installments") > 0)
        .drop("month_due", "month_count")
    )


def missed_installments() -> Column:
    """Arrears in average installments of the whole schedule, at least 0; NULL if that average is 0."""
    missed = F.greatest(
        F.lit(0.0),
        F.col("arrears").cast("double")
        * F.col("life_count").cast("double")
        / F.nullif(F.col("life_due").cast("double"), F.lit(0.0)),
    )
    # greatest() skips NULL; a zero average must stay NULL to reach the worst bucket.
    return F.when(F.col("life_due") != 0, missed)


def with_delinquency(
    flows: DataFrame, params: Params = DEFAULTS, running_sums: Optional[dict] = None
) -> DataFrame:
    """Add running arrears, missed installments and the bucket.

    The average installment covers the loan's whole schedule. Cents and counts are
    whole numbers, so the quotient is exact at the bucket limits. `running_sums` names
    further columns to be summed in the same window (target -> source).
    """
    net = flows.withColumn("net", F.col("due") - F.col("paid"))
    whole_schedule = (
        []
        if "life_due" in flows.columns
        else [
            F.sum("due").over(whole_life()).alias("life_due"),
            F.sum("installments").over(whole_life()).alias("life_count"),
        ]
    )
    sums = {"arrears": "net", **(running_sums or {})}
    arrears = net.select(
        "*", *whole_schedule, *[F.sum(source).over(running()).alias(name) for name, source in sums.items()]
    )
    return arrears.withColumn("missed_inst", missed_installments()).withColumn(
        "dpd_bucket", dpd_bucket(F.col("arrears"), F.col("missed_inst"), params.dpd_cutoffs)
    )


def loan_months(
    t: Tables,
    params: Params = DEFAULTS,
    as_of: Optional[date] = None,
    loans: Optional[DataFrame] = None,
    extra_columns: tuple = (),
    widen: Callable[[DataFrame], DataFrame] = lambda months: months,
) -> DataFrame:
    """Ledger rows of known loans with loan columns, delinquency and balance.

    `loans` may be the loan table widened with `extra_columns`; `widen` adds further
    loan windows. All windows in month order run before the join, on narrow rows: the
    join needs them by loan, so they are sorted once.

    The balance is NULL before the origination month. A month without an installment
    would add nothing, so the running sum over ledger rows equals one over all months.
    """
    loan_side = (t.loans if loans is None else loans).select("loan_id", *LOAN_COLUMNS, *extra_columns)
    months = widen(with_delinquency(monthly_flows(t, as_of), params, {"repaid": "principal"}))
    # installments that lie before the origination month do not reduce the balance
    early = F.sum(F.when(_on_books(), no_cents()).otherwise(F.col("principal"))).over(
        Window.partitionBy("loan_id")
    )
    joined = months.join(loan_side, "loan_id").withColumn("early", early)
    return joined.withColumn("eop_balance", money(eop_cents()))


def _on_books() -> Column:
    return F.col("month_end") >= F.last_day("origination_date")


def eop_cents() -> Column:
    """The balance of a row of `loan_months` in cents."""
    left = F.greatest(cents("principal_nzd") - (F.col("repaid") - F.col("early")), no_cents())
    return F.when(_on_books(), left)


def flag_60p() -> Column:
    return flag(in_buckets(F.col("dpd_bucket"), BUCKETS_60P))
