"""Analysis and reporting queries over the marts.

Counts and rates that do not need a balance read the plain snapshot, so no balance
window is computed for them. Queries about the latest month aggregate by month
first and pick the month from that small result.
"""

from datetime import date
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import in_buckets, ratio, share
from ..operators.balance import portfolio_snapshot_v2
from ..operators.commercial import rar_monthly
from ..operators.ledger import flag_60p, loan_months
from ..operators.delinquency import dpd_migration, portfolio_snapshot, vintage_60plus
from ..params import BUCKETS, BUCKETS_30P, BUCKETS_60P, BUCKETS_90P, DEFAULTS, Params
from ..tables import Tables


def _rows() -> Column:
    return F.count(F.lit(1))


def _rate(buckets: tuple) -> Column:
    return share(in_buckets(F.col("dpd_bucket"), buckets))


def _three_rates() -> list[Column]:
    return [
        _rate(BUCKETS_30P).alias("rate_30p"),
        _rate(BUCKETS_60P).alias("rate_60p"),
        _rate(BUCKETS_90P).alias("rate_90p"),
    ]


def _bad_rows() -> Column:
    return F.sum(flag_60p())


def _of_latest_month(summary: DataFrame) -> DataFrame:
    """Rows of the newest month of an aggregate by month and segment (small by then)."""
    everything = Window.partitionBy(F.lit(1))
    return (
        summary.withColumn("_latest", F.max("month_end").over(everything))
        .where(F.col("month_end") == F.col("_latest"))
        .drop("_latest")
    )


def _percent(rate: str) -> Column:
    return F.round(F.col(rate) * 100, 2)


def monthly_rates(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return (
        portfolio_snapshot(t, params)
        .groupBy("month_end")
        .agg(
            _rows().alias("loans"),
            *_three_rates(),
        )
        .orderBy("month_end")
    )


def worst_segments(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """Channel x product cells of the latest month with enough loans, worst first."""
    cells = (
        portfolio_snapshot(t, params)
        .groupBy("month_end", "channel", "product_type")
        .agg(_rows().alias("loans"), _rate(BUCKETS_60P).alias("bad_60p_rate"))
    )
    return (
        _of_latest_month(cells)
        .where(F.col("loans") >= params.min_segment_loans)
        .orderBy(F.col("bad_60p_rate").desc(), "channel", "product_type")
    )


def migration_matrix(t: Tables, month: Optional[date] = None, params: Params = DEFAULTS) -> DataFrame:
    return (
        dpd_migration(t, params)
        .where(F.col("month_end") == (month or params.migration_month))
        .orderBy("from_bucket", "to_bucket")
    )


def vintage_curves(
    t: Tables, first: Optional[date] = None, last: Optional[date] = None, params: Params = DEFAULTS
) -> DataFrame:
    return (
        vintage_60plus(t, params)
        .where(F.col("vintage_month").between(first or params.vintage_from, last or params.vintage_to))
        .orderBy("vintage_month", "months_on_books")
    )


def dpd_by_product(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return (
        portfolio_snapshot(t, params)
        .groupBy("product_type", "dpd_bucket")
        .agg(_rows().alias("loan_count"))
        .orderBy("product_type", "dpd_bucket")
    )


def _wide(long: DataFrame, row: str, column: str) -> DataFrame:
    return (
        long.groupBy(row).pivot(column, list(BUCKETS)).agg(F.sum("loan_count")).fillna(0).orderBy(row)
    )


def dpd_by_product_pivot(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return _wide(dpd_by_product(t, params), "product_type", "dpd_bucket")


def migration_total(t: Tables, measure: str = "rows", params: Params = DEFAULTS) -> DataFrame:
    """All-time matrix: months in which a pair occurred (`rows`) or loans that made it (`loans`)."""
    measures = {"rows": _rows(), "loans": F.sum("loan_count")}
    return (
        dpd_migration(t, params)
        .groupBy("from_bucket", "to_bucket")
        .agg(measures[measure].alias("loan_count"))
        .orderBy("from_bucket", "to_bucket")
    )


def migration_total_pivot(t: Tables, measure: str = "rows", params: Params = DEFAULTS) -> DataFrame:
    return _wide(migration_total(t, measure, params), "from_bucket", "to_bucket")


def vintage_average(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """One rate per cohort and month on books; each pair is already a single row."""
    return (
        vintage_60plus(t, params)
        .select("vintage_month", "months_on_books", F.col("rate_60plus").alias("avg_rate_60plus"))
        .orderBy("vintage_month", "months_on_books")
    )


def commercial_trend(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return (
        rar_monthly(t, params)
        .groupBy("month_end")
        .agg(
            F.sum("nii_est").alias("total_nii"),
            F.sum("rar_profit_est").alias("total_rar_profit"),
            ratio(F.sum("rar_profit_est"), F.count("rar_profit_est")).alias("avg_rar_profit"),
        )
        .orderBy("month_end")
    )


def dashboard_trend(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return (
        portfolio_snapshot(t, params)
        .groupBy("month_end")
        .agg(_rows().alias("total_loans"), _rate(BUCKETS_60P).alias("rate_60p"))
        .orderBy("month_end")
    )


def latest_month_split(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """Loans below and at 60+ in the latest month."""
    bad = _bad_rows()
    return (
        portfolio_snapshot(t, params)
        .groupBy("month_end")
        .agg((_rows() - bad).alias("current_loans"), bad.alias("loans_60p"))
        .orderBy(F.col("month_end").desc())
        .limit(1)
    )


def portfolio_overview(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """Distinct loans and customers with the first and last month.

    Collapsed by loan, then by customer, so no distinct expansion of the ledger is needed.
    """
    per_loan = (
        portfolio_snapshot(t, params)
        .groupBy("loan_id", "customer_id")
        .agg(F.min("month_end").alias("first"), F.max("month_end").alias("last"))
    )
    per_customer = per_loan.groupBy("customer_id").agg(
        _rows().alias("loans"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return per_customer.agg(
        F.coalesce(F.sum("loans"), F.lit(0)).alias("loans"),
        F.count("customer_id").alias("customers"),
        F.min("first").alias("first_month_end"),
        F.max("last").alias("last_month_end"),
    )


def latest_month_kpis(t: Tables, params: Params = DEFAULTS, with_balance: bool = True) -> DataFrame:
    """A loan has one row per month, so the month's rows are its distinct loans."""
    snapshot = portfolio_snapshot_v2(t, params) if with_balance else portfolio_snapshot(t, params)
    latest = (
        snapshot.groupBy("month_end")
        .agg(
            _rows().alias("total_rows"),
            F.count("loan_id").alias("loans"),
            *_three_rates(),
            *([F.sum("eop_balance").alias("total_eop_balance")] if with_balance else []),
        )
        .orderBy(F.col("month_end").desc())
        .limit(1)
    )
    return latest.withColumns({r: _percent(r) for r in ("rate_30p", "rate_60p", "rate_90p")})


def _worst_of(t: Tables, segment: str, params: Params, n: int) -> DataFrame:
    by_month = (
        portfolio_snapshot(t, params)
        .groupBy("month_end", segment)
        .agg(F.count("loan_id").alias("loans"), _rate(BUCKETS_60P).alias("rate_60p"))
    )
    return (
        _of_latest_month(by_month)
        .orderBy(F.col("rate_60p").desc(), F.col("loans").desc(), segment)
        .limit(n)
        .select(segment, "loans", _percent("rate_60p").alias("rate_60p"))
    )


def top_products(t: Tables, params: Params = DEFAULTS, n: int = 10) -> DataFrame:
    return _worst_of(t, "product_type", params, n)


def top_channels(t: Tables, params: Params = DEFAULTS, n: int = 10) -> DataFrame:
    return _worst_of(t, "channel", params, n)


def last_months(t: Tables, params: Params = DEFAULTS, n: int = 12) -> DataFrame:
    return (
        portfolio_snapshot_v2(t, params)
        .groupBy("month_end")
        .agg(
            _rows().alias("loans"),
            F.sum("eop_balance").alias("total_balance"),
            _rate(BUCKETS_60P).alias("rate_60p"),
        )
        .orderBy(F.col("month_end").desc())
        .limit(n)
    )


def product_performance(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """Distinct loans and 60+ rate of each listed product.

    Summed per loan first: its ledger rows are already in one partition, and the
    distinct count becomes a plain one.
    """
    per_loan = (
        portfolio_snapshot(t, params)
        .groupBy("loan_id", "product_type")
        .agg(_rows().alias("months"), _bad_rows().alias("bad"))
    )
    per_product = per_loan.groupBy("product_type").agg(
        _rows().alias("loans"), ratio(F.sum("bad"), F.sum("months")).alias("rate_60p")
    )
    return per_product.join(
        t.products.select("product_type", "secured_flag", "base_risk_tier"), "product_type"
    )


def commercial_totals(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return (
        rar_monthly(t, params)
        .groupBy("month_end")
        .agg(F.sum("nii_est").alias("total_nii"), F.sum("rar_profit_est").alias("total_rar"))
        .orderBy(F.col("month_end").desc())
    )


def portfolio_size(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    return portfolio_snapshot(t, params).groupBy("month_end").agg(_rows().alias("loans")).orderBy("month_end")


def row_counts(t: Tables) -> DataFrame:
    counts = [
        df.agg(_rows().alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in t.by_name().items()
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


def first_rows(df: DataFrame, key: tuple = ("loan_id", "month_end"), n: int = 10) -> DataFrame:
    """A look at a mart, in key order so that it is repeatable."""
    return df.orderBy(*key).limit(n)


def delinquency_by_region(t: Tables, params: Params = DEFAULTS) -> DataFrame:
    """Monthly rates by the customer's region, which is joined at loan grain."""
    placed = t.loans.join(t.customers.select("customer_id", "region"), "customer_id")
    return (
        loan_months(t, params, loans=placed, extra_columns=("region",))
        .groupBy("month_end", "region")
        .agg(
            _rows().alias("loans"),
            *_three_rates(),
        )
    )
