"""Balance marts: scheduled principal, end-of-period balance, snapshot with balance."""

from datetime import date
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cents, money, months_between, no_cents
from ..params import DEFAULTS, Params
from ..tables import Tables
from .delinquency import SNAPSHOT_COLUMNS
from .ledger import by_loan, loan_months, running, whole_life


def _principal_rows(t: Tables) -> DataFrame:
    """Scheduled principal by month; several rows per month unless flows were written before."""
    if t.flows is not None:
        return t.flows.select("loan_id", "month_end", "principal")
    return t.schedule.select(
        "loan_id",
        F.last_day("due_date").alias("month_end"),
        cents("scheduled_principal").alias("principal"),
    )


def principal_paid_by_month(t: Tables) -> DataFrame:
    return (
        _principal_rows(t)
        .groupBy("loan_id", "month_end")
        .agg(money(F.sum("principal")).alias("sched_principal"))
    )


def balance_eop(t: Tables) -> DataFrame:
    """Balance of every loan at every month-end in use, from its origination month on.

    The balance changes only in installment months. So the loan windows run on those
    rows plus one opening row per loan, and each row is then copied forward over the
    months up to the next one. The wide loans-by-months result is never shuffled. For a few
    months ask `balance_at`.
    """
    scheduled = _principal_rows(t)
    calendar = _calendar(scheduled).scalar()
    first = _before("from_month")
    after = F.coalesce(_before("to_month"), F.size("calendar.months"))
    held = F.slice("calendar.months", first + 1, F.greatest(after - first, F.lit(0)))
    return balance_intervals(t).withColumn("calendar", calendar).select(
        "loan_id", F.explode(held).alias("month_end"), "eop_balance"
    )


def balance_intervals(t: Tables) -> DataFrame:
    """Spans of months over which a loan's scheduled balance stays: loan_id, from_month, to_month, eop_balance.

    A span begins with the origination month or an installment month and ends before
    `to_month`, the next one; it is NULL for the last span of a loan. There are as many rows
    as balances change, however many months are asked for later.
    """
    opening = t.loans.select(
        "loan_id",
        F.last_day("origination_date").alias("month_end"),
        no_cents().alias("principal"),
        cents("principal_nzd").alias("lent"),
        F.last_day("origination_date").alias("opened"),
    )
    repaid = _principal_rows(t).select(
        "*", F.lit(None).cast("long").alias("lent"), F.lit(None).cast("date").alias("opened")
    )
    return (
        opening.unionByName(repaid)
        .groupBy("loan_id", "month_end")
        .agg(
            F.sum("principal").alias("principal"),
            F.max("lent").alias("lent"),
            F.max("opened").alias("opened"),
        )
        .withColumn("lent", F.max("lent").over(whole_life()))
        .withColumn("opened", F.max("opened").over(whole_life()))
        .where(F.col("month_end") >= F.col("opened"))
        .select(
            "loan_id",
            F.col("month_end").alias("from_month"),
            F.lead("month_end").over(by_loan()).alias("to_month"),
            money(
                F.greatest(F.col("lent") - F.sum("principal").over(running()), no_cents())
            ).alias("eop_balance"),
        )
    )


# Calendar months of one bin of the range join.
BIN_MONTHS = 12


def balance_at(intervals: DataFrame, months: DataFrame) -> DataFrame:
    """Balances at given months from `balance_intervals`: a range join by bins of months.

    `months` has a date column month_end; any day stands for its month, repeated months and NULL
    count once or not at all. A span meets only the bins it shares with the months asked for, so
    one that is not asked for is dropped before the join. The months are broadcast: a calendar has
    12 a year, however many rows ask for them.
    """
    month = lambda c: F.year(c) * 12 + F.month(c) - 1
    in_bin = lambda number: F.floor(number / BIN_MONTHS)
    asked = (
        months.select(F.last_day("month_end").alias("month_end"))
        .where("month_end IS NOT NULL")
        .distinct()
        .withColumn("bin", in_bin(month(F.col("month_end"))))
    )
    limits = asked.agg(F.struct(F.min("bin").alias("low"), F.max("bin").alias("high")).alias("limits")).scalar()
    first = F.greatest(in_bin(month(F.col("from_month"))), F.col("limits.low"))
    last = F.least(in_bin(month(F.col("to_month")) - 1), F.col("limits.high"))
    spans = (
        intervals.withColumn("limits", limits)
        .select("*", first.alias("first_bin"), last.alias("last_bin"))
        .where("first_bin <= last_bin")
        .select("loan_id", "from_month", "to_month", "eop_balance", F.explode(F.sequence("first_bin", "last_bin")).alias("bin"))
    )
    inside = (F.col("from_month") <= F.col("month_end")) & (
        F.col("to_month").isNull() | (F.col("month_end") < F.col("to_month"))
    )
    return spans.join(F.broadcast(asked), "bin").where(inside).select("loan_id", "month_end", "eop_balance")


def _calendar(rows: DataFrame) -> DataFrame:
    """One row: the months in use in order, and for each calendar month from the first to one
    past the last how many of them come before it. Both have at most one element a month."""
    months = rows.agg(F.array_sort(F.collect_set("month_end")).alias("months"))
    first, last = F.element_at("months", 1), F.element_at("months", -1)
    span = F.coalesce(months_between(last, first), F.lit(-1)) + 1
    before = F.transform(
        F.sequence(F.lit(0), span),
        lambda k: F.size(F.filter("months", lambda m: months_between(m, first) < k)),
    )
    return months.select(F.struct("months", before.alias("before")).alias("calendar"))


def _before(column: str) -> Column:
    """How many months in use come before the month of `column`; NULL for NULL."""
    place = months_between(F.col(column), F.element_at("calendar.months", 1))
    inside = F.least(F.greatest(place, F.lit(0)), F.size("calendar.before") - 1)
    return F.when(F.col(column).isNotNull(), F.get("calendar.before", inside.cast("int")))


def portfolio_snapshot_v2(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return (
        loan_months(t, params, as_of)
        .withColumn("arrears_amt", money(F.col("arrears")))
        .select(*SNAPSHOT_COLUMNS, "eop_balance")
    )


def richest_snapshot(spark: SparkSession) -> DataFrame:
    """The registered snapshot with balances if there is one, else the plain one."""
    for name in ("mart_portfolio_snapshot_v2", "mart_portfolio_snapshot"):
        if spark.catalog.tableExists(name):
            return spark.table(name)
    raise LookupError("no portfolio snapshot is registered")
