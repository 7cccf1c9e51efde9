"""Baseline marts: calendar, due and paid, arrears, buckets, snapshot, migration, vintage."""

from datetime import date
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import bucket_rank, flag, in_buckets, money, months_between, ratio
from ..params import BUCKETS_60P, DEFAULTS, Params
from ..tables import Tables
from .ledger import LOAN_COLUMNS, by_loan, loan_months, monthly_flows, with_delinquency

SNAPSHOT_COLUMNS = ("month_end", "loan_id", *LOAN_COLUMNS, "arrears_amt", "dpd_bucket")


def month_ends(spark: SparkSession, params: Params = DEFAULTS) -> DataFrame:
    """One month-end per month from calendar_start through calendar_stop."""
    return _calendar(
        spark.range(1).select(
            F.lit(params.calendar_start).alias("start"), F.lit(params.calendar_stop).alias("stop")
        )
    )


def month_ends_of(t: Tables) -> DataFrame:
    """The calendar from the first to the last installment month."""
    return _calendar(
        t.schedule.agg(
            F.trunc(F.min("due_date"), "month").alias("start"),
            F.trunc(F.max("due_date"), "month").alias("stop"),
        )
    )


def _calendar(limits: DataFrame) -> DataFrame:
    months = F.sequence(F.col("start"), F.col("stop"), F.expr("interval 1 month"))
    return limits.select(F.explode(months).alias("month")).select(F.last_day("month").alias("month_end"))


def loan_due_paid(t: Tables, as_of: Optional[date] = None) -> DataFrame:
    return monthly_flows(t, as_of).select(
        "loan_id",
        F.col("month_end").alias("due_month_end"),
        money(F.col("due")).alias("scheduled_amt"),
        money(F.col("paid")).alias("paid_amt_same_month"),
    )


def loan_arrears(t: Tables, as_of: Optional[date] = None) -> DataFrame:
    return with_delinquency(monthly_flows(t, as_of)).select(
        "loan_id",
        "month_end",
        money(F.col("due")).alias("scheduled_amt"),
        money(F.col("paid")).alias("paid_amt_same_month"),
        money(F.col("arrears")).alias("arrears_amt"),
    )


def loan_dpd_bucket(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return with_delinquency(monthly_flows(t, as_of), params).select(
        "loan_id",
        "month_end",
        money(F.col("arrears")).alias("arrears_amt"),
        "missed_inst",
        "dpd_bucket",
    )


def portfolio_snapshot(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    return (
        loan_months(t, params, as_of)
        .withColumn("arrears_amt", money(F.col("arrears")))
        .select(*SNAPSHOT_COLUMNS)
    )


def dpd_migration(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    """Loans per month and bucket pair; the earlier bucket is that of the loan's previous row."""
    months = with_delinquency(monthly_flows(t, as_of), params)
    return migration_of(months.withColumn("from_bucket", F.lag("dpd_bucket").over(by_loan())))


def migration_of(months: DataFrame) -> DataFrame:
    """The same from loan-months that carry their earlier bucket."""
    return (
        months.select("month_end", "from_bucket", F.col("dpd_bucket").alias("to_bucket"))
        .where(F.col("from_bucket").isNotNull())
        .groupBy("month_end", "from_bucket", "to_bucket")
        .agg(F.count(F.lit(1)).alias("loan_count"))
    )


def vintage_60plus(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> DataFrame:
    """Share of a cohort that stands at 60+ in each month on books (not "ever reached")."""
    return vintage_of(loan_months(t, params, as_of))


def vintage_of(months: DataFrame) -> DataFrame:
    """The same from loan-months with a bucket and the loan's origination date."""
    vintage = F.last_day("origination_date")
    bad = F.sum(flag(in_buckets(F.col("dpd_bucket"), BUCKETS_60P)))
    return (
        months.select(vintage.alias("vintage_month"), "month_end", "dpd_bucket")
        .where(F.col("month_end") >= F.col("vintage_month"))
        .groupBy(
            "vintage_month",
            months_between(F.col("month_end"), F.col("vintage_month")).alias("months_on_books"),
        )
        .agg(F.count(F.lit(1)).alias("loan_cnt"), bad.alias("bad_60plus_cnt"))
        .withColumn("rate_60plus", ratio(F.col("bad_60plus_cnt"), F.col("loan_cnt")))
    )


def migration_rates(migration: DataFrame) -> DataFrame:
    """Each pair's share of the loans that left the same bucket in the month."""
    start = Window.partitionBy("month_end", "from_bucket")
    return migration.withColumn(
        "migration_rate", ratio(F.col("loan_count"), F.sum("loan_count").over(start))
    )


def roll_rates(migration: DataFrame) -> DataFrame:
    """Migration rates to the next-worse bucket only."""
    one_worse = bucket_rank(F.col("to_bucket")) == bucket_rank(F.col("from_bucket")) + 1
    return migration_rates(migration).where(one_worse).withColumnRenamed("migration_rate", "roll_rate")


def transition_class(from_bucket: Column, to_bucket: Column) -> Column:
    start, end = bucket_rank(from_bucket), bucket_rank(to_bucket)
    return (
        F.when(start == end, "Stay")
        .when(end < start, "Cure")
        .when(start == 0, "Worsen")
        .otherwise("Roll")
    )


def transition_classes(migration: DataFrame) -> DataFrame:
    """Loans per month and transition class."""
    return (
        migration.withColumn(
            "transition_class", transition_class(F.col("from_bucket"), F.col("to_bucket"))
        )
        .groupBy("month_end", "transition_class")
        .agg(F.sum("loan_count").alias("loan_count"))
    )
