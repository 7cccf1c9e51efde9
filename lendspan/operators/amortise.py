"""Annuity payments and installment schedules as closed-form expressions."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def annuity_payment(principal: Column, apr: Column, term: Column) -> Column:
    """Level monthly payment; an interest-free loan is repaid in equal parts."""
    amount, months = principal.cast("double"), term.cast("double")
    rate = apr.cast("double") / 12
    growth = F.pow(1 + rate, months)
    return F.when(rate <= 0, amount / months).otherwise(amount * rate * growth / (growth - 1))


def _opening_balance(principal: Column, rate: Column, payment: Column, paid_months: Column) -> Column:
    """Balance after a number of level payments."""
    amount = principal.cast("double")
    growth = F.pow(1 + rate, paid_months.cast("double"))
    return F.when(rate <= 0, amount - paid_months * payment).otherwise(
        amount * growth - payment * (growth - 1) / rate
    )


def _to_cents(value: Column) -> Column:
    """Half up to cents. A shortfall below 5e-9 counts as float noise of an exact half cent."""
    cents = F.floor(value * 100 + 0.5 + 5e-7)
    return (cents.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(14,2)")


def amortise(loans: DataFrame, capped: bool = True) -> DataFrame:
    """Expand each loan to its installments, each from its own closed form.

    Due dates fall on the origination day, or on the last day of a shorter month.
    With `capped`, the principal part stays within the open balance and a loan ends
    once its balance is a cent or less.
    """
    plan = loans.where(F.col("term_months") >= 1).select(
        "loan_id",
        "origination_date",
        "principal_nzd",
        (F.col("interest_rate_apr").cast("double") / 12).alias("rate"),
        annuity_payment(F.col("principal_nzd"), F.col("interest_rate_apr"), F.col("term_months")).alias(
            "payment"
        ),
        F.explode(F.sequence(F.lit(1), F.col("term_months"))).alias("installment_no"),
    )
    opening = _opening_balance(
        F.col("principal_nzd"), F.col("rate"), F.col("payment"), F.col("installment_no") - 1
    )
    parts = plan.withColumn("opening", opening)
    if capped:
        parts = parts.withColumn("opening", F.greatest("opening", F.lit(0.0)))
    interest = F.col("opening") * F.col("rate")
    principal = F.col("payment") - interest
    if capped:
        principal = F.greatest(F.least(principal, F.col("opening")), F.lit(0.0))
        parts = parts.where((F.col("installment_no") == 1) | (F.col("opening") > 0.01))
    return parts.select(
        "loan_id",
        "installment_no",
        F.add_months("origination_date", F.col("installment_no")).alias("due_date"),
        _to_cents(F.col("payment")).alias("scheduled_amount"),
        _to_cents(principal).alias("scheduled_principal"),
        _to_cents(interest).alias("scheduled_interest"),
    )
