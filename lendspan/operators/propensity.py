"""Payment propensity of a loan from its customer and terms."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import Tables

# Risk multipliers by product, channel and employment.
PRODUCT_RISK = {"Personal": 1.25, "Auto": 1.10, "Mortgage": 0.55, "SME": 1.35}
CHANNEL_RISK = {"Online": 1.05, "Broker": 1.15, "Branch": 0.90, "Partner": 1.25}
EMPLOYMENT_RISK = {
    "Salaried": 0.8,
    "Self-employed": 1.1,
    "Contractor": 1.2,
    "Student": 1.5,
    "Unemployed": 2.0,
}


def _lookup(values: dict, key: str) -> Column:
    expr = F
    for name, value in values.items():
        expr = expr.when(F.col(key) == name, F.lit(value))
    return expr


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _clip(x: Column, low: float, high: float) -> Column:
    # greatest() and least() skip NULL; an unknown value stays unknown
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def _loan_customers(t: Tables) -> DataFrame:
    people = t.customers.select(
        "customer_id",
        F.col("credit_score").cast("double").alias("score"),
        F.col("annual_income_nzd").cast("double").alias("income"),
        "employment_type",
    )
    return t.loans.select(
        "loan_id",
        "customer_id",
        "product_type",
        "channel",
        F.col("interest_rate_apr").cast("double").alias("apr"),
    ).join(people, "customer_id")


def risk_propensity(t: Tables) -> DataFrame:
    """Probability that an installment is paid late, or missed."""
    hardship = F.when(F.col("employment_type").isin("Unemployed", "Student"), 0.6).otherwise(0.0)
    index = (
        (650 - F.col("score")) / 90
        + (65000 - F.col("income")) / 90000
        + (F.col("apr") - 0.12) / 0.08
        + hardship
    ) * (_lookup(PRODUCT_RISK, "product_type") * _lookup(CHANNEL_RISK, "channel"))
    return _loan_customers(t).select(
        "loan_id",
        _clip(0.35 * _sigmoid(index), 0.02, 0.55).alias("p_late"),
        _clip(0.12 * _sigmoid(index), 0.005, 0.25).alias("p_miss"),
    )


def pay_probability(t: Tables) -> DataFrame:
    """Probability that an installment is paid, from an additive index."""
    index = (
        (850 - F.col("score")) / 400
        + (250000 - F.col("income")) / 250000
        + (F.col("apr") - 0.05) * 5
        + (_lookup(EMPLOYMENT_RISK, "employment_type") - 1)
        + (_lookup(PRODUCT_RISK, "product_type") - 1)
        + (_lookup(CHANNEL_RISK, "channel") - 1)
    )
    return _loan_customers(t).select("loan_id", _sigmoid(2 - index).alias("pay_probability"))
