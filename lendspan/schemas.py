"""Explicit types of the loan star schema (exact decimals, real dates)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)
RATE = T.DecimalType(6, 4)


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


CUSTOMERS = _schema(
    ("customer_id", T.LongType(), False),
    ("age", T.IntegerType(), True),
    ("annual_income_nzd", T.DecimalType(12, 2), True),
    ("employment_type", T.StringType(), True),
    ("region", T.StringType(), True),
    ("credit_score", T.IntegerType(), True),
    ("tenure_months", T.IntegerType(), True),
)
PRODUCTS = _schema(
    ("product_type", T.StringType(), False),
    ("secured_flag", T.BooleanType(), True),
    ("base_risk_tier", T.StringType(), True),
)
CHANNELS = _schema(
    ("channel", T.StringType(), False),
    ("channel_group", T.StringType(), True),
)
LOANS = _schema(
    ("loan_id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("product_type", T.StringType(), False),
    ("origination_date", T.DateType(), False),
    ("principal_nzd", MONEY, False),
    ("interest_rate_apr", RATE, False),
    ("term_months", T.IntegerType(), False),
    ("channel", T.StringType(), False),
    ("status", T.StringType(), True),
)
SCHEDULE = _schema(
    ("loan_id", T.LongType(), False),
    ("installment_no", T.IntegerType(), False),
    ("due_date", T.DateType(), False),
    ("scheduled_amount", MONEY, False),
    ("scheduled_principal", MONEY, False),
    ("scheduled_interest", MONEY, False),
)
PAYMENTS = _schema(
    ("loan_id", T.LongType(), False),
    ("payment_date", T.DateType(), False),
    ("paid_amount", MONEY, False),
)
COLLECTIONS = _schema(
    ("loan_id", T.LongType(), False),
    ("event_date", T.DateType(), False),
    ("action_type", T.StringType(), True),
    ("promised_to_pay_date", T.DateType(), True),
)
MACRO_MONTHLY = _schema(
    ("month", T.DateType(), False),
    ("unemployment_rate", RATE, True),
    ("cpi_index", T.DecimalType(10, 4), True),
    ("cash_rate", RATE, True),
)
RISK_SCORES = _schema(
    ("loan_id", T.LongType(), False),
    ("month_end", T.DateType(), False),
    ("risk_score", T.DoubleType(), True),
    ("will_be_60p_in_3m", T.IntegerType(), True),
)

# Table name -> schema, parents before children (the load order).
TABLE_SCHEMAS = {
    "dim_customers": CUSTOMERS,
    "dim_products": PRODUCTS,
    "dim_channels": CHANNELS,
    "fct_loans": LOANS,
    "fct_schedule": SCHEDULE,
    "fct_payments": PAYMENTS,
    "fct_collections": COLLECTIONS,
}

PRIMARY_KEYS = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_type",),
    "dim_channels": ("channel",),
    "fct_loans": ("loan_id",),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("fct_loans", "customer_id", "dim_customers", "customer_id"),
    ("fct_schedule", "loan_id", "fct_loans", "loan_id"),
    ("fct_payments", "loan_id", "fct_loans", "loan_id"),
    ("fct_collections", "loan_id", "fct_loans", "loan_id"),
)
