"""Commercial marts: interest income, net interest income, expected loss, risk-adjusted return.

The balance is the original principal by default; `balance="eop"` uses the amortised one.
Every column is a projection of the snapshot, so the marts add no join and no shuffle.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import by_bucket, cents, half_up, in_buckets, money, ratio, share
from ..params import BUCKETS_60P, DEFAULTS, Params
from ..tables import Tables
from .ledger import loan_months

APR_DIGITS = 4  # decimals of a loan's interest rate
APR_WHOLE_DIGITS = 2  # its digits before the point
AMOUNT_DIGITS = 14  # digits of an amount in cents
MEASURE_COLUMNS = (
    "interest_income_est",
    "funding_cost_est",
    "nii_est",
    "expected_loss_est",
    "rar_profit_est",
)
# Columns of the marts that are cut from the loan-months.
MART_COLUMNS = {
    "comm_interest_income_monthly": (
        "month_end",
        "loan_id",
        "product_type",
        "channel",
        "eop_balance",
        "interest_rate_apr",
        "interest_income_est",
    ),
    "comm_nii_monthly": (
        "month_end",
        "loan_id",
        "product_type",
        "channel",
        "eop_balance",
        "interest_income_est",
        "funding_cost_est",
        "nii_est",
    ),
    "comm_rar_monthly": (
        "month_end",
        "loan_id",
        "product_type",
        "channel",
        "eop_balance",
        "nii_est",
        "expected_loss_est",
        "rar_profit_est",
    ),
}


def _exact(rate) -> Decimal:
    """A rate as the decimal that is written; a float stands for its shortest form."""
    return rate if isinstance(rate, Decimal) else Decimal(str(rate))


def _digits(rate: Decimal) -> int:
    return max(0, -rate.normalize().as_tuple().exponent)


def _whole(rate: Decimal, digits: int) -> int:
    """A decimal rate in units of its last digit."""
    return int(rate.scaleb(digits))


def _parts(number: Column, scale: int, kind: str) -> tuple[Column, Column]:
    """Whole quotient, cut towards zero, and remainder, both of the type `kind`."""
    whole = F.call_function("div", number, F.lit(scale).cast("long")).cast(kind)
    return whole, (number - whole * F.lit(scale).cast("long")).cast(kind)


def _scaled(amount: Column, units: Column, scale: int, kind: str) -> Column:
    """amount * units / scale, rounded half away from zero.

    The whole part is taken out before the product, which may not fit a long. Both parts have
    one sign, so the rounding is the same.
    """
    whole, rest = _parts(amount, scale, kind)
    return whole * units + half_up((rest * units).cast(kind), scale)


def _less_loss(income: Column, amount: Column, units: Column, scale: int, kind: str) -> Column:
    """income - amount * units / scale, rounded half away from zero, by parts as well."""
    whole, rest = _parts(amount, scale, kind)
    more, fraction = _parts((rest * units).cast(kind), scale, kind)
    # left less a fraction between -1 and 1
    left, twice = income - whole * units - more, 2 * fraction
    down = (twice > scale) | ((twice == scale) & (left <= 0))
    up = (twice < -scale) | ((twice == -scale) & (left >= 0))
    return left + F.when(down, -1).when(up, 1).otherwise(0)


def with_commercial(
    months: DataFrame,
    params: Params = DEFAULTS,
    balance: str = "principal",
    base: str = "eop_balance",
    in_cents: bool = False,
) -> DataFrame:
    """Add the commercial columns; the balance used is written to `base`.

    With `in_cents` the measures stay whole cents in longs, for sums over many rows.

    All of them are quotients of whole numbers: cents times a rate in units of its
    last digit, so they are exact up to the rounding. Plain longs hold them for rates of
    usual length; longer rates go through wide decimals.
    """
    if balance not in ("principal", "eop"):
        raise ValueError("balance must be 'principal' or 'eop'")
    source = "principal_nzd" if balance == "principal" else "eop_balance"
    df = months.withColumn(base, F.col(source).cast("decimal(14,2)"))
    funding_rate = _exact(params.funding_rate)
    rate_digits = max(APR_DIGITS, _digits(funding_rate))
    loss_rates = {name: _exact(pd) * _exact(params.lgd) for name, pd in params.pd_by_bucket.items()}
    loss_digits = max(_digits(rate) for rate in loss_rates.values())
    funding = _whole(funding_rate, rate_digits)
    loss_units = {name: _whole(rate, loss_digits) for name, rate in loss_rates.items()}
    months_in_units, loss_scale = 12 * 10**rate_digits, 10**loss_digits
    # the longest numbers are twice a remainder times its rate, and an amount times a rate
    fits = all(
        4 * scale * units < 2**63 and 10**AMOUNT_DIGITS * units // scale < 2**60
        for units, scale in (
            (10 ** (APR_WHOLE_DIGITS + rate_digits) + abs(funding), months_in_units),
            (max(map(abs, loss_units.values())), loss_scale),
        )
    )
    whole = "long" if fits else "decimal(38,0)"
    apr = (F.col("interest_rate_apr").cast(f"decimal(6,{APR_DIGITS})") * 10**APR_DIGITS).cast("long")
    rate_units = apr * F.lit(10 ** (rate_digits - APR_DIGITS)).cast("long")
    amount, rate, nii, loss = (F.col(f"__{name}") for name in ("amount", "rate", "nii", "loss"))
    shown = (lambda number: number.cast("long")) if in_cents else money
    # what several columns read is a column of its own, so that each row works it out once
    return (
        df.withColumns(
            {"__amount": cents(base).cast(whole), "__rate": rate_units, "__loss": by_bucket(F.col("dpd_bucket"), loss_units).cast("long")}
        )
        .withColumn("__nii", _scaled(amount, rate - funding, months_in_units, whole))
        .withColumn("pd_proxy", by_bucket(F.col("dpd_bucket"), params.pd_by_bucket))
        .withColumn("interest_income_est", shown(_scaled(amount, rate, months_in_units, whole)))
        .withColumn("funding_cost_est", shown(_scaled(amount, F.lit(funding).cast("long"), months_in_units, whole)))
        .withColumn("nii_est", shown(nii))
        .withColumn("expected_loss_est", shown(_scaled(amount, loss, loss_scale, whole)))
        # rounded income less the loss before rounding
        .withColumn("rar_profit_est", shown(_less_loss(nii, amount, loss, loss_scale, whole)))
        .drop("__amount", "__rate", "__nii", "__loss")
    )


def _commercial(t: Tables, params: Params, balance: str) -> DataFrame:
    return with_commercial(loan_months(t, params), params, balance)


def interest_income_monthly(t: Tables, params: Params = DEFAULTS, balance: str = "principal") -> DataFrame:
    return _commercial(t, params, balance).select(*MART_COLUMNS["comm_interest_income_monthly"])


def nii_monthly(t: Tables, params: Params = DEFAULTS, balance: str = "principal") -> DataFrame:
    return _commercial(t, params, balance).select(*MART_COLUMNS["comm_nii_monthly"])


def expected_loss(t: Tables, params: Params = DEFAULTS, balance: str = "principal") -> DataFrame:
    return _commercial(t, params, balance).select(
        "month_end", "loan_id", "dpd_bucket", "pd_proxy", "expected_loss_est"
    )


def rar_monthly(t: Tables, params: Params = DEFAULTS, balance: str = "principal") -> DataFrame:
    return _commercial(t, params, balance).select(*MART_COLUMNS["comm_rar_monthly"])


def segment_profitability(t: Tables, params: Params = DEFAULTS, balance: str = "principal") -> DataFrame:
    """Totals and margins by product, by channel and by both; the unused key is NULL.

    Loan-months are summed to product x channel first, so the grouping sets expand
    that small result and not the ledger.
    """
    sums = ("eop_balance", "nii_est", "expected_loss_est", "rar_profit_est")
    cells = (
        _commercial(t, params, balance)
        .groupBy("product_type", "channel")
        .agg(*[F.sum(c).cast("decimal(28,2)").alias(c) for c in sums], F.count(F.lit(1)).alias("loan_months"))
    )
    product, channel = F.col("product_type"), F.col("channel")
    return (
        cells.groupingSets([[product], [channel], [product, channel]], product, channel)
        .agg(
            F.sum("loan_months").alias("loan_months"),
            *[F.sum(c).cast("decimal(38,2)").alias(c) for c in sums],
        )
        .withColumn("nii_margin", ratio(F.col("nii_est"), F.col("eop_balance")))
        .withColumn("rar_margin", ratio(F.col("rar_profit_est"), F.col("eop_balance")))
    )


def pricing_effectiveness(
    t: Tables,
    params: Params = DEFAULTS,
    by: tuple = ("product_type", "channel"),
    balance: str = "principal",
) -> DataFrame:
    """Average APR next to the 60+ rate and the risk-adjusted margin of a segment."""
    return (
        _commercial(t, params, balance)
        .groupBy(*by)
        .agg(
            (F.sum("interest_rate_apr").cast("double") / F.count("interest_rate_apr")).alias("avg_apr"),
            share(in_buckets(F.col("dpd_bucket"), BUCKETS_60P)).alias("rate_60p"),
            ratio(F.sum("rar_profit_est"), F.sum("eop_balance")).alias("rar_margin"),
        )
    )
