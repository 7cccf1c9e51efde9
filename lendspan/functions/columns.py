"""Column expressions shared by the operators."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import BUCKETS

def no_cents() -> Column:
    return F.lit(0).cast("long")


def cents(name: str) -> Column:
    """Exact whole cents, so sums and windows run on plain longs."""
    return (F.col(name).cast("decimal(14,2)") * 100).cast("long")


def money(amount_cents: Column) -> Column:
    """Whole cents back to a two-digit decimal."""
    return (amount_cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def in_buckets(bucket: Column, buckets: tuple) -> Column:
    return bucket.isin(*buckets)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0).cast("long")


def share(condition: Column) -> Column:
    """Share of rows that meet a condition, as an exact count ratio."""
    return F.sum(flag(condition)).cast("double") / F.count(F.lit(1))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL on a zero denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def dpd_bucket(arrears: Column, missed: Column, cutoffs: tuple) -> Column:
    """A NULL missed count (zero average installment) falls to the worst bucket."""
    at_30, at_60, at_90 = cutoffs
    return (
        F.when(arrears <= 0, BUCKETS[0])
        .when(missed < at_30, BUCKETS[1])
        .when(missed < at_60, BUCKETS[2])
        .when(missed < at_90, BUCKETS[3])
        .otherwise(BUCKETS[4])
    )


def bucket_rank(bucket: Column) -> Column:
    """0 for the best bucket to 4 for the worst."""
    return (F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), bucket) - 1).cast("int")


def by_bucket(bucket: Column, values: dict) -> Column:
    """A value per bucket; NULL or unknown takes that of the worst one."""
    *better, worst = BUCKETS
    expr = F
    for name in better:
        expr = expr.when(bucket == name, F.lit(values[name]))
    return expr.otherwise(F.lit(values[worst]))


def half_up(numerator: Column, denominator: int) -> Column:
    """Quotient of whole numbers (longs or wide decimals), rounded half away from zero."""
    twice, half = 2 * numerator, F.lit(denominator).cast("long")
    whole = F.lit(2 * denominator).cast("long")
    return F.when(numerator >= 0, F.call_function("div", twice + half, whole)).otherwise(
        F.call_function("div", twice - half, whole)
    )


def months_between(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
