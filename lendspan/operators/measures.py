"""Business measures under any slice of the portfolio."""

import sys
from decimal import Decimal
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import flag, in_buckets, ratio
from ..params import BUCKETS_30P, BUCKETS_60P, BUCKETS_90P, DEFAULTS, Params
from ..session import materialise
from ..tables import Tables
from .commercial import MEASURE_COLUMNS, with_commercial
from .ledger import loan_months
from .scores import highest_scores, top_balance_of_scores


# Decimals of a score in its average: sums of whole units do not depend on row order.
SCORE_DIGITS = 12
# Scores at which a cube counts the loans of a cell, to tell which can be among its highest.
SCORE_EDGES = tuple(k / 32 for k in range(1, 33))
# Longs are summed in two parts, so that no sum of theirs leaves a long.
LOW_BITS = 32


def measured_months(t: Tables, scores: Optional[DataFrame] = None, params: Params = DEFAULTS) -> DataFrame:
    """The loan-months that measures read, joined with a stored score table if one is given."""
    months = with_commercial(loan_months(t, params), params, base="principal_base")
    if scores is None:
        return months
    found = scores.select("loan_id", "month_end", "risk_score")
    return months.join(found, ["loan_id", "month_end"], "left")


def portfolio_measures(
    t: Tables,
    by: tuple = ("month_end",),
    scores: Optional[DataFrame] = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Counts, rates, balances and commercial totals of each slice; rows are loan-months.

    Margins divide principal-based results by the amortised balance. With `scores`,
    the average risk score and the balance of the top scored loans are added.
    """
    return measures_of(measured_months(t, scores, params), by, scores is not None, params)


def _sums() -> dict[str, Column]:
    bucket, balance = F.col("dpd_bucket"), F.col("eop_balance")
    bad = in_buckets(bucket, BUCKETS_60P)
    return {
        "loans": F.count(F.lit(1)),
        "loans_30p": F.sum(flag(in_buckets(bucket, BUCKETS_30P))),
        "loans_60p": F.sum(flag(bad)),
        "loans_90p": F.sum(flag(in_buckets(bucket, BUCKETS_90P))),
        "eop_balance_total": F.sum(balance),
        "eop_60p_balance": F.sum(F.when(bad, balance)),
        **{c: F.sum(c) for c in MEASURE_COLUMNS},
    }


SUMS = ("loans", "loans_30p", "loans_60p", "loans_90p", "eop_balance_total", "eop_60p_balance", *MEASURE_COLUMNS)


def _per_score(months: DataFrame, by: tuple) -> DataFrame:
    """What the ranking reads of loan-months: their number and balance per slice and score."""
    return months.groupBy(*by, "risk_score").agg(
        F.count(F.lit(1)).alias("loans"),
        _amount_total(F.col("eop_balance"), months.schema["eop_balance"].dataType).alias("eop_balance_total"),
    )


def _slices(months: DataFrame, by: tuple) -> DataFrame:
    """Scored loan-months summed per slice: few rows leave each task, however many scores there are."""
    return months.groupBy(*by).agg(*_slice_sums(months))


def _slice_sums(months: DataFrame) -> list[Column]:
    score, bad = F.col("risk_score"), in_buckets(F.col("dpd_bucket"), BUCKETS_60P)
    amounts = {
        "eop_balance_total": ("eop_balance", F.col("eop_balance")),
        "eop_60p_balance": ("eop_balance", F.when(bad, F.col("eop_balance"))),
        **{c: (c, F.col(c)) for c in MEASURE_COLUMNS},
    }
    counts = [value.alias(name) for name, value in _sums().items() if name not in amounts]
    largest = F.lit(sys.float_info.max)
    # NaN and the infinite scores have no units
    units = F.when(F.abs(score) <= largest, F.rint(score * 10.0**SCORE_DIGITS)).cast("long")
    return [
        *counts,
        *[_amount_total(value, months.schema[source].dataType).alias(name) for name, (source, value) in amounts.items()],
        _whole_total(units, SCORE_DIGITS).alias("score_total"),
        F.sum(F.when(score.isNotNull(), 1)).alias("scored_loans"),
    ]


def _amount_total(amount: Column, kind: T.DataType) -> Column:
    """The exact sum of amounts, which are decimals, or longs of whole cents."""
    return _whole_total(amount, 2) if isinstance(kind, T.LongType) else F.sum(amount).cast("decimal(38,2)")


def _whole_total(number: Column, digits: int) -> Column:
    """The exact sum of longs, read as units of the last of so many decimals.

    High and low parts are summed as longs, which is far quicker than a sum of decimals.
    """
    high, low = F.shiftright(number, LOW_BITS), number.bitwiseAND(F.lit(2**LOW_BITS - 1))
    total = F.sum(high).cast("decimal(20,0)") * F.lit(Decimal(2**LOW_BITS)) + F.sum(low).cast("decimal(20,0)")
    # so wide that the product keeps every decimal
    return (total.cast(f"decimal({37 - digits},0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")


def measures_of(months: DataFrame, by: tuple, scored: bool, params: Params = DEFAULTS) -> DataFrame:
    """The measures of loan-months that carry the commercial columns and, if scored, risk_score.

    Scored rows are summed per slice for the totals, and per slice and score for the ranking.
    """
    if not scored:
        return _with_rates(months.groupBy(*by).agg(*[value.alias(name) for name, value in _sums().items()]))
    return _with_scores(_slices(months, by), _per_score(months, by), by, params)


def _with_rates(totals: DataFrame) -> DataFrame:
    loans, held = F.col("loans"), F.col("eop_balance_total")
    return totals.select(
        "*",
        ratio(F.col("loans_30p"), loans).alias("rate_30p"),
        ratio(F.col("loans_60p"), loans).alias("rate_60p"),
        ratio(F.col("loans_90p"), loans).alias("npl_90p_rate"),
        ratio(F.col("eop_60p_balance"), held).alias("eop_60p_rate"),
        ratio(F.col("nii_est"), held).alias("nii_margin"),
        ratio(F.col("rar_profit_est"), held).alias("rar_margin"),
    )


def _with_scores(totals: DataFrame, per_score: DataFrame, by: tuple, params: Params) -> DataFrame:
    """Measures of summed slices; `per_score` has at least the highest scores of each."""
    if not by:
        # a total over no rows counts zero loans
        totals = totals.fillna(0, ["loans"])
    average = ratio(F.col("score_total"), F.col("scored_loans")).alias("avg_risk_score")
    measured = _with_rates(totals.select("*", average).drop("score_total", "scored_loans"))
    per_score = per_score.select(*by, "risk_score", "loans", F.col("eop_balance_total").alias("balance"))
    top = top_balance_of_scores(per_score, by, params).drop("top_risk_loans")
    if not by:
        return measured.select("*", top.select("top_risk_balance").scalar().alias("top_risk_balance"))
    # a slice whose key is NULL keeps its top balance
    renamed = top.select(*[F.col(k).alias(f"_{k}") for k in by], "top_risk_balance")
    same_slice = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    return measured.join(renamed, same_slice, "left").drop(*[f"_{k}" for k in by])


# The finest slices of a cube.
CELL = ("month_end", "product_type", "channel", "region")


def measure_cube(months: DataFrame, cell: tuple = CELL, params: Params = DEFAULTS) -> DataFrame:
    """Cells from which `cube_measures` answers any coarser slice; store it once.

    `months` are scored loan-months with the commercial columns, amounts as decimals or as longs
    of whole cents. A cell is one row of sums
    (risk_score NULL) and one row for each of its highest distinct scores. The loans sought in a
    coarser slice have fewer loans above them in their cell than in the slice, so cells that
    keep as many as are sought lose none.

    `months` is read twice, so pass a stored frame. The first pass sums the cells and counts
    their loans from each of SCORE_EDGES up; its small result is stored by a job that runs now. The
    second reads scores and balances, and of these only what can be among the highest: with as many
    loans as are sought from an edge up, no score below that edge has fewer above it.
    """
    at_least = {f"_from_{i}": F.sum(flag(F.col("risk_score") >= edge)) for i, edge in enumerate(SCORE_EDGES)}
    counted = materialise(
        months.groupBy(*cell).agg(*_slice_sums(months), *[count.alias(name) for name, count in at_least.items()])
    )
    enough = [F.when(F.col(name) >= params.top_risk_loans, F.lit(edge)) for name, edge in zip(at_least, SCORE_EDGES)]
    floors = counted.select(*[F.col(c).alias(f"_{c}") for c in cell], F.greatest(*enough).alias("_floor"))
    same_cell = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cell]
    # one row per cell: the floors are small, however many loan-months there are
    high = (
        months.where(F.col("risk_score").isNotNull())
        .select(*cell, "risk_score", "eop_balance")
        .join(F.broadcast(floors), same_cell)
        .where(F.col("_floor").isNull() | (F.col("risk_score") >= F.col("_floor")))
    )
    tops = highest_scores(_per_score(high, cell), cell, params.top_risk_loans)
    totals = counted.drop(*at_least).withColumn("risk_score", F.lit(None).cast("double"))
    return totals.unionByName(tops, allowMissingColumns=True)


def cube_measures(cube: DataFrame, by: tuple = ("month_end",), params: Params = DEFAULTS) -> DataFrame:
    """The measures of any slice by columns of the cell, as `portfolio_measures` gives them with scores."""
    is_cell = F.col("risk_score").isNull()
    sums = [F.sum(name).alias(name) for name in (*SUMS, "score_total", "scored_loans")]
    totals = cube.where(is_cell).groupBy(*by).agg(*sums)
    per_score = cube.where(~is_cell).groupBy(*by, "risk_score").agg(
        F.sum("loans").alias("loans"), F.sum("eop_balance_total").alias("eop_balance_total")
    )
    return _with_scores(totals, per_score, by, params)
