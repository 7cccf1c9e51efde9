"""Evaluation, distribution and ranking of risk scores."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flag, ratio
from ..functions.ordering import quantile_position, top_n_per_group
from ..functions.ranges import in_ranges, running_totals
from ..params import DEFAULTS, Params
from ..session import Scratch


def _watchlist_order() -> tuple:
    return (
        F.col("risk_score").desc(),
        F.col("eop_balance").desc_nulls_last(),
        F.col("loan_id"),
        F.col("month_end"),
    )


def rank_watchlist(watchlist: DataFrame, n: int) -> DataFrame:
    """The n loan-months of highest score, then highest balance."""
    return watchlist.orderBy(*_watchlist_order()).limit(n)


def rank_watchlist_by_month(watchlist: DataFrame, n: int) -> DataFrame:
    """The first n loans of every month."""
    return top_n_per_group(
        watchlist, ("month_end",), _watchlist_order(), n, ("loan_id",)
    )


def _by_score() -> tuple:
    return (F.col("risk_score"),)


def score_summary(scored: DataFrame, scratch: Scratch, label: str | None = None) -> DataFrame:
    """One row per distinct score: rows, bad and good, range-partitioned and stored once.

    All statistics below read this. However many rows share a score, it is one row here;
    rows without a score are one row of their own. Without a label bad and good are 0.
    """
    count = lambda value: F.sum(flag(F.col(label) == value)) if label else F.sum(F.lit(0))
    totals = scored.groupBy("risk_score").agg(
        F.count(F.lit(1)).alias("rows"), count(1).alias("bad"), count(0).alias("good")
    )
    return in_ranges(totals, _by_score(), scratch)


def _scored(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("risk_score").isNotNull())


def _now(result: DataFrame) -> DataFrame:
    """A result of a few rows, computed now, so that what it was read from can go."""
    return result.sparkSession.createDataFrame(result.collect(), result.schema)


def _confusion(classes: DataFrame, threshold: float) -> DataFrame:
    """Counts, precision, recall and F1 at a threshold; 0 where undefined."""
    hit, bad, good = F.col("risk_score") >= threshold, F.col("bad"), F.col("good")
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    counts = classes.agg(
        total(bad + good).alias("n"),
        total(F.when(hit, bad)).alias("tp"),
        total(F.when(hit, good)).alias("fp"),
        total(F.when(~hit, bad)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return counts.select(
        "*",
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def _rank_sum(classes: DataFrame) -> DataFrame:
    """Share of bad-good pairs in which the bad row scores higher; a tie counts one half."""
    ordered = running_totals(classes, _by_score(), ("good", "bad"))
    # twice the number of pairs won, as a whole number
    won = F.col("bad").cast("decimal(19,0)") * (2 * F.col("good_before") + F.col("good"))
    return ordered.agg(
        F.sum(won).alias("won2"), F.sum("bad").alias("bad"), F.sum("good").alias("good")
    ).select(
        ratio(
            F.col("won2").cast("double") / 2, F.col("bad").cast("double") * F.col("good")
        ).alias("auc")
    )


def evaluation_of(summary: DataFrame, threshold: float = DEFAULTS.threshold) -> DataFrame:
    classes = _scored(summary)
    unscored = summary.agg(F.coalesce(F.sum(F.when(F.col("risk_score").isNull(), F.col("rows"))), F.lit(0)))
    return _confusion(classes, threshold).select(
        "*", _rank_sum(classes).scalar().alias("auc"), unscored.scalar().alias("n_unscored")
    )


def evaluate_scores(scored: DataFrame, label: str, threshold: float = DEFAULTS.threshold) -> DataFrame:
    """One row: counts, precision, recall, F1 and exact AUC (NULL with one class only).

    Rows without a score enter nothing but n_unscored. The scored rows are read once, by a
    job that runs now.
    """
    with Scratch(scored.sparkSession) as scratch:
        return _now(evaluation_of(score_summary(scored, scratch, label), threshold))


def histogram_of(summary: DataFrame, bins: int = DEFAULTS.histogram_bins) -> DataFrame:
    known = _scored(summary)
    span = known.agg(F.min("risk_score").alias("low"), F.max("risk_score").alias("high"))
    # a single value gets a range of one around it
    single = F.col("low") == F.col("high")
    span = span.select(
        F.struct(
            F.when(single, F.col("low") - 0.5).otherwise(F.col("low")).alias("lo"),
            F.when(single, F.col("high") + 0.5).otherwise(F.col("high")).alias("hi"),
        ).alias("span")
    )
    limits = span.scalar()
    position = (F.col("risk_score") - limits["lo"]) / (limits["hi"] - limits["lo"]) * bins
    counts = known.groupBy(
        (F.least(F.floor(position), F.lit(bins - 1)) + 1).cast("int").alias("bin")
    ).agg(F.sum("rows").alias("scores"))
    edges = span.where(F.col("span.lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "span"
    )
    width = (F.col("span.hi") - F.col("span.lo")) / bins
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("span.lo") + width * (F.col("bin") - 1)).alias("bin_from"),
        (F.col("span.lo") + width * F.col("bin")).alias("bin_to"),
        F.coalesce("scores", F.lit(0)).alias("scores"),
    )


def score_histogram(scores: DataFrame, bins: int = DEFAULTS.histogram_bins) -> DataFrame:
    """Equal-width bins over the score range with the last one closed; empty bins count 0.

    The scores are read once, by a job that runs now.
    """
    with Scratch(scores.sparkSession) as scratch:
        return _now(histogram_of(score_summary(scores, scratch), bins))


def score_box_plot(scores: DataFrame) -> DataFrame:
    """Quartiles and whiskers (the outermost scores within 1.5 interquartile ranges), by a job that runs now."""
    with Scratch(scores.sparkSession) as scratch:
        return _now(box_of(score_summary(scores, scratch)))


def score_statistics(
    scored: DataFrame, label: str, threshold: float = DEFAULTS.threshold, bins: int = DEFAULTS.histogram_bins
) -> DataFrame:
    """Evaluation, quartiles and histogram of one summary as rows (statistic, value), by jobs that run now."""
    with Scratch(scored.sparkSession) as scratch:
        summary = score_summary(scored, scratch, label)
        parts = []
        for frame in (evaluation_of(summary, threshold), box_of(summary)):
            named = [F.struct(F.lit(c).alias("statistic"), F.col(c).cast("double").alias("value")) for c in frame.columns]
            parts.append(frame.select(F.explode(F.array(*named)).alias("s")).select("s.*"))
        bars = histogram_of(summary, bins).select(
            F.format_string("bin_%d", "bin").alias("statistic"), F.col("scores").cast("double").alias("value")
        )
        return _now(parts[0].unionByName(parts[1]).unionByName(bars))


def box_of(summary: DataFrame) -> DataFrame:
    per_score = _scored(summary)
    ordered = running_totals(per_score, _by_score(), ("rows",))
    total = per_score.agg(F.sum("rows").alias("rows")).scalar()

    def at(position):
        here = (F.col("rows_before") <= position) & (position < F.col("rows_before") + F.col("rows"))
        return F.max(F.when(here, F.col("risk_score")))

    parts = []
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        position = quantile_position(F.col("total"), q)
        below = at(F.floor(position))
        above = at(F.ceil(position))
        parts.append((below + (above - below) * F.first(position - F.floor(position))).alias(name))
    quartiles = ordered.withColumn("total", total).agg(*parts)
    box = quartiles.select(F.struct("q1", "median", "q3").alias("box")).scalar()
    reach = 1.5 * (F.col("box.q3") - F.col("box.q1"))
    value = F.col("risk_score")
    fenced = per_score.withColumn("box", box)
    return (
        fenced.groupBy("box")
        .agg(
            F.min(F.when(value >= F.col("box.q1") - reach, value)).alias("low"),
            F.max(F.when(value <= F.col("box.q3") + reach, value)).alias("high"),
        )
        .select(
            F.least("low", "box.q1").alias("whisker_low"),
            "box.q1",
            "box.median",
            "box.q3",
            F.greatest("high", "box.q3").alias("whisker_high"),
        )
    )


def score_vs_balance(watchlist: DataFrame) -> DataFrame:
    return watchlist.where(F.col("risk_score").isNotNull()).select("risk_score", "eop_balance")


def top_risk_loans(watchlist: DataFrame, n: int = 20) -> DataFrame:
    return (
        watchlist.orderBy(F.col("risk_score").desc(), "loan_id", "month_end")
        .limit(n)
        .select("loan_id", "month_end", "risk_score", "eop_balance")
    )


def top_risk_balance(watchlist: DataFrame, by: tuple = ("month_end",), params: Params = DEFAULTS) -> DataFrame:
    """Balance of the highest scored loans of each slice; ties with the last one are kept.

    Rows are first summed per distinct score. The loans sought lie within the first
    `top_risk_loans` distinct scores of a slice, so no more than that reach one task
    from any input split, however many loans tie.
    """
    per_score = watchlist.groupBy(*by, "risk_score").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("eop_balance").alias("balance")
    )
    return top_balance_of_scores(per_score, by, params)


def top_balance_of_scores(per_score: DataFrame, by: tuple, params: Params = DEFAULTS) -> DataFrame:
    """The same from rows (by, risk_score, loans, balance) that were summed before."""
    known = per_score.where(F.col("risk_score").isNotNull())
    return highest_scores(known, by, params.top_risk_loans).groupBy(*by).agg(
        F.sum("loans").alias("top_risk_loans"), F.sum("balance").alias("top_risk_balance")
    )


def highest_scores(per_score: DataFrame, by: tuple, n: int) -> DataFrame:
    """The distinct scores of each slice with fewer than n loans above them."""
    best = (F.col("risk_score").desc(),)
    if by:
        kept = top_n_per_group(per_score, by, best, n, ("risk_score",))
    else:
        kept = per_score.orderBy(*best).limit(n)
    higher = Window.partitionBy(*by).orderBy(*best).rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("loans").over(higher), F.lit(0))
    return kept.withColumn("_higher", above).where(F.col("_higher") < n).drop("_higher")
