import random

import numpy as np
import pytest
from conftest import day, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendspan import Params
from lendspan.functions import ordering, ranges
from lendspan.session import Scratch
from lendspan.operators import scores

LABEL = "will_be_60p_in_3m"


def scored(spark, pairs):
    return spark.createDataFrame([(float(s), int(y)) for s, y in pairs], f"risk_score double, {LABEL} int")


def brute_auc(pairs):
    bad = [s for s, y in pairs if y == 1]
    good = [s for s, y in pairs if y == 0]
    won = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    return won / (len(bad) * len(good))


@pytest.mark.parametrize("digits", [1, 6])
def test_auc_is_exact_with_and_without_ties(spark, digits):
    rng = random.Random(digits)
    pairs = [(round(rng.random(), digits), int(rng.random() < 0.3)) for _ in range(700)]
    frame = scored(spark, pairs)
    (row,) = scores.evaluate_scores(frame, LABEL, 0.5).collect()
    assert row.auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="risk_score", labelCol=LABEL, numBins=0)
    assert row.auc == pytest.approx(evaluator.evaluate(frame), abs=1e-9)
    tp = sum(s >= 0.5 and y == 1 for s, y in pairs)
    fp = sum(s >= 0.5 and y == 0 for s, y in pairs)
    fn = sum(s < 0.5 and y == 1 for s, y in pairs)
    assert (row.tp, row.fp, row.fn, row.n) == (tp, fp, fn, 700)
    assert row.precision == pytest.approx(tp / (tp + fp)) and row.recall == pytest.approx(tp / (tp + fn))
    assert row.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_undefined_metrics_are_zero_and_auc_is_null(spark):
    (row,) = scores.evaluate_scores(scored(spark, [(0.1, 0), (0.2, 0)]), LABEL).collect()
    assert (row.precision, row.recall, row.f1, row.auc) == (0.0, 0.0, 0.0, None)


@pytest.mark.parametrize("parts", ["2", "7", "40"])
def test_running_totals_do_not_depend_on_the_ranges(spark, parts):
    # most values sit in a narrow band, one far away
    values = sorted({random.Random(3).gauss(0, 1e-9) * i for i in range(1, 300)} | {5.0})
    frame = spark.createDataFrame([(v, i + 1) for i, v in enumerate(values)], "v double, n long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        with Scratch(spark) as scratch:
            order = (F.col("v"),)
            found = ranges.running_totals(ranges.in_ranges(frame, order, scratch), order, ("n",)).orderBy("v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = np.cumsum([0] + list(range(1, len(values))))
    assert [r.n_before for r in found] == expected.tolist()


def test_rows_without_a_score_are_counted_apart(spark):
    frame = scored(spark, [(0.9, 1), (0.2, 0)]).unionByName(
        spark.sql(f"SELECT CAST(NULL AS DOUBLE) AS risk_score, 1 AS {LABEL}")
    )
    (row,) = scores.evaluate_scores(frame, LABEL).collect()
    assert (row.n, row.tp, row.fp, row.fn, row.recall, row.auc, row.n_unscored) == (2, 1, 0, 0, 1.0, 1.0, 1)


def test_statistics_leave_nothing_behind(spark, tmp_path):
    import os

    from lendspan.session import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    frame = scored(spark, [(0.1 * k, k % 2) for k in range(9)])
    scores.evaluate_scores(frame, LABEL).collect()
    scores.score_box_plot(frame).collect()
    assert set(os.listdir(folder)) == before


def test_histogram_has_every_bin_and_closes_the_last(spark):
    pairs = [(v, 0) for v in (0.0, 0.1, 0.1, 0.95, 1.0)]
    frame = scored(spark, pairs).unionByName(spark.sql(f"SELECT CAST(NULL AS DOUBLE) AS risk_score, 1 AS {LABEL}"))
    found = scores.score_histogram(frame, 10).orderBy("bin").collect()
    assert [r.scores for r in found] == np.histogram([v for v, _ in pairs], bins=10)[0].tolist()
    assert found[0].bin_from == 0.0 and found[-1].bin_to == 1.0


def test_statistics_read_one_stored_summary(spark, monkeypatch):
    rng = random.Random(8)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(300)]
    frame = scored(spark, pairs).unionByName(spark.sql(f"SELECT CAST(NULL AS DOUBLE) AS risk_score, 1 AS {LABEL}"))
    reads = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda s: reads.add(1) or s, "double")(F.col("risk_score"))
    watched = frame.coalesce(1).withColumn("risk_score", seen.alias("risk_score"))
    stores = []
    plain = Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, df: stores.append(1) or plain(self, df))
    found = {r.statistic: r.value for r in scores.score_statistics(watched, LABEL, 0.5, 10).collect()}
    # every row is read once and one table is stored for all statistics
    assert (reads.value, len(stores)) == (301, 1)
    evaluation = scores.evaluate_scores(frame, LABEL, 0.5).first().asDict()
    assert {k: found[k] for k in evaluation} == evaluation and evaluation["n_unscored"] == 1
    box = scores.score_box_plot(frame).first().asDict()
    assert {k: found[k] for k in box} == box
    bars = scores.score_histogram(frame, 10).collect()
    assert {f"bin_{r.bin}": r.scores for r in bars} == {k: v for k, v in found.items() if k.startswith("bin_")}
    stores.clear()
    scores.score_histogram(frame, 10)
    assert len(stores) == 1


def test_statistics_of_no_scores(spark):
    empty = scored(spark, []).limit(0)
    assert scores.score_histogram(empty).count() == 0
    assert scores.score_box_plot(empty).count() == 0
    row = scores.evaluate_scores(empty, LABEL).first()
    assert (row.n, row.auc, row.n_unscored) == (0, None, 0)


def test_histogram_of_a_single_value(spark):
    found = scores.score_histogram(scored(spark, [(0.3, 0)] * 4), 50).orderBy("bin").collect()
    assert [r.scores for r in found] == np.histogram([0.3] * 4, bins=50)[0].tolist()


@pytest.mark.parametrize("n", [1, 2, 9, 240])
def test_box_plot_matches_numpy(spark, n):
    rng = random.Random(n)
    values = [round(rng.lognormvariate(-2, 1), 3) for _ in range(n)]
    (row,) = scores.score_box_plot(scored(spark, [(v, 0) for v in values])).collect()
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    expected = (min(min(inside), q1), q1, median, q3, max(max(inside), q3))
    assert tuple(row) == pytest.approx(expected)


def watchlist(spark, found):
    return spark.createDataFrame(
        found, "month_end date, loan_id long, risk_score double, eop_balance decimal(18,2)"
    )


def test_top_risk_balance_keeps_ties_at_the_limit(spark):
    from decimal import Decimal as D

    jan, feb = day("2024-01-31"), day("2024-02-29")
    frame = watchlist(
        spark,
        [(jan, i, s, D(10**i)) for i, s in enumerate([0.9, 0.8, 0.7, 0.7, 0.7, 0.1])]
        + [(feb, i, 0.5, D(1)) for i in range(5)],
    )
    found = rows(scores.top_risk_balance(frame, ("month_end",), Params(top_risk_loans=3)))
    assert found == [(jan, 5, D("11111.00")), (feb, 5, D("5.00"))]
    assert rows(scores.top_risk_balance(frame, (), Params(top_risk_loans=1))) == [(1, D("1.00"))]


def test_ranking_orders_by_score_then_balance(spark):
    from decimal import Decimal as D

    jan = day("2024-01-31")
    frame = watchlist(spark, [(jan, 1, 0.5, D(1)), (jan, 2, 0.5, D(9)), (jan, 3, 0.9, D(1)), (jan, 4, 0.5, None)])
    assert [r.loan_id for r in scores.rank_watchlist(frame, 3).collect()] == [3, 2, 1]
    assert {r.loan_id for r in scores.rank_watchlist_by_month(frame, 2).collect()} == {2, 3}


def test_top_rows_of_one_large_group(spark):
    frame = spark.range(500).select(
        F.lit(1).alias("g"), F.col("id").alias("loan_id"), F.xxhash64("id").alias("v")
    )
    order = (F.col("v").desc(), F.col("loan_id"))
    found = rows(ordering.top_n_per_group(frame, ("g",), order, 40, ("loan_id",)))
    assert found == rows(frame.orderBy(*order).limit(40)) and len(found) == 40
