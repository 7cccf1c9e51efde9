import random
from decimal import Decimal as D

import numpy as np
import pytest
from conftest import customer, day, due, loan, paid, rows
from pyspark.sql import functions as F

from lendspan import Params
from lendspan.ml import model as ml
from lendspan.ml.split import stratified_split
from lendspan.operators import risk

MONTHS = [f"2024-{m:02d}-10" for m in range(1, 8)]


def test_rolling_features_use_the_rows_there_are(make_tables):
    t = make_tables(
        [loan(1)],
        [due(1, m, "100") for m in MONTHS[:4]],
        [paid(1, MONTHS[0], "100"), paid(1, MONTHS[1], "40"), paid(1, MONTHS[2], "100")],
    )
    found = rows(risk.features_3m(t), "roll3_paid_full_rate", "roll3_missed_cnt", "roll3_avg_arrears", "month_end")
    assert sorted(found, key=lambda r: r[-1]) == [
        (1.0, 0, 0.0, day("2024-01-31")),
        (0.5, 1, 30.0, day("2024-02-29")),
        (2 / 3, 1, 40.0, day("2024-03-31")),
        (1 / 3, 2, pytest.approx(280 / 3), day("2024-04-30")),
    ]
    assert [r[-1] for r in rows(risk.pay_behaviour_monthly(t))] == [1, 0, 1, 0]


def test_features_need_a_known_customer_but_labels_do_not(make_tables):
    t = make_tables([loan(1), loan(2, customer_id=99)], [due(1, MONTHS[0], "5"), due(2, MONTHS[5], "5")])
    assert {r.loan_id for r in risk.features_3m(t).collect()} == {1}
    assert {r.loan_id for r in risk.labels_60p_3m(t).collect()} == {1, 2}
    # the newest label month is later than the newest feature month
    months = Params(training_months=2)
    assert rows(risk.recent_features(t, months), "loan_id") == [(1,)]
    assert rows(risk.recent_labels(t, months), "loan_id") == [(2,)]
    assert risk.training_set(t, months).count() == 0
    assert rows(risk.training_set(t), "loan_id") == [(1,)]


def test_labels_look_three_rows_ahead_and_skip_the_current(make_tables):
    # 60+ is reached in the third month and cured in the sixth
    t = make_tables(
        [loan(1)],
        [due(1, m, "100") for m in MONTHS],
        [paid(1, MONTHS[0], "100"), paid(1, MONTHS[5], "500"), paid(1, MONTHS[6], "100")],
    )
    labels = rows(risk.labels_60p_3m(t), "month_end", risk.LABEL)
    assert [r[1] for r in labels] == [1, 1, 1, 1, 0, 0, 0]


def test_training_window_counts_calendar_months(spark, make_tables):
    frame = spark.createDataFrame(
        [(day(d),) for d in ("2022-02-27", "2022-02-28", "2022-03-31", "2024-02-29")], "month_end date"
    )
    kept = rows(risk.training_window(frame, 24))
    assert kept == [(day("2022-02-28"),), (day("2022-03-31"),), (day("2024-02-29"),)]


def labelled(spark, n, seed=1):
    """Rows in which missed installments and score drive the label."""
    rng = random.Random(seed)
    found = []
    for i in range(n):
        score, missed = rng.randint(450, 850), rng.randint(0, 3)
        bad = int(rng.random() < 1 / (1 + 2.718 ** -((650 - score) / 60 + missed - 2)))
        found.append(
            (i, day("2024-01-31"), rng.choice(["DPD_0", "DPD_1_29"]), D(0), D(rng.randint(0, 9000)),
             rng.choice(["Auto", "SME"]), rng.choice(["Online", "Broker"]), D("0.1200"), score,
             D(rng.randint(20000, 90000)), rng.choice(["Salaried", "Student"]),
             1 - missed / 3, missed, float(missed * 50), bad)
        )
    return spark.createDataFrame(
        found,
        "loan_id long, month_end date, dpd_bucket string, arrears_amt decimal(18,2), eop_balance decimal(18,2), "
        "product_type string, channel string, interest_rate_apr decimal(6,4), credit_score int, "
        "annual_income_nzd decimal(12,2), employment_type string, roll3_paid_full_rate double, "
        "roll3_missed_cnt long, roll3_avg_arrears double, will_be_60p_in_3m int",
    )


@pytest.mark.parametrize("n", [5, 61, 1000])
def test_split_has_the_exact_share_per_class(spark, n):
    frame = labelled(spark, n)
    split = stratified_split(frame, risk.LABEL)
    sizes = {r[risk.LABEL]: r["count"] for r in frame.groupBy(risk.LABEL).count().collect()}
    tested = {r[risk.LABEL]: r["count"] for r in split.where("is_test").groupBy(risk.LABEL).count().collect()}
    assert split.count() == n
    assert tested == {label: -(-size // 4) for label, size in sizes.items()}
    again = stratified_split(frame.repartition(3), risk.LABEL)
    assert rows(split, "loan_id", "is_test") == rows(again, "loan_id", "is_test")
    other = stratified_split(frame, risk.LABEL, Params(split_seed=7))
    assert n < 20 or rows(other, "loan_id", "is_test") != rows(split, "loan_id", "is_test")


def test_unseen_category_is_all_zeros(spark):
    frame = labelled(spark, 40)
    encoding = ml.fit_encoder(frame)
    unseen = frame.limit(1).withColumn("product_type", F.lit("Boat"))
    (row,) = ml.named_features(encoding, unseen).collect()
    values = row.asDict()
    assert (values["product_type=Auto"], values["product_type=SME"]) == (0.0, 0.0)
    assert values["channel=Online"] + values["channel=Broker"] == 1.0
    assert len(ml.feature_names(encoding)) == 7 + 8


def test_model_finds_a_planted_signal(spark):
    frame = labelled(spark, 1500)
    split = stratified_split(frame, risk.LABEL)
    model = ml.fit_risk_model(split.where(~F.col("is_test")))
    scored = ml.score(model, split.where("is_test"))
    metrics = ml.evaluate_scores(scored, risk.LABEL).first()
    assert metrics.auc > 0.75 and metrics.recall > 0.6
    names = ml.feature_names(model)
    weights = dict(zip(names, model.stages[-1].coefficients))
    assert weights["credit_score"] < 0


def test_the_fit_is_at_the_minimum(spark):
    frame = labelled(spark, 600)
    model = ml.fit_risk_model(frame)
    gradient = {r.feature: r.gradient for r in ml.fit_gradient(model, frame).collect()}
    assert set(gradient) == {"intercept", *ml.feature_names(model)}
    assert max(abs(g) for g in gradient.values()) < 1e-7
    # a fit that stops early is not
    early = {r.feature: r.gradient for r in ml.fit_gradient(ml.fit_risk_model(frame, Params(max_iter=2)), frame).collect()}
    assert max(abs(g) for g in early.values()) > 1e-4
    # the derivative by brute force
    fitted = model.stages[-1]
    vectors = model.transform(ml._numeric_as_double(frame)).select("features", risk.LABEL).collect()
    x = np.array([r.features.toArray() for r in vectors])
    y = np.array([r[risk.LABEL] for r in vectors])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))

    def loss(moved):
        z = x @ (fitted.coefficients.toArray() + moved) + fitted.intercept
        penalty = ((fitted.coefficients.toArray() + moved) ** 2).sum() / 2
        return ((weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum() + penalty) / len(y)

    early_model = ml.fit_risk_model(frame, Params(max_iter=2))
    fitted = early_model.stages[-1]
    for i, name in enumerate(ml.feature_names(early_model)):
        step = np.zeros(x.shape[1])
        step[i] = 1e-4 / (x[:, i].std() or 1)
        slope = (loss(step) - loss(-step)) / 2e-4
        assert early[name] == pytest.approx(slope, abs=1e-6)


def test_model_needs_both_classes(spark):
    frame = labelled(spark, 30).withColumn(risk.LABEL, F.lit(0))
    with pytest.raises(ValueError):
        ml.fit_risk_model(frame)


def test_train_scores_every_recent_row(make_tables):
    rng = random.Random(5)
    loans, schedule, payments, people = [], [], [], []
    for i in range(40):
        people.append(customer(i, score=rng.randint(450, 850)))
        loans.append(loan(i, customer_id=i, opened="2023-12-01"))
        for m in MONTHS:
            schedule.append(due(i, m, "100", "80"))
            if rng.random() < (0.3 if i % 2 else 0.9):
                payments.append(paid(i, m, "100"))
    t = make_tables(loans, schedule, payments, people)
    trained = ml.train_risk_model(t)
    assert trained.scores.columns == ["loan_id", "month_end", "risk_score", risk.LABEL]
    assert trained.scores.count() == 40 * len(MONTHS)
    low, high = trained.scores.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0 <= low < high <= 1
    metrics = trained.metrics.first()
    assert metrics.n == sum(-(-r["count"] // 4) for r in trained.scores.groupBy(risk.LABEL).count().collect())
    assert metrics.auc > 0.5


def test_rows_are_encoded_and_scored_once(make_tables):
    rng = random.Random(5)
    loans, schedule, payments, people = [], [], [], []
    for i in range(40):
        people.append(customer(i, score=rng.randint(450, 850)))
        loans.append(loan(i, customer_id=i, opened="2023-12-01"))
        for m in MONTHS:
            schedule.append(due(i, m, "100", "80"))
            if rng.random() < (0.3 if i % 2 else 0.9):
                payments.append(paid(i, m, "100"))
    t = make_tables(loans, schedule, payments, people)
    trained = ml.train_risk_model(t)
    # what is returned reads stored scores
    assert "UDF" not in trained.scores._jdf.queryExecution().optimizedPlan().toString()
    again = ml.score(trained.model, risk.training_set(t)).select(*trained.scores.columns)
    assert rows(trained.scores) == rows(again)
