import random
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from conftest import day, due, loan, paid, rows
from pyspark.sql import functions as F

from lendspan import Params
from lendspan.functions.columns import by_bucket, half_up
from lendspan.operators import balance, commercial, delinquency, measures
from lendspan.params import DEFAULTS
from lendspan.session import Scratch


def test_balance_clamps_and_covers_every_later_month(make_tables):
    t = make_tables(
        [loan(1, opened="2024-02-10", principal="100"), loan(2, opened="2024-03-01", principal="50")],
        [
            due(1, "2024-01-10", "40"),  # before origination
            due(1, "2024-02-20", "60"),
            due(1, "2024-04-20", "90"),
            due(9, "2024-06-20", "1"),  # unknown loan still adds its month
        ],
    )
    assert rows(balance.balance_eop(t)) == [
        (1, day("2024-02-29"), D("40.00")),
        (1, day("2024-04-30"), D("0.00")),
        (1, day("2024-06-30"), D("0.00")),
        (2, day("2024-04-30"), D("50.00")),
        (2, day("2024-06-30"), D("50.00")),
    ]
    assert rows(balance.portfolio_snapshot_v2(t), "month_end", "eop_balance") == [
        (day("2024-01-31"), None),
        (day("2024-02-29"), D("40.00")),
        (day("2024-04-30"), D("0.00")),
    ]


def random_tables(make_tables, seed):
    rng = random.Random(seed)
    month = lambda: f"2024-{rng.randint(1, 9):02d}-{rng.randint(1, 28):02d}"
    money = lambda top: f"{rng.randint(0, top * 100) / 100:.2f}"
    loans = [loan(i, opened=month(), principal=money(900), apr=f"{rng.randint(0, 3000) / 1e4:.4f}") for i in range(1, 25)]
    schedule = [due(rng.randint(1, 26), month(), money(200), money(200)) for _ in range(150)]
    payments = [paid(rng.randint(1, 26), month(), money(200)) for _ in range(120)]
    return make_tables(loans, schedule, payments), loans, schedule


@pytest.mark.parametrize("seed", [1, 2])
def test_balance_matches_brute_force_and_the_snapshot_join(make_tables, seed):
    t, loans, schedule = random_tables(make_tables, seed)
    last = lambda d: day(f"2024-{d.month:02d}-{[31, 29, 31, 30, 31, 30, 31, 31, 30][d.month - 1]}")
    months = sorted({last(s[2]) for s in schedule})
    expected = []
    for row in loans:
        loan_id, opened, principal = row[0], last(row[3]), row[4]
        for month in months:
            if month >= opened:
                repaid = sum(s[4] for s in schedule if s[0] == loan_id and opened <= last(s[2]) <= month)
                expected.append((loan_id, month, max(D("0.00"), principal - repaid)))
    assert rows(balance.balance_eop(t)) == sorted(expected)
    joined = delinquency.portfolio_snapshot(t).join(balance.balance_eop(t), ["loan_id", "month_end"], "left")
    columns = ("loan_id", "month_end", "arrears_amt", "dpd_bucket", "eop_balance")
    assert rows(balance.portfolio_snapshot_v2(t), *columns) == rows(joined, *columns)


def test_half_up_rounds_away_from_zero(spark):
    values = [5, -5, 4, -4, 15, -15, 0, 14, -16]
    df = spark.createDataFrame([(v,) for v in values], "n long").select("n", half_up(F.col("n"), 10).alias("q"))
    assert {r.n: r.q for r in df.collect()} == {5: 1, -5: -1, 4: 0, -4: 0, 15: 2, -15: -2, 0: 0, 14: 1, -16: -2}


@pytest.mark.parametrize("params", [Params(), Params(funding_rate=D("0.0350123456789"), lgd=D("0.4512345"))])
def test_commercial_columns_of_the_longest_amounts_are_exact(spark, params):
    rng = random.Random(8)
    given = []
    for i in range(3000):
        amount = rng.choice([-1, 1, 1]) * rng.randint(0, rng.choice([9, 10**5, 10**10, 10**14 - 1]))
        amount = rng.choice([amount, amount // 10000 * 10000 + 5000])
        rate = rng.choice([rng.randint(0, 3000), rng.randint(-999999, 999999)])
        given.append((i, D(amount).scaleb(-2), D(rate).scaleb(-4), rng.choice([*params.pd_by_bucket])))
    months = spark.createDataFrame(
        given, "i int, principal_nzd decimal(14,2), interest_rate_apr decimal(6,4), dpd_bucket string"
    )
    found = {r.i: r for r in commercial.with_commercial(months, params).collect()}

    def whole(numerator, denominator):  # half away from zero
        q, rest = divmod(abs(numerator), denominator)
        return (q + (2 * rest >= denominator)) * (1 if numerator >= 0 else -1)

    cents = lambda v: int(v.scaleb(2).to_integral_value())
    unit = 10**20
    for i, principal, apr, bucket in given:
        amount, rate, funding = cents(principal), int(apr.scaleb(20)), int(params.funding_rate.scaleb(20))
        loss = int((D(str(params.pd_by_bucket[bucket])) * params.lgd).scaleb(20))
        nii = whole(amount * (rate - funding), 12 * unit)
        expected = (
            whole(amount * rate, 12 * unit), whole(amount * funding, 12 * unit), nii,
            whole(amount * loss, unit), whole(nii * unit - amount * loss, unit),
        )
        assert tuple(cents(found[i][c]) for c in commercial.MEASURE_COLUMNS) == expected, given[i]


def test_usual_rates_need_no_wide_decimals(spark):
    months = spark.range(1).selectExpr(
        "CAST(id AS DECIMAL(14,2)) AS principal_nzd", "CAST(id AS DECIMAL(6,4)) AS interest_rate_apr", "'DPD_0' AS dpd_bucket"
    )
    plan = commercial.with_commercial(months)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38" not in plan


def test_commercial_columns_against_decimal_arithmetic(make_tables):
    t, loans, _ = random_tables(make_tables, 3)
    cent = lambda v: v.quantize(D("0.01"), ROUND_HALF_UP)
    terms = {row[0]: (row[4], row[5]) for row in loans}
    buckets = {(r.loan_id, r.month_end): r.dpd_bucket for r in delinquency.portfolio_snapshot(t).collect()}
    found = commercial.rar_monthly(t).collect()
    nii = {(r.loan_id, r.month_end): r for r in commercial.nii_monthly(t).collect()}
    assert len(found) == len(buckets) > 50
    for r in found:
        principal, apr = terms[r.loan_id]
        income, cost = principal * apr / 12, principal * DEFAULTS.funding_rate / 12
        loss = principal * DEFAULTS.pd_by_bucket[buckets[r.loan_id, r.month_end]] * DEFAULTS.lgd
        other = nii[r.loan_id, r.month_end]
        assert r.eop_balance == principal
        assert other.interest_income_est == cent(income) and other.funding_cost_est == cent(cost)
        assert r.nii_est == other.nii_est == cent(principal * (apr - DEFAULTS.funding_rate) / 12)
        assert r.expected_loss_est == cent(loss)
        assert r.rar_profit_est == cent(r.nii_est - loss)


def test_half_cent_ties(make_tables):
    # 100.20 * 0.0600 / 12 = 0.501; 1.00 * 0.06 / 12 = 0.005, a tie that goes up
    t = make_tables([loan(1, principal="1.00", apr="0.0600")], [due(1, "2024-02-10", "1")])
    (row,) = commercial.interest_income_monthly(t).collect()
    assert row.interest_income_est == D("0.01")


def test_unknown_bucket_takes_the_worst_probability(spark):
    df = spark.createDataFrame([(None,), ("DPD_0",), ("other",)], "b string")
    assert [r[0] for r in df.select(by_bucket(F.col("b"), DEFAULTS.pd_by_bucket)).collect()] == [
        D("0.55"),
        D("0.01"),
        D("0.55"),
    ]


def test_parameters_change_the_result(make_tables):
    t = make_tables([loan(1, principal="1200", apr="0.10")], [due(1, "2024-02-10", "200")])
    params = Params(funding_rate=D("0.04"), lgd=D("0.5"))
    (row,) = commercial.rar_monthly(t, params).collect()
    assert (row.nii_est, row.expected_loss_est) == (D("6.00"), D("60.00"))
    (row,) = commercial.rar_monthly(t, params, balance="eop").collect()
    assert (row.eop_balance, row.nii_est, row.expected_loss_est) == (D("1000.00"), D("5.00"), D("50.00"))
    with pytest.raises(ValueError):
        commercial.rar_monthly(t, balance="other")


def test_rates_of_any_length_are_exact(make_tables):
    from decimal import ROUND_HALF_UP

    t = make_tables([loan(1, principal="999999999999.99", apr="0.1003")], [due(1, "2024-02-10", "200")])
    cents = lambda v: v.quantize(D("0.01"), ROUND_HALF_UP)
    for rate in (D("0.05525"), D("0.0555555555"), 0.055, D("0")):
        exact, lgd = D(str(rate)), D("0.123456789")
        (row,) = commercial.rar_monthly(t, Params(funding_rate=rate, lgd=lgd)).collect()
        nii = cents(D("999999999999.99") * (D("0.1003") - exact) / 12)
        loss = D("999999999999.99") * D("0.1") * lgd
        assert (row.nii_est, row.expected_loss_est) == (nii, cents(loss))
        assert row.rar_profit_est == cents(nii - loss)


def test_segments_add_up(make_tables):
    t, _, _ = random_tables(make_tables, 4)
    found = commercial.segment_profitability(t).collect()
    cells = [r for r in found if r.product_type and r.channel]
    products = [r for r in found if r.product_type and not r.channel]
    assert sum(r.nii_est for r in cells) == sum(r.nii_est for r in products)
    for r in cells:
        assert r.nii_margin == pytest.approx(float(r.nii_est) / float(r.eop_balance))
    (price,) = commercial.pricing_effectiveness(t, by=("product_type",)).collect()
    assert 0 <= price.rate_60p <= 1 and price.rar_margin == pytest.approx(products[0].rar_margin)


def test_measures_of_an_empty_slice_are_blank(make_tables, spark):
    t = make_tables([loan(1, principal="50")], [due(1, "2024-02-10", "50"), due(1, "2024-03-10", "50")])
    scores = spark.createDataFrame([(1, day("2024-03-31"), 0.25)], "loan_id long, month_end date, risk_score double")
    found = {r.month_end: r for r in measures.portfolio_measures(t, ("month_end",), scores).collect()}
    paid_off = found[day("2024-03-31")]
    assert paid_off.eop_balance_total == 0 and paid_off.nii_margin is None and paid_off.eop_60p_rate is None
    assert paid_off.avg_risk_score == 0.25 and paid_off.top_risk_balance == 0
    assert found[day("2024-02-29")].avg_risk_score is None
    (total,) = measures.portfolio_measures(t, (), scores).collect()
    assert (total.loans, total.loans_60p, total.rate_60p) == (2, 1, 0.5)


def test_measures_keep_a_slice_without_a_key(make_tables, spark):
    t = make_tables([loan(1, product=None), loan(2)], [due(1, "2024-02-10", "5", "0"), due(2, "2024-02-10", "5", "0")])
    scores = spark.createDataFrame(
        [(i, day("2024-02-29"), 0.5) for i in (1, 2)], "loan_id long, month_end date, risk_score double"
    )
    found = measures.portfolio_measures(t, ("product_type",), scores)
    assert rows(found, "product_type", "top_risk_balance") == [(None, D("1000.00")), ("Personal", D("1000.00"))]


def random_months(spark, seed, n=400):
    """Scored loan-months with the commercial columns, keys and scores missing now and then."""
    from decimal import Decimal

    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    amount = lambda: Decimal(rng.randint(-500, 5000)) / 100
    found = [
        (
            pick(day("2024-01-31"), day("2024-02-29")), pick("Auto", "SME", None), pick("Online", "Broker"),
            pick("Otago", "Waikato", None), pick("DPD_0", "DPD_30_59", "DPD_60_89", "DPD_90_PLUS"), pick(amount(), None),
            *[amount() for _ in range(5)], pick(round(rng.random(), 1), round(rng.random(), 3), None),
        )
        for _ in range(n)
    ]
    money = ", ".join(f"{c} decimal(18,2)" for c in ("eop_balance", *commercial.MEASURE_COLUMNS))
    return spark.createDataFrame(
        found,
        f"month_end date, product_type string, channel string, region string, dpd_bucket string, {money}, risk_score double",
    )


@pytest.mark.parametrize("top", [3, 100])
def test_a_cube_answers_every_slice_as_the_loan_months_do(spark, top):
    params = Params(top_risk_loans=top)
    months = random_months(spark, top).coalesce(1)
    with Scratch(spark) as scratch:
        cube = scratch.store(measures.measure_cube(months, params=params))
        # highest scores alone are kept, a few for each cell
        assert cube.where("risk_score IS NOT NULL").count() <= 24 * 2 * top
        for by in ((), ("month_end",), ("product_type", "region"), ("region", "channel", "month_end"), measures.CELL):
            expected = measures.measures_of(months, by, True, params)
            found = measures.cube_measures(cube, by, params)
            assert rows(found, *sorted(expected.columns)) == rows(expected, *sorted(expected.columns)), by


def test_the_average_score_of_a_cube_keeps_every_decimal(spark):
    months = random_months(spark, 2, 3).withColumn("risk_score", F.lit(0.123456789012))
    for found in (measures.cube_measures(measures.measure_cube(months), ()), measures.measures_of(months, (), True)):
        assert found.first().avg_risk_score == pytest.approx(0.123456789012, rel=1e-14)


def test_commercial_sums_are_not_kept_per_score(spark):
    plan = measures.measure_cube(random_months(spark, 2, 3))._jdf.queryExecution().optimizedPlan().toString()
    per_score = [line for line in plan.splitlines() if "Aggregate [" in line and "risk_score" in line.split("]")[0]]
    assert per_score and not any("nii_est" in line for line in per_score)


def test_a_cube_ranks_only_scores_that_can_be_among_the_highest(spark, monkeypatch):
    months = random_months(spark, 5).limit(1).crossJoin(spark.range(3000))
    months = months.withColumn("risk_score", F.col("id") / 3000).drop("id")
    ranked = []
    whole = measures.highest_scores
    monkeypatch.setattr(measures, "highest_scores", lambda df, *rest: ranked.append(df.count()) or whole(df, *rest))
    cube = measures.measure_cube(months, params=Params(top_risk_loans=5))
    found = [r.risk_score for r in cube.where("risk_score IS NOT NULL").collect()]
    assert sorted(found) == [i / 3000 for i in range(2995, 3000)]
    assert 5 <= ranked[0] < 200


def test_a_cube_of_whole_cents_equals_one_of_decimals(spark):
    rng = random.Random(8)
    scores = [None, float("nan"), -3.5, 0.0, 1.0, 1.0, 7.25, *(rng.random() for _ in range(60))]
    given = []
    for _ in range(3000):
        cell = (rng.choice((day("2024-01-31"), None)), rng.choice(("Auto", None)), "Online", rng.choice(("Otago", None)))
        amounts = [rng.choice((None, rng.randint(-(10**15), 10**15), rng.randint(-(10**4), 10**4))) for _ in range(6)]
        given.append((*cell, rng.choice(("DPD_0", "DPD_60_89", None)), rng.choice(scores), *amounts))
    # the sum of these leaves a long
    top = [(day("2024-02-29"), "Auto", "Online", "Otago", "DPD_0", 0.5, *[9 * 10**17] * 6) for _ in range(40)]
    names = ("eop_balance", *commercial.MEASURE_COLUMNS)
    schema = "month_end date, product_type string, channel string, region string, dpd_bucket string, risk_score double, "
    whole = spark.createDataFrame(given + top, schema + ", ".join(f"{c} long" for c in names))
    decimals = whole.withColumns({c: (F.col(c) * F.lit(D("0.01"))).cast("decimal(18,2)") for c in names})
    params = Params(top_risk_loans=7)
    cubes = [measures.measure_cube(m, params=params) for m in (whole, decimals)]
    assert cubes[0].schema == cubes[1].schema
    assert str(rows(cubes[0])) == str(rows(cubes[1]))
    (total,) = measures.cube_measures(cubes[0], ("month_end",), params).where("month_end = '2024-02-29'").collect()
    assert total.nii_est == 40 * 9 * D(10) ** 15
    for by in ((), ("product_type",), ("month_end", "region")):
        expected = measures.measures_of(decimals, by, True, params)
        found = measures.cube_measures(cubes[0], by, params)
        columns = sorted(expected.columns)
        assert str(rows(found, *columns)) == str(rows(expected, *columns)), by


def test_a_cube_of_no_rows(spark):
    empty = measures.measure_cube(random_months(spark, 1, 5).limit(0))
    assert measures.cube_measures(empty, ("region",)).count() == 0
    assert measures.cube_measures(empty, ()).first().loans == 0


def test_balances_at_months_equal_the_expanded_ones(spark, make_tables):
    rng = random.Random(4)
    loans, schedule = [], []
    for i in range(1, 25):
        loans.append(loan(i, opened=f"202{rng.randint(1, 3)}-0{rng.randint(1, 9)}-15"))
        for _ in range(rng.randint(0, 6)):
            schedule.append(due(i, f"202{rng.randint(1, 5)}-{rng.randint(1, 12):02d}-10", "90", f"{rng.randint(0, 400)}.00"))
    t = make_tables(loans, schedule)
    spans = balance.balance_intervals(t)
    in_use = sorted({r.month_end for r in balance.balance_eop(t).select("month_end").distinct().collect()})
    for asked in (in_use, in_use[::5], in_use[:1], []):
        months = spark.createDataFrame([(m,) for m in asked] * 2 + [(None,)], "month_end date")
        found = balance.balance_at(spans, months)
        assert rows(found) == rows(balance.balance_eop(t).where(F.col("month_end").isin(asked)))
    # a month without installments, after all of them and before any
    late, early = (spark.createDataFrame([(day(d),)], "month_end date") for d in ("2035-05-07", "2001-05-07"))
    assert balance.balance_at(spans, late).count() == 24 and balance.balance_at(spans, early).count() == 0
    plan = balance.balance_at(spans, late)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
