import calendar
import math
from datetime import date
from decimal import Decimal as D

import pytest
from conftest import customer, day, loan
from pyspark.sql import functions as F

from lendspan.operators import amortise as am
from lendspan.operators import propensity as pp


def plan_by_loop(principal, apr, term):
    """Installments one after the other: (amount, principal part, interest)."""
    rate = apr / 12
    pay = principal / term if rate <= 0 else principal * rate * (1 + rate) ** term / ((1 + rate) ** term - 1)
    balance, found = principal, []
    for _ in range(term):
        interest = balance * rate
        part = max(0.0, min(pay - interest, balance))
        balance = max(0.0, balance - part)
        found.append((pay, part, interest))
        if balance <= 0.01:
            break
    return found


@pytest.mark.parametrize("capped", [True, False])
def test_schedule_matches_the_month_by_month_loop(make_tables, capped):
    cases = [("94459", "0.1770", 12), ("434535", "0.1359", 60), ("2000.55", "0.0300", 24), ("301927", "0.0529", 300), ("1200", "0.0000", 12)]
    t = make_tables([loan(i, principal=p, apr=a, term=n) for i, (p, a, n) in enumerate(cases)])
    found = am.amortise(t.loans, capped).orderBy("loan_id", "installment_no").collect()
    expected = [
        (i, k + 1, *parts) for i, (p, a, n) in enumerate(cases) for k, parts in enumerate(plan_by_loop(float(p), float(a), n))
    ]
    assert len(found) == len(expected) == sum(n for _, _, n in cases)
    for row, (loan_id, number, *amounts) in zip(found, expected):
        assert (row.loan_id, row.installment_no) == (loan_id, number)
        for value, exact in zip((row.scheduled_amount, row.scheduled_principal, row.scheduled_interest), amounts):
            assert abs(float(value) - exact) <= 0.005 + 1e-6
    for i, (principal, _, n) in enumerate(cases):
        repaid = sum(r.scheduled_principal for r in found if r.loan_id == i)
        assert abs(repaid - D(principal)) <= D("0.005") * n


def test_due_dates_stay_in_short_months(make_tables):
    t = make_tables([loan(1, opened="2024-01-31", term=3), loan(2, opened="2024-02-29", term=12)])
    dates = {(r.loan_id, r.installment_no): r.due_date for r in am.amortise(t.loans).collect()}
    assert [dates[1, n] for n in (1, 2, 3)] == [day("2024-02-29"), day("2024-03-31"), day("2024-04-30")]
    assert dates[2, 1] == day("2024-03-29") and dates[2, 12] == day("2025-02-28")
    for number in range(1, 13):
        month = (1 + number) % 12 + 1
        year = 2024 + (1 + number) // 12
        assert dates[2, number] == date(year, month, min(29, calendar.monthrange(year, month)[1]))


def test_tiny_loan_ends_early_only_when_capped(make_tables):
    t = make_tables([loan(1, principal="0.02", apr="0.0000", term=4)])
    assert am.amortise(t.loans).count() == 2  # half a cent a month: a cent is left after two
    assert am.amortise(t.loans, capped=False).count() == 4


def test_no_installments_without_a_term(make_tables):
    assert am.amortise(make_tables([loan(1, term=0)]).loans).count() == 0


def test_half_cents_go_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (2.6749,)], "v double")
    assert [r[0] for r in df.select(am._to_cents(F.col("v"))).collect()] == [D("1.01"), D("2.68"), D("2.67")]


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def test_propensities(make_tables):
    t = make_tables(
        [loan(1, 1, "SME", apr="0.2000", channel="Partner"), loan(2, 2, "Mortgage", apr="0.0500", channel="Branch"), loan(3, 3)],
        customers=[
            customer(1, "30000", "Student", score=500),
            customer(2, "240000", "Salaried", score=840),
            customer(3, None, "Salaried"),
        ],
    )
    one = ((650 - 500) / 90 + (65000 - 30000) / 90000 + (0.2 - 0.12) / 0.08 + 0.6) * 1.35 * 1.25
    two = ((650 - 840) / 90 + (65000 - 240000) / 90000 + (0.05 - 0.12) / 0.08) * 0.55 * 0.90
    found = {r.loan_id: r for r in pp.risk_propensity(t).collect()}
    assert found[1].p_late == pytest.approx(0.35 * sigmoid(one)) and found[1].p_miss == pytest.approx(0.12 * sigmoid(one))
    assert found[2].p_late == pytest.approx(max(0.02, 0.35 * sigmoid(two)))
    assert found[3].p_late is None and found[3].p_miss is None
    index = 350 / 400 + 220000 / 250000 + 0.15 * 5 + 0.5 + 0.35 + 0.25
    assert {r.loan_id: r.pay_probability for r in pp.pay_probability(t).collect()}[1] == pytest.approx(sigmoid(2 - index))
