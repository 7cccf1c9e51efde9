from datetime import date
from decimal import Decimal as D

from conftest import day, due, loan, paid, rows

from lendspan import Params
from lendspan.operators import delinquency as dq
from lendspan.plans import reports


def buckets(t, **kwargs):
    return {(r.loan_id, r.month_end): r for r in dq.loan_dpd_bucket(t, **kwargs).collect()}


def test_calendar_defaults(spark):
    months = [r.month_end for r in dq.month_ends(spark).orderBy("month_end").collect()]
    assert len(months) == 60
    assert months[0] == date(2022, 1, 31) and months[-1] == date(2026, 12, 31)
    assert date(2024, 2, 29) in months


def test_due_and_paid_sum_per_month_and_drop_other_months(make_tables):
    t = make_tables(
        [loan(1)],
        [due(1, "2024-02-05", "60"), due(1, "2024-02-25", "40"), due(1, "2024-03-05", "100")],
        [
            paid(1, "2024-02-01", "30"),
            paid(1, "2024-02-28", "25.50"),
            paid(1, "2024-01-31", "7"),  # before the first installment month
            paid(1, "2024-05-02", "900"),  # after the last one
        ],
    )
    assert rows(dq.loan_due_paid(t)) == [
        (1, day("2024-02-29"), D("100.00"), D("55.50")),
        (1, day("2024-03-31"), D("100.00"), D("0.00")),
    ]
    assert [r[-1] for r in rows(dq.loan_arrears(t))] == [D("44.50"), D("144.50")]


def test_bucket_limits_are_exact(make_tables):
    # 33.33 has no exact binary form: a float average would misplace the limits
    months = ["2024-01-10", "2024-02-10", "2024-03-10", "2024-04-10"]
    t = make_tables([loan(1)], [due(1, m, "33.33") for m in months], [paid(1, "2024-01-10", "33.33")])
    found = buckets(t)
    assert [found[1, day(m)].dpd_bucket for m in ("2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30")] == [
        "DPD_0",
        "DPD_30_59",
        "DPD_60_89",
        "DPD_90_PLUS",
    ]
    assert [found[1, day(m)].missed_inst for m in ("2024-02-29", "2024-03-31", "2024-04-30")] == [1.0, 2.0, 3.0]


def test_average_covers_the_whole_schedule(make_tables):
    t = make_tables(
        [loan(1)], [due(1, "2024-01-10", "50"), due(1, "2024-02-10", "150")], [paid(1, "2024-02-10", "150")]
    )
    found = buckets(t)
    assert found[1, day("2024-01-31")].missed_inst == 0.5
    assert found[1, day("2024-01-31")].dpd_bucket == "DPD_1_29"


def test_zero_average_with_arrears_is_worst_bucket(make_tables):
    t = make_tables([loan(1)], [due(1, "2024-01-10", "100"), due(1, "2024-02-10", "-100")], [])
    found = buckets(t)
    first, second = found[1, day("2024-01-31")], found[1, day("2024-02-29")]
    assert first.missed_inst is None and first.dpd_bucket == "DPD_90_PLUS"
    assert second.missed_inst is None and second.dpd_bucket == "DPD_0"


def test_all_zero_installments(make_tables):
    t = make_tables([loan(1)], [due(1, "2024-01-10", "0")], [])
    found = buckets(t)[1, day("2024-01-31")]
    assert (found.arrears_amt, found.missed_inst, found.dpd_bucket) == (D("0.00"), None, "DPD_0")


def test_overpaid_loan(make_tables):
    t = make_tables([loan(1)], [due(1, "2024-01-10", "100")], [paid(1, "2024-01-11", "130")])
    found = buckets(t)[1, day("2024-01-31")]
    assert (found.arrears_amt, found.missed_inst, found.dpd_bucket) == (D("-30.00"), 0.0, "DPD_0")


def test_cents_paid_in_full_leave_no_arrears(make_tables):
    months = [f"2024-{m:02d}-10" for m in range(1, 13)]
    t = make_tables([loan(1)], [due(1, m, "0.10") for m in months], [paid(1, m, "0.10") for m in months])
    assert {r.dpd_bucket for r in buckets(t).values()} == {"DPD_0"}


def test_snapshot_needs_a_known_loan(make_tables):
    t = make_tables([loan(1)], [due(1, "2024-02-10", "10"), due(9, "2024-02-10", "10")], [])
    assert {r.loan_id for r in dq.loan_dpd_bucket(t).collect()} == {1, 9}
    assert {r.loan_id for r in dq.portfolio_snapshot(t).collect()} == {1}


def test_migration_follows_rows_over_gap_months(make_tables):
    t = make_tables(
        [loan(1)],
        [due(1, "2024-01-10", "100"), due(1, "2024-05-10", "100"), due(1, "2024-06-10", "100")],
        [paid(1, "2024-01-10", "100")],
    )
    assert rows(dq.dpd_migration(t)) == [
        (day("2024-05-31"), "DPD_0", "DPD_30_59", 1),
        (day("2024-06-30"), "DPD_30_59", "DPD_60_89", 1),
    ]


def test_vintage_counts_months_from_origination(make_tables):
    t = make_tables(
        [loan(1, opened="2023-12-20"), loan(2, opened="2023-12-02")],
        [
            due(1, "2023-11-10", "100"),  # before origination: not counted
            due(1, "2024-01-10", "100"),
            due(1, "2024-02-10", "100"),
            due(2, "2024-02-10", "100"),
        ],
        [paid(2, "2024-02-10", "100")],
    )
    assert rows(dq.vintage_60plus(t)) == [
        (day("2023-12-31"), 1, 1, 1, 1.0),
        (day("2023-12-31"), 2, 2, 1, 0.5),
    ]


def test_as_of_leaves_out_later_events_but_keeps_the_average(make_tables):
    t = make_tables(
        [loan(1)],
        [due(1, "2024-01-10", "50"), due(1, "2024-01-20", "100"), due(1, "2024-02-10", "150")],
        [paid(1, "2024-01-15", "20"), paid(1, "2024-01-25", "30")],
    )
    (row,) = dq.loan_dpd_bucket(t, as_of=date(2024, 1, 15)).collect()
    assert (row.month_end, row.arrears_amt) == (day("2024-01-31"), D("30.00"))
    assert row.missed_inst == 0.3  # 30 over an average of 100


def migration_frame(spark, *found):
    return spark.createDataFrame(found, "month_end date, from_bucket string, to_bucket string, loan_count long")


def test_migration_and_roll_rates(spark):
    m = day("2024-01-31")
    frame = migration_frame(spark, (m, "DPD_0", "DPD_0", 6), (m, "DPD_0", "DPD_1_29", 3), (m, "DPD_0", "DPD_60_89", 1))
    rates = {r.to_bucket: r.migration_rate for r in dq.migration_rates(frame).collect()}
    assert rates == {"DPD_0": 0.6, "DPD_1_29": 0.3, "DPD_60_89": 0.1}
    assert rows(dq.roll_rates(frame), "to_bucket", "roll_rate") == [("DPD_1_29", 0.3)]


def test_transition_matrix(spark):
    from lendspan.params import BUCKETS

    m = day("2024-01-31")
    frame = migration_frame(spark, *[(m, a, b, 1) for a in BUCKETS for b in BUCKETS])
    classes = {
        (r.from_bucket, r.to_bucket): r.c
        for r in frame.select("from_bucket", "to_bucket", dq.transition_class(frame.from_bucket, frame.to_bucket).alias("c")).collect()
    }
    for i, start in enumerate(BUCKETS):
        for j, end in enumerate(BUCKETS):
            expected = "Stay" if i == j else "Cure" if j < i else "Worsen" if i == 0 else "Roll"
            assert classes[start, end] == expected
    assert rows(dq.transition_classes(frame), "transition_class", "loan_count") == [
        ("Cure", 10),
        ("Roll", 6),
        ("Stay", 5),
        ("Worsen", 4),
    ]


def latest_tables(make_tables):
    schedule, payments = [], []
    for loan_id in range(1, 7):
        for month in ("2024-01-10", "2024-02-10", "2024-03-10"):
            schedule.append(due(loan_id, month, "100"))
            if loan_id > 2:
                payments.append(paid(loan_id, month, "100"))
    loans = [loan(i, customer_id=i % 2, channel="Online" if i < 5 else "Broker") for i in range(1, 7)]
    return make_tables(loans, schedule, payments)


def test_latest_month_reports(make_tables):
    t = latest_tables(make_tables)
    assert rows(reports.worst_segments(t, Params(min_segment_loans=3))) == [
        (day("2024-03-31"), "Online", "Personal", 4, 0.5)
    ]
    assert rows(reports.worst_segments(t)) == []  # default needs 200 loans
    assert rows(reports.latest_month_split(t)) == [(day("2024-03-31"), 4, 2)]
    assert rows(reports.top_channels(t)) == [("Broker", 2, 0.0), ("Online", 4, 50.0)]
    (kpi,) = reports.latest_month_kpis(t).collect()
    assert (kpi.total_rows, kpi.loans, kpi.rate_90p) == (6, 6, 33.33)
    assert rows(reports.portfolio_overview(t)) == [(6, 2, day("2024-01-31"), day("2024-03-31"))]


def test_pivots_sum_to_the_long_form(make_tables):
    t = latest_tables(make_tables)
    long = sum(r.loan_count for r in reports.dpd_by_product(t).collect())
    (wide,) = reports.dpd_by_product_pivot(t).collect()
    assert long == sum(v for k, v in wide.asDict().items() if k != "product_type") == 18
    by_loans = sum(r.loan_count for r in reports.migration_total(t, "loans").collect())
    assert by_loans == 12
    # the default counts months in which a pair occurred
    assert {(r.from_bucket, r.to_bucket): r.loan_count for r in reports.migration_total(t).collect()} == {
        ("DPD_0", "DPD_0"): 2,
        ("DPD_30_59", "DPD_60_89"): 1,
        ("DPD_60_89", "DPD_90_PLUS"): 1,
    }
