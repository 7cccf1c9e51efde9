"""The physical plans that large tables depend on."""

import re
from decimal import Decimal as D

import pytest
from conftest import day, due, loan, paid
from pyspark.sql import functions as F

import __spark_entry__ as registry
from lendspan.operators import balance, delinquency, risk
from lendspan.operators.ledger import monthly_flows
from lendspan.plans import reports
from lendspan.sources import files


@pytest.fixture(scope="module")
def stored(spark, make_tables, tmp_path_factory):
    """Tables read from files, so that scans, pruning and pushed filters show."""
    folder = str(tmp_path_factory.mktemp("stored") / "tables")
    files.reload_portfolio(
        make_tables([loan(1)], [due(1, "2024-02-10", "5")], [paid(1, "2024-02-10", "5")]), folder
    )
    return files.read_parquet_portfolio(spark, folder)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan_of(df))


def keys(df) -> list[str]:
    return [re.sub(r"#\d+L?", "", k).rsplit(",", 1)[0] for _, k in exchanges(df)]


def sorts(df) -> list[str]:
    return [re.sub(r"#\d+L?| ASC NULLS FIRST", "", k) for k in re.findall(r"Sort \[([^]]*)\]", plan_of(df))]


def test_arrears_shuffle_twice(stored):
    # the map-side combined sum, then the loan windows
    df = delinquency.loan_dpd_bucket(stored)
    assert keys(df) == ["loan_id", "loan_id, month_end"]
    assert len(re.findall(r"\+- Window|:- Window", plan_of(df))) == 1
    assert "partial_sum" in plan_of(df)


def test_snapshot_with_balance_adds_only_the_loan_shuffle(stored):
    df = balance.portfolio_snapshot_v2(stored)
    assert sorted(keys(df)) == ["loan_id", "loan_id", "loan_id, month_end"]
    # the ledger side is sorted once, for the windows and for the join
    assert sorted(sorts(df)) == ["loan_id", "loan_id, month_end"]


def test_plain_snapshot_has_no_balance_window(stored):
    plan = plan_of(delinquency.portfolio_snapshot(stored))
    assert len(re.findall(r"- Window", plan)) == 1 and "scheduled_principal" not in plan


def test_features_join_customers_at_loan_grain(stored):
    df = risk.features_3m(stored)
    assert sorted(keys(df)) == ["customer_id", "customer_id", "loan_id", "loan_id", "loan_id, month_end"]
    assert sorted(sorts(df)) == ["customer_id", "customer_id", "loan_id", "loan_id, month_end"]


def test_balance_months_are_expanded_after_the_last_shuffle(stored):
    df = balance.balance_eop(stored)
    main = plan_of(df)
    assert main.index("Generate explode") < main.index("Exchange hashpartitioning")
    assert "Join" not in main.split("Union")[0]


def test_scans_read_only_the_columns_in_use(stored):
    plan = plan_of(reports.monthly_rates(stored))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(scans) == [
        "loan_id:bigint",
        "loan_id:bigint,due_date:date,scheduled_amount:decimal(14,2)",
        "loan_id:bigint,payment_date:date,paid_amount:decimal(14,2)",
    ]


def test_filters_reach_the_scan(stored):
    plan = plan_of(monthly_flows(stored).where(F.col("loan_id") == 7))
    assert plan.count("EqualTo(loan_id,7)") == 2


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES_WITH_LAZY_PLANS)))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(registry.queries()[name](spark, "/root/testdata/sf0.001"))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in plan, node


def test_hot_loan_is_combined_before_the_shuffle(spark, make_tables):
    """A loan with a third of all rows leaves each input split as one row per month."""
    t = make_tables([loan(1), loan(2)])
    row = lambda hot: F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10)
    schedule = spark.range(0, 60000, 1, 4).select(
        row(True).cast("long").alias("loan_id"),
        F.lit(1).alias("installment_no"),
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 300).cast("int")).alias("due_date"),
        F.lit(D("1.00")).cast("decimal(14,2)").alias("scheduled_amount"),
        F.lit(D("1.00")).cast("decimal(14,2)").alias("scheduled_principal"),
        F.lit(D("0.00")).cast("decimal(14,2)").alias("scheduled_interest"),
    )
    from dataclasses import replace

    hot = replace(t, schedule=schedule)
    flows = monthly_flows(hot).where("loan_id = 1")
    assert flows.count() <= 10
    assert flows.agg(F.sum("installments")).first()[0] == 20000


def test_stored_layout_gives_the_same_marts_without_a_loan_shuffle(spark, tmp_path):
    from lendspan.plans.layout import bucket_by_loan
    from lendspan.sources.bridge import load_bridged

    t = load_bridged(spark, "/root/testdata/sf0.001")
    laid_out = bucket_by_loan(t, 4, str(tmp_path / "layout"), "layout_test")
    try:
        for mart in (balance.portfolio_snapshot_v2, delinquency.loan_dpd_bucket, risk.labels_60p_3m):
            plain, stored = mart(t), mart(laid_out)
            assert exchanges(stored) == [], mart.__name__
            assert stored.count() == plain.count() > 0
            assert plain.exceptAll(stored).count() == 0
        assert balance.balance_eop(t).exceptAll(balance.balance_eop(laid_out)).count() == 0
        # only the loans with their customer's columns are shuffled, not the flows
        assert keys(risk.features_3m(laid_out)).count("loan_id") == 1
    finally:
        for name in ("layout_test_monthly_flows", "layout_test_loans"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
