from dataclasses import replace
from decimal import Decimal as D

import pytest
from conftest import day, due, loan, paid, rows
from pyspark.sql import functions as F

from lendspan import schemas
from lendspan.operators import balance, delinquency
from lendspan.operators.audit import integrity_audit
from lendspan.plans import registry, reports
from lendspan.sources import dims, files, jdbc


@pytest.fixture
def small(make_tables):
    return make_tables(
        [loan(1), loan(2, product="Auto", channel="Broker")],
        [due(1, "2024-02-10", "100", "90"), due(2, "2024-02-10", "50", "40"), due(1, "2024-03-10", "100", "90")],
        [paid(1, "2024-02-10", "100.25")],
        collections=[(2, day("2024-02-20"), "Call", None)],
    )


def test_csv_round_trip(spark, small, tmp_path):
    for name, df in small.by_name().items():
        files.write_csv(df, str(tmp_path / name))
    back = files.read_portfolio(spark, str(tmp_path), suffix="", macro=True)
    for name, df in small.by_name().items():
        assert rows(back.by_name()[name]) == rows(df), name
    assert dict(back.loans.dtypes)["principal_nzd"] == "decimal(14,2)"
    assert dict(back.products.dtypes)["secured_flag"] == "boolean"


def test_csv_with_wrong_cells_or_columns_fails(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("loan_id,payment_date,paid_amount\n1,2024-01-01,abc\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(bad), schemas.PAYMENTS).collect()
    swapped = tmp_path / "swapped.csv"
    swapped.write_text("payment_date,loan_id,paid_amount\n2024-01-01,1,5\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(swapped), schemas.PAYMENTS).collect()


def test_reload_replaces_and_append_adds(spark, small, tmp_path):
    folder = str(tmp_path / "tables")
    files.reload_portfolio(small, folder)
    files.reload_portfolio(small, folder)
    assert files.read_parquet_portfolio(spark, folder).schedule.count() == 3
    files.append_portfolio(small, folder)
    assert files.read_parquet_portfolio(spark, folder).schedule.count() == 6


def counts(spark, folder):
    return {n: f.count() for n, f in files.read_parquet_portfolio(spark, folder).by_name().items()}


def test_an_append_counts_once_and_in_all_tables(spark, small, tmp_path):
    folder = str(tmp_path / "tables")
    files.reload_portfolio(small, folder)
    once = counts(spark, folder)
    broken = replace(small, payments=small.payments.withColumn("loan_id", F.raise_error("broken input").cast("long")))
    with pytest.raises(Exception, match="broken input"):
        files.append_portfolio(broken, folder, "day 1")
    assert counts(spark, folder) == once
    assert not [p for p in (tmp_path / "tables").glob("*/batch-*")]
    assert files.append_portfolio(small, folder, "day 1")
    twice = {n: 2 * c for n, c in once.items()}
    assert counts(spark, folder) == twice
    assert not files.append_portfolio(small, folder, "day 1")
    assert counts(spark, folder) == twice
    files.compact_portfolio(spark, folder)
    assert not files.append_portfolio(small, folder, "day 1")
    assert counts(spark, folder) == twice
    assert files.stored_batches(spark, folder).merged == ("day 1",)
    files.reload_portfolio(small, folder)
    assert files.append_portfolio(small, folder, "day 1")
    assert counts(spark, folder) == twice


def test_appends_side_by_side_lose_nothing(spark, small, tmp_path, monkeypatch):
    folder = str(tmp_path / "tables")
    files.reload_portfolio(small, folder)
    plain = files.Versions.commit
    raced = []

    def late(self, number, content):
        # another writer is faster, once
        if not raced:
            raced.append(1)
            assert files.append_portfolio(small, folder, "other")
        plain(self, number, content)

    monkeypatch.setattr(files.Versions, "commit", late)
    assert files.append_portfolio(small, folder, "one")
    assert list(files.stored_batches(spark, folder).later) == ["other", "one"]
    assert files.read_parquet_portfolio(spark, folder).schedule.count() == 9
    # the same batch sent by both counts once
    raced.clear()
    monkeypatch.setattr(files.Versions, "commit", lambda self, number, content: late(self, number, content))
    assert not files.append_portfolio(small, folder, "other")


def test_plain_folders_take_batches(spark, small, tmp_path):
    folder = str(tmp_path / "plain")
    for name, frame in small.by_name().items():
        frame.write.parquet(f"{folder}/{name}")
    assert files.append_portfolio(small, folder, "one")
    assert files.read_parquet_portfolio(spark, folder).schedule.count() == 6
    with pytest.raises(FileNotFoundError):
        files.read_parquet_portfolio(spark, str(tmp_path / "nothing"))


def test_a_folder_can_be_reloaded_from_itself(spark, small, tmp_path):
    folder = str(tmp_path / "tables")
    files.reload_portfolio(small, folder)
    for _ in range(3):
        files.reload_portfolio(files.read_parquet_portfolio(spark, folder), folder)
    stored = files.read_parquet_portfolio(spark, folder)
    assert {n: f.count() for n, f in stored.by_name().items()} == {n: f.count() for n, f in small.by_name().items()}


def test_a_failed_reload_leaves_the_stored_tables(spark, small, tmp_path):
    from dataclasses import replace

    folder = str(tmp_path / "tables")
    files.reload_portfolio(small, folder)
    broken = small.payments.withColumn("loan_id", F.raise_error("broken input").cast("long"))
    with pytest.raises(Exception, match="broken input"):
        files.reload_portfolio(replace(small, payments=broken), folder)
    stored = files.read_parquet_portfolio(spark, folder)
    assert {n: f.count() for n, f in stored.by_name().items()} == {n: f.count() for n, f in small.by_name().items()}
    assert len([p for p in (tmp_path / "tables").iterdir() if p.name.startswith("generation-")]) == 1


def test_macro_rows_are_stored(spark, small, tmp_path):
    from dataclasses import replace
    from decimal import Decimal

    folder = str(tmp_path / "tables")
    month = [(day("2024-01-31"), Decimal("0.0400"), Decimal("101.0000"), Decimal("0.0550"))]
    files.reload_portfolio(replace(small, macro=spark.createDataFrame(month, schemas.MACRO_MONTHLY)), folder)
    assert files.read_parquet_portfolio(spark, folder).macro.count() == 1


def test_scores_are_replaced(spark, tmp_path):
    frame = spark.createDataFrame([(1, day("2024-01-31"), 0.5, 0)], schemas.RISK_SCORES)
    target = str(tmp_path / "scores")
    files.save_scores(frame, target)
    files.save_scores(frame.withColumn("risk_score", F.lit(0.9)), target)
    assert rows(files.read_scores(spark, target), "risk_score") == [(0.9,)]
    # scores may be made from the scores they replace
    files.save_scores(files.read_scores(spark, target).withColumn("risk_score", F.col("risk_score") / 3), target)
    assert rows(files.read_scores(spark, target), "risk_score") == [(0.9 / 3,)]


def test_scores_as_a_catalog_table(spark):
    frame = spark.createDataFrame([(1, day("2024-01-31"), 0.5, 0)], schemas.RISK_SCORES)
    files.save_scores(frame, "saved_scores", as_table=True)
    try:
        assert spark.table("saved_scores").count() == 1
    finally:
        spark.sql("DROP TABLE saved_scores")


def test_inline_dimensions(spark):
    assert rows(dims.products(spark)) == [
        ("Auto", True, "Medium"),
        ("Mortgage", True, "Low"),
        ("Personal", False, "High"),
        ("SME", False, "High"),
    ]
    assert rows(dims.channels(spark), "channel_group", "channel")[0] == ("Direct", "Branch")
    assert dims.macro_monthly(spark).count() == 0


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:postgresql://db/loans", "fct_schedule", "loan_id", 1, 900, 16)
    assert options["driver"] == "org.postgresql.Driver"
    assert (options["partitionColumn"], options["numPartitions"]) == ("loan_id", "16")
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:sqlite:loans.db", "t")
    for scheme in ("mysql://h/d", "sqlserver://h"):
        assert jdbc.jdbc_options("jdbc:" + scheme, "t")["driver"]
    for url in ("postgresql://db/loans", "jdbc:oracle:thin:@db"):
        with pytest.raises(ValueError):
            jdbc.jdbc_options(url, "t")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:mysql://h/d", "t", partition_column="loan_id")


def test_marts_are_registered_by_name(spark, small):
    for name in ("mart_portfolio_snapshot", "mart_portfolio_snapshot_v2"):
        spark.catalog.dropTempView(name)  # another test may have registered marts
    with pytest.raises(LookupError):
        balance.richest_snapshot(spark)
    delinquency.portfolio_snapshot(small).createOrReplaceTempView("mart_portfolio_snapshot")
    assert "eop_balance" not in balance.richest_snapshot(spark).columns
    scores = spark.createDataFrame([(1, day("2024-02-29"), 0.5, 0)], schemas.RISK_SCORES)
    names = registry.register_marts(spark, small, scores=scores)
    assert len(names) == 17 and names[-1] == "risk_watchlist"
    try:
        assert "eop_balance" in balance.richest_snapshot(spark).columns
        assert spark.sql("SELECT loan_id, risk_score FROM risk_watchlist").collect() == [(1, 0.5)]
        found = spark.sql("SELECT count(*) AS n FROM mart_portfolio_snapshot_v2 JOIN fct_loans USING (loan_id)")
        assert found.first().n == 3
        for name in names:
            assert spark.table(name).limit(1).count() == 1, name
    finally:
        for name in [*names, *small.by_name(), "risk_scores"]:
            spark.catalog.dropTempView(name)


def test_row_counts_and_first_rows(small):
    counts = {r.table: r["rows"] for r in reports.row_counts(small).collect()}
    assert counts["fct_schedule"] == 3 and counts["dim_macro_monthly"] == 0
    first = reports.first_rows(delinquency.portfolio_snapshot(small), n=2).collect()
    assert [(r.loan_id, r.month_end) for r in first] == [(1, day("2024-02-29")), (1, day("2024-03-31"))]


def test_clean_tables_pass_the_audit(small):
    assert {r.violations for r in integrity_audit(small).collect()} == {0}


def test_audit_counts_broken_rows(make_tables):
    t = make_tables(
        [loan(1), loan(1), loan(1), loan(2, customer_id=77)],
        [due(1, "2024-02-10", "1"), due(5, "2024-02-10", "1"), due(5, "2024-03-10", "1")],
        [(None, day("2024-02-10"), D("1.00")), (1, day("2024-02-10"), None)],
    )
    found = {(r.table, r.rule): r.violations for r in integrity_audit(t).collect()}
    assert found["fct_loans", "unique loan_id"] == 2
    assert found["fct_loans", "customer_id refers to a known row"] == 1
    assert found["fct_schedule", "loan_id refers to a known row"] == 2
    assert found["fct_payments", "loan_id refers to a known row"] == 0
    assert found["fct_payments", "loan_id is required"] == 1
    assert found["fct_payments", "paid_amount is required"] == 1
    assert sum(found.values()) == 7
