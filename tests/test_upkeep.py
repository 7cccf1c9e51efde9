import random
from dataclasses import replace
from datetime import timedelta
from functools import reduce

import pytest
from conftest import day, due, loan, paid, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspan.operators import balance, commercial, delinquency
from lendspan.plans import registry, upkeep
from lendspan.sources import files
from lendspan.sources.versions import Conflict, Versions


def whole(parts):
    """All parts as one portfolio."""
    union = lambda name: reduce(DataFrame.unionByName, [getattr(p, name) for p in parts]).coalesce(1)
    return replace(parts[0], **{name: union(name) for name in ("loans", "schedule", "payments")})


def expected(t):
    return {
        "mart_loan_due_paid": delinquency.loan_due_paid(t),
        "mart_loan_arrears": delinquency.loan_arrears(t),
        "mart_loan_dpd_bucket": delinquency.loan_dpd_bucket(t),
        "mart_portfolio_snapshot": delinquency.portfolio_snapshot(t),
        "mart_dpd_migration": delinquency.dpd_migration(t),
        "mart_vintage_60plus": delinquency.vintage_60plus(t),
        "mart_principal_paid_by_month": balance.principal_paid_by_month(t),
        "mart_portfolio_snapshot_v2": balance.portfolio_snapshot_v2(t),
        "comm_interest_income_monthly": commercial.interest_income_monthly(t),
        "comm_nii_monthly": commercial.nii_monthly(t),
        "comm_rar_monthly": commercial.rar_monthly(t),
    }


# these hold every column that the others are made of
TELLING = ("mart_loan_dpd_bucket", "mart_portfolio_snapshot_v2", "mart_dpd_migration")


def assert_up_to_date(spark, folder, parts, names=TELLING):
    stored, computed = upkeep.stored_marts(spark, folder), expected(whole(parts))
    assert set(stored) == set(computed) <= set(registry.MARTS)
    for name in names or computed:
        assert stored[name].dtypes == computed[name].dtypes, name
        assert rows(stored[name]) == rows(computed[name]), name


def random_parts(make_tables, seed, n_parts, n_loans=14):
    """Batches in which loans, installments and payments come in any order, early, late and twice a month."""
    rng = random.Random(seed)
    loans, schedule, payments = ([[] for _ in range(n_parts)] for _ in range(3))
    start = day("2024-01-10")
    some_day = lambda: str(start + timedelta(days=rng.randint(0, 420)))
    for loan_id in range(1, n_loans + 1):
        if rng.random() < 0.9:
            opened = str(start + timedelta(days=rng.randint(-60, 200)))
            loans[rng.randrange(n_parts)].append(loan(loan_id, opened=opened, principal=f"{rng.randint(1, 9)}00.00"))
        own = rng.randrange(n_parts)
        for number in range(rng.randint(0, 9)):
            at = own if rng.random() < 0.6 else rng.randrange(n_parts)
            amount = rng.choice(["0.00", "33.33", "50.00", "100.00"])
            schedule[at].append(due(loan_id, some_day(), amount, rng.choice([amount, "0.00", "20.00"]), number))
        for _ in range(rng.randint(0, 9)):
            payments[rng.randrange(n_parts)].append(paid(loan_id, some_day(), rng.choice(["33.33", "10.00", "150.00"])))
    return [make_tables(loans[n], schedule[n], payments[n]) for n in range(n_parts)]


@pytest.mark.parametrize("seed", range(3))
def test_marts_follow_random_batches(spark, make_tables, tmp_path, seed):
    parts, folder = random_parts(make_tables, seed, 3, 40), str(tmp_path / "marts")
    for n, part in enumerate(parts):
        assert upkeep.apply_batch(spark, folder, part, f"b{n}", buckets=2)
    assert not upkeep.apply_batch(spark, folder, parts[1], "b1")
    upkeep.clean_marts(spark, folder)
    assert_up_to_date(spark, folder, parts, TELLING if seed else ())


def test_a_large_batch_is_written_in_shares_of_its_loans(spark, make_tables, tmp_path, monkeypatch):
    parts, folder = random_parts(make_tables, 4, 2, 30), str(tmp_path / "marts")
    monkeypatch.setattr(upkeep, "SHARE_ROWS", 40, raising=False)
    written, plain = [], upkeep._write

    def watched(rows, folder, table, run):
        if table == "loan_months":
            written.append((run, {r.loan_id for r in rows.select("loan_id").distinct().collect()}))
        plain(rows, folder, table, run)

    monkeypatch.setattr(upkeep, "_write", watched)
    for n, part in enumerate(parts):
        upkeep.apply_batch(spark, folder, part, f"b{n}", buckets=2)
    assert len(written) > 4 and len({run for run, _ in written}) == 2
    for run in {run for run, _ in written}:
        shares = [loans for r, loans in written if r == run]
        assert sum(map(len, shares)) == len(set().union(*shares))
    assert_up_to_date(spark, folder, parts)


def test_payments_write_only_months_from_theirs_on(spark, make_tables, tmp_path):
    folder = str(tmp_path / "marts")
    months = [f"2024-{m:02d}-10" for m in range(1, 7)]
    first = make_tables([loan(1), loan(2)], [due(i, m, "100", "90") for i in (1, 2) for m in months])
    second = make_tables([], [], [paid(1, "2024-04-11", "100")])
    upkeep.apply_batch(spark, folder, first, "a", buckets=2)
    before = Versions(spark, folder).latest()[1]["parts"]["loan_months"]
    upkeep.apply_batch(spark, folder, second, "b")
    after = Versions(spark, folder).latest()[1]["parts"]["loan_months"]
    changed = {p.split("/")[0] for p in after if before[p] != after[p]}
    assert changed == {"2024-04-30", "2024-05-31", "2024-06-30"}
    assert len({p.split("/")[1] for p in after if before[p] != after[p]}) == 1
    assert_up_to_date(spark, folder, [first, second])


def test_a_batch_reads_no_earlier_schedule_or_payment_rows(spark, make_tables, tmp_path, monkeypatch):
    portfolio, folder = str(tmp_path / "portfolio"), str(tmp_path / "marts")
    parts = random_parts(make_tables, 5, 2)
    files.reload_portfolio(parts[0], portfolio)
    upkeep.maintain_marts(spark, portfolio, folder, buckets=2)
    files.append_portfolio(parts[1], portfolio, "next")
    read = []
    plain = upkeep._new_rows

    def watched(old, delta, touched, params):
        frame = plain(old, delta, touched, params)
        read.extend([*frame.inputFiles(), *touched.inputFiles(), *old.inputFiles()])
        return frame

    monkeypatch.setattr(upkeep, "_new_rows", watched)
    opened = []
    stored = upkeep.read_batch
    monkeypatch.setattr(upkeep, "read_batch", lambda s, path: opened.append(path) or stored(s, path))
    assert upkeep.maintain_marts(spark, portfolio, folder) == ["next"]
    assert len(opened) == 1 and "/batch-" in opened[0]
    assert read and not [f for f in read if "/portfolio/generation" in f]
    assert_up_to_date(spark, folder, parts)


def test_a_span_of_months_reads_its_partitions(spark, make_tables, tmp_path):
    folder = str(tmp_path / "marts")
    months = [f"2024-{m:02d}-10" for m in range(1, 7)]
    upkeep.apply_batch(spark, folder, make_tables([loan(1)], [due(1, m, "100") for m in months]), "a")
    part = upkeep.stored_loan_months(spark, folder, day("2024-02-29"), day("2024-03-31"))
    assert rows(part, "month_end") == [(day("2024-02-29"),), (day("2024-03-31"),)]
    assert all("month_end=2024-02-29" in f or "month_end=2024-03-31" in f for f in part.inputFiles())


def test_a_failed_batch_leaves_the_marts_and_can_be_repeated(spark, make_tables, tmp_path, monkeypatch):
    parts, folder = random_parts(make_tables, 7, 2), str(tmp_path / "marts")
    upkeep.apply_batch(spark, folder, parts[0], "a")

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patched:
        patched.setattr(upkeep.Versions, "commit", broken)
        with pytest.raises(OSError, match="no space"):
            upkeep.apply_batch(spark, folder, parts[1], "b")
    assert_up_to_date(spark, folder, parts[:1])
    assert upkeep.apply_batch(spark, folder, parts[1], "b")
    assert_up_to_date(spark, folder, parts)


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "folder"))
    assert versions.latest() == (0, {})
    versions.commit(1, {"by": "one"})
    with pytest.raises(Conflict):
        versions.commit(1, {"by": "other"})
    assert versions.latest() == (1, {"by": "one"})
    for number in range(2, 30):
        versions.commit(number, {"by": number})
    assert versions.latest() == (29, {"by": 29}) and len(versions._numbers()) == 20


def test_marts_follow_a_portfolio_through_reloads_and_compactions(spark, make_tables, tmp_path):
    portfolio, folder = str(tmp_path / "portfolio"), str(tmp_path / "marts")
    parts = random_parts(make_tables, 11, 4, 8)
    files.reload_portfolio(parts[0], portfolio)
    files.append_portfolio(parts[1], portfolio, "one")
    assert len(upkeep.maintain_marts(spark, portfolio, folder, buckets=2)) == 2
    assert upkeep.maintain_marts(spark, portfolio, folder) == []
    # merged batches that the marts have seen change nothing
    files.compact_portfolio(spark, portfolio)
    assert upkeep.maintain_marts(spark, portfolio, folder) == []
    assert not files.append_portfolio(parts[1], portfolio, "one")
    files.append_portfolio(parts[2], portfolio, "two")
    # one that they have not seen starts them over
    files.compact_portfolio(spark, portfolio)
    assert len(upkeep.maintain_marts(spark, portfolio, folder, buckets=2)) == 1
    assert_up_to_date(spark, folder, parts[:3])
    files.reload_portfolio(parts[3], portfolio)
    assert len(upkeep.maintain_marts(spark, portfolio, folder, buckets=2)) == 1
    assert_up_to_date(spark, folder, parts[3:])


def test_loan_rows_replace_and_odd_rows_are_left_out(spark, make_tables, tmp_path):
    folder = str(tmp_path / "marts")
    first = make_tables([loan(1, principal="500.00")], [due(1, "2024-02-10", "100", "90"), due(1, "2024-03-10", "100", "90")])
    odd = [(None, 1, day("2024-02-10"), *due(9, "2024-02-10", "5")[3:]), (1, 3, None, *due(9, "2024-02-10", "5")[3:])]
    upkeep.apply_batch(spark, folder, first, "a")
    upkeep.apply_batch(spark, folder, make_tables([loan(1, principal="900.00"), loan(1, principal="800.00")], odd), "b")
    assert_up_to_date(spark, folder, [replace(first, loans=make_tables([loan(1, principal="900.00")]).loans)])
    empty = str(tmp_path / "empty")
    upkeep.apply_batch(spark, empty, make_tables(), "none")
    assert all(f.count() == 0 for f in upkeep.stored_marts(spark, empty).values())
    upkeep.apply_batch(spark, empty, first, "a")
    assert_up_to_date(spark, empty, [first])


def test_stored_marts_are_read_by_name(spark, make_tables, tmp_path):
    folder = str(tmp_path / "marts")
    upkeep.apply_batch(spark, folder, make_tables([loan(1)], [due(1, "2024-02-10", "100")]), "a")
    names = upkeep.register_stored_marts(spark, folder)
    try:
        assert spark.sql("SELECT count(*) FROM mart_portfolio_snapshot_v2").first()[0] == 1
        plan = spark.table("mart_loan_dpd_bucket")._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def test_a_large_partition_of_a_table_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60_000, numPartitions=6).select(
        F.col("id").alias("loan_id"),
        *[F.xxhash64("id", F.lit(c)).cast("string").cast(k).alias(c) if k in ("long", "string") else F.lit(None).cast(k).alias(c)
          for c, k in upkeep._STATE.items() if c != "loan_id"],
        F.lit(0).alias("loan_bucket"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200KB")
    try:
        upkeep._write(rows, str(tmp_path), "state", "r")
    finally:
        spark.conf.set(key, before)
    assert len(list(tmp_path.glob("state/run=r/loan_bucket=0/*.parquet"))) > 2
    stored = upkeep._read(spark, str(tmp_path), "state", {"0": "r"})
    assert stored.count() == 60_000 and stored.exceptAll(rows.select(*stored.columns)).count() == 0
