from dataclasses import replace

import pytest
from conftest import customer, day, due, loan, paid, rows
from pyspark.sql import functions as F

from lendspan.operators.audit import integrity_audit
from lendspan.plans import audit_upkeep
from lendspan.sources import files


def whole(parts):
    names = parts[0].by_name()
    fields = {"dim_customers": "customers", "fct_loans": "loans", "fct_schedule": "schedule", "fct_payments": "payments",
              "fct_collections": "collections", "dim_products": "products", "dim_channels": "channels"}
    merged = {}
    for name, field in fields.items():
        merged[field] = names[name]
        for part in parts[1:]:
            merged[field] = merged[field].unionByName(part.by_name()[name])
    return replace(parts[0], **merged)


@pytest.fixture
def parts(make_tables):
    none = lambda t: replace(t, products=t.products.limit(0), channels=t.channels.limit(0))
    first = make_tables(
        [loan(1), loan(2, customer_id=7)],
        [due(1, "2024-02-10", "5"), due(3, "2024-02-10", "5"), due(3, "2024-03-10", "5")],
        [paid(9, "2024-02-10", "5"), (None, day("2024-02-10"), None)],
        [customer(1), customer(1)],
    )
    # the loan and the customer that were missing, a second row of a loan, more orphans
    second = none(make_tables([loan(3), loan(1)], [due(4, "2024-02-10", "5")], [paid(9, "2024-03-10", "5")], [customer(7)]))
    third = none(make_tables([], [], [], []))
    return [first, second, third]


def test_the_audit_follows_batches(spark, parts, tmp_path):
    folder = str(tmp_path / "audit")
    assert rows(audit_upkeep.maintained_audit(spark, folder), "violations")[-1] == (0,)
    for n, part in enumerate(parts):
        assert audit_upkeep.apply_audit_batch(spark, folder, part, f"b{n}", buckets=3)
        found = audit_upkeep.maintained_audit(spark, folder)
        expected = integrity_audit(whole(parts[: n + 1]))
        assert rows(found) == rows(expected)
        assert found.where("violations > 0").count() > 3
    assert not audit_upkeep.apply_audit_batch(spark, folder, parts[1], "b1")
    assert rows(audit_upkeep.maintained_audit(spark, folder)) == rows(integrity_audit(whole(parts)))


def test_a_batch_reads_its_own_rows_and_its_buckets(spark, parts, tmp_path, monkeypatch):
    portfolio, folder = str(tmp_path / "portfolio"), str(tmp_path / "audit")
    files.reload_portfolio(replace(parts[0], payments=parts[0].payments.where("loan_id IS NOT NULL")), portfolio)
    audit_upkeep.maintain_audit(spark, portfolio, folder, buckets=3)
    files.append_portfolio(parts[1], portfolio, "next")
    opened, read = [], []
    counts, stored = audit_upkeep.key_counts, audit_upkeep._stored

    def watched_counts(frames, family):
        for frame in frames.values():
            opened.extend(frame.inputFiles())
        return counts(frames, family)

    def watched_stored(spark, folder, family, parts):
        read.append((family.parent, len(parts)))
        return stored(spark, folder, family, parts)

    monkeypatch.setattr(audit_upkeep, "key_counts", watched_counts)
    monkeypatch.setattr(audit_upkeep, "_stored", watched_stored)
    assert audit_upkeep.maintain_audit(spark, portfolio, folder) == ["next"]
    assert opened and all("/batch-" in f for f in opened)
    assert max(n for parent, n in read if parent == "dim_customers") <= 2
    stored_rows = files.read_parquet_portfolio(spark, portfolio)
    assert rows(audit_upkeep.maintained_audit(spark, folder)) == rows(integrity_audit(stored_rows))


def test_stored_counts_are_added_without_the_base_tables(spark, parts, tmp_path):
    folder = str(tmp_path / "audit")
    audit_upkeep.apply_audit_batch(spark, folder, parts[0], "a", buckets=2)
    family = audit_upkeep.families()[0]
    content = audit_upkeep.Versions(spark, folder).latest()[1]["families"][family.parent]
    frame = audit_upkeep._stored(spark, folder, family, content["runs"])
    plan = frame.agg(F.sum(f"rows_{family.parent}"))._jdf.queryExecution().executedPlan().toString()
    assert "fct_schedule" not in plan and frame.count() >= 2
