import random

import pytest

import corpus_pipeline as pipeline
from lendspan.llm import decontaminate, pii, simhash, toxicity
from lendspan.session import Scratch

PLAIN = [f"word{a}{b}" for a in "abcdefgh" for b in "klmnop"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with planted toxic texts, copies, benchmark passages and personal values."""
    rng = random.Random(12)
    text = lambda n: " ".join(rng.choice(PLAIN) for _ in range(n))
    items = [(k, text(14)) for k in range(3)]
    docs, labels = [], []
    for i in range(120):
        body = text(rng.randint(40, 90))
        if i % 5 == 0:
            body += " " + " ".join(f"{rng.choice(PLAIN)} {rng.choice(['grumk', 'blarg'])}" for _ in range(5))
        elif i % 11 == 0:
            body += " " + items[i % 3][1]
        elif i % 7 == 0:
            body += f" mail bob.{i}@mail.example.com or 10.1.2.{i}"
        docs.append((i, body, "en", f"s{i % 4}" if i % 9 else None, len(body)))
        labels.append((i, 1, int(i % 5 == 0)))
    docs += [(200 + k, docs[1][1], "en", "s1", docs[1][4]) for k in range(6)]
    docs += [(300, None, None, None, None), (301, "", "en", "s2", 0), (None, text(30), None, "s3", 5)]
    at = tmp_path_factory.mktemp("corpus")
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (items, "item_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(at / f"{name}.parquet"))
    return str(at)


def test_each_stage_does_its_part(spark, folder):
    before = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns = before.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        after = stage(spark, before, folder).cache()
        seen[name] = (before, after)
        if name != "mixing":
            assert after.columns == columns
            assert after.schema["doc_id"] == before.schema["doc_id"]
        before = after
    ids = lambda df: sorted(r.doc_id for r in df.where("doc_id IS NOT NULL").select("doc_id").collect())
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    start, kept = seen["toxicity"]
    toxic = {i for i in range(120) if i % 5 == 0}
    assert set(ids(start)) - set(ids(kept)) == toxic
    scored = toxicity.toxicity(start, labels).where("predicted = 0")
    assert scored.count() == kept.count()

    start, kept = seen["near_duplicates"]
    classes = simhash.near_duplicates(start).select("component_id").distinct().count()
    assert kept.count() == classes
    assert 1 in ids(kept) and not set(ids(kept)) & set(range(200, 206))
    assert start.join(kept, "doc_id", "left_semi").where("doc_id IS NOT NULL").exceptAll(kept.where("doc_id IS NOT NULL")).count() == 0

    start, kept = seen["decontamination"]
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert decontaminate.contamination(start, items).where("NOT contaminated").count() == kept.count()
    assert all(not (i % 11 == 0 and i % 5) for i in ids(kept) if i < 120)
    assert decontaminate.contamination(kept, items).where("contaminated").count() == 0

    start, replaced = seen["pii"]
    assert ids(start) == ids(replaced)
    rows = {r.doc_id: r for r in replaced.collect()}
    for row in start.collect():
        new = rows[row.doc_id]
        if row.doc_id is not None and row.doc_id % 7 == 0 and row.doc_id < 120:
            assert f"bob.{row.doc_id}@" not in new.text and f"10.1.2.{row.doc_id}" not in new.text
            assert new.n_chars == len(new.text)
        else:
            assert new == row
    assert pii.pseudonyms(start, "other").where("n_values > 0").count() > 0

    start, mixed = seen["mixing"]
    words = sum(len((r.text or "").split()) for r in start.collect())
    assert sum(r.words for r in mixed.collect()) == words
    assert set(ids(mixed)) <= set(ids(start))
    assert {r.copy for r in mixed.collect()} <= {0, 1, 2}

    assert pipeline.run(spark, folder).count() == mixed.count()


def test_near_duplicates_broadcast_no_exploded_rows(spark, folder, monkeypatch):
    plans, plain = [], Scratch.store
    monkeypatch.setattr(
        Scratch, "store", lambda self, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(self, df)
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10MB")
    try:
        pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    finally:
        spark.conf.set(key, before)
    exploding = [plan for plan in plans if "Generate explode" in plan]
    assert len(exploding) == 2 and not [plan for plan in exploding if "BroadcastExchange" in plan]


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name
