"""Every pipeline stage and document operator on columns and ids that could clash with its own."""

from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lendspan.llm import align, decontaminate, parsing, pii, secret_scan, simhash, tokens

FOLDER = "/root/testdata/sf0.001"
# names that stages use inside, in any case, and plain ones
NAMES = (
    "_id", "_text", "_key", "_nth", "_source", "_number", "_found", "_FOUND2", "block", "fp", "text_key", "label",
    "win", "pos", "words2", "n", "part", "score2", "held",
)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_name(spark, documents, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    named = documents.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id")).alias(n) for n in NAMES])
    plain, clashing = function(spark, documents, FOLDER), function(spark, named, FOLDER)
    assert set(NAMES) <= set(clashing.columns)
    kept = clashing.select("doc_id", *NAMES)
    assert kept.where(F.greatest(*[F.col(n) != F.concat(F.lit(f"{n} of "), F.col("doc_id")) for n in NAMES])).count() == 0
    columns = plain.columns
    assert sorted(map(str, clashing.select(*columns).collect())) == sorted(map(str, plain.collect()))


def test_found_values_stay_inside(spark):
    docs = spark.createDataFrame([(1, "mail a.person@example.com", "mine")], "doc_id long, text string, _found string")
    row = pii.pseudonyms(docs, "key").first()
    assert row._found == "mine" and row.n_values == 1 and "a.person@" not in str(row)


ROWS = [("b", "one text with some words in it"), ("a", "another text"), (None, "without an id"), (None, ""), ("b", None), ("", "x")]


@pytest.mark.parametrize("kind", ["string", "int", "long", "decimal(20,0)", "date"])
def test_ids_of_any_type(spark, kind):
    number = F.when(F.col("doc_id").isNotNull(), F.length("doc_id") + F.ascii("doc_id"))
    typed = number.cast(kind) if kind != "date" else F.date_add(F.lit("2024-01-01"), number)
    docs = spark.createDataFrame(ROWS, "doc_id string, text string")
    docs = docs if kind == "string" else docs.withColumn("doc_id", typed)
    ids = sorted(str(r[0]) for r in docs.select("doc_id").collect())
    word, a, b = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
    items = spark.createDataFrame([("i", "another text")], "item_id string, text string")
    results = {
        "parsing": parsing.fingerprints(docs),
        "tokens": tokens.token_counts(docs, word),
        "simhash": simhash.near_duplicates(docs),
        "decontaminate": decontaminate.contamination(docs, items),
        "align": align.alignments(docs, a, b),
        "secret_scan": secret_scan.secret_spans(docs),
    }
    for name, frame in results.items():
        assert sorted(str(r.doc_id) for r in frame.collect()) == ids, name
        assert frame.schema["doc_id"].dataType == docs.schema["doc_id"].dataType, name


def test_many_rows_without_an_id_spread_over_ranges(spark):
    docs = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    found = parsing.fingerprints(docs)
    assert found.count() == 400
    ordered = sorted(r.text for r in docs.collect())
    by_size = {r.edited_sha256 for r in found.collect()}
    import hashlib

    expected = {
        hashlib.sha256((t[:32] + ordered[(i + 1) % 400][:32]).encode()).hexdigest() for i, t in enumerate(ordered)
    }
    assert by_size == expected
