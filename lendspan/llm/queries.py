"""The registered query of each corpus operator, over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    align,
    brown,
    decontaminate,
    html,
    mixing,
    oracles,
    parsing,
    pii,
    repeats,
    secret_scan,
    simhash,
    tokens,
    toxicity,
    whitening,
)


# The key of the registered query; users pass their own.
PSEUDONYM_KEY = "check"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_totals(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(_table(spark, sf_dir, "pages"))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_table(spark, sf_dir, "documents"), with_bytes=False)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonyms(docs, PSEUDONYM_KEY)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.fingerprints(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op10_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.alignments(_table(spark, sf_dir, "documents"), a, b)


def op12_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_spans(_table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_simhash_near_duplicates": op2_simhash_near_duplicates,
    "op3_token_counts": op3_token_counts,
    "op4_main_text": op4_main_text,
    "op5_repeated_strings": op5_repeated_strings,
    "op6_toxicity": op6_toxicity,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_decontamination": op9_decontamination,
    "op10_brown_scores": op10_brown_scores,
    "op11_token_alignment": op11_token_alignment,
    "op12_secret_spans": op12_secret_spans,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op1_mixing": oracles.MIXING,
    "op9_decontamination": oracles.DECONTAMINATION,
}
