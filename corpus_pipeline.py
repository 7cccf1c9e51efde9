"""The corpus pipeline: stages over `documents`, each written and read by the next.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of documents. Empty tables, NULL texts and repeated rows pass as in the operators.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspan.llm import decontaminate, mixing, pii, simhash, toxicity
from lendspan.session import session_scratch

PSEUDONYM_KEY = "pipeline"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns from these documents' labels."""
    return toxicity.accepted(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def replace_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms; n_chars follows the new text."""
    replaced = pii.pseudonyms(docs, PSEUDONYM_KEY)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(F.col("n_values") > 0, length).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", n_chars).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each copy taken of a document, with copy, mix_start and words."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_values),
    ("mixing", mix_sources),
]
# The fitted model and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each stored before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = session_scratch(spark).store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
