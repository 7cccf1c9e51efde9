"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations.

Each source's documents are shuffled by a hash of their id and served in that order, up
to `MAX_TIMES` times over. A served copy has a virtual finish time: the words of its
source up to its end, divided by the source's target. All copies are range-sorted by
finish time and the mix is cut where its total budget is reached. A copy in service at
the cut (at most one per source) is taken in part, so each source ends within a word of
its target whatever the length of its documents.

All running totals (words within a source, words of the mix) come from global range
sorts, so a source that holds a third of the rows is spread over many ranges.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import in_ranges, running_totals
from ..session import Scratch, session_scratch
from .common import free_names, word_count

WEIGHTS = (1, 2, 3)
MAX_TIMES = 3


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size in words, and the shuffling key. A NULL text has size 0."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")).alias("shuffle_key"),
        F.xxhash64(text).alias("text_key"),
    )


def source_targets(per_source: DataFrame, weights: tuple, times: int, scratch: Scratch) -> DataFrame:
    """Rank, weight, size and target of each source, sources by code point and NULL last.

    `per_source` has (source, source_size). The weights share all words; a target stops at
    `times` its source's size and what it leaves is shared by weight among the others,
    until none is above. Each round brings two sums to the driver, never the sources.
    """
    order = (F.col("source").asc_nulls_last(),)
    ranged = in_ranges(per_source.withColumn("sources", F.lit(1).cast("long")), order, scratch)
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = scratch.store(
        running_totals(ranged, order, ("sources", "source_size")).select(
            "source",
            "source_size",
            F.col("sources_before").alias("source_rank"),
            F.col("source_size_before").alias("words_before"),
            F.get(cycle, (F.col("sources_before") % len(weights)).cast("int")).alias("weight"),
        )
    )
    level, stopped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("source_size") * times
        state = ranked.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("source_size") * times)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("full"),
        ).first()
        if state.full == stopped or not state.open or not state.words:
            break
        stopped = state.full
        level = (state.words - (state.taken or 0)) / state.open
    own, most = F.col("weight") * F.lit(level), (F.col("source_size") * times).cast("double")
    return ranked.withColumn("target", F.least(own, most))


def virtual_times(docs_sized: DataFrame, weights: tuple, times: int, scratch: Scratch) -> DataFrame:
    """Each document with its source's size and target, and the words of its source before it."""
    held = scratch.store(docs_sized)
    per_source = held.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, times, scratch).withColumnRenamed("source", "named")
    joined = held.join(targets, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    order = (F.col("source_rank"), F.col("shuffle_key"), F.col("doc_id"), F.col("size"), F.col("text_key"))
    ranged = in_ranges(joined, order, scratch)
    return running_totals(ranged, order, ("size",)).withColumn("start", F.col("size_before") - F.col("words_before"))


def mix(served: DataFrame, times: int, scratch: Scratch) -> DataFrame:
    """The copies of the mix: the rows of `served` by copy number, with finish, mix_start and words.

    `served` comes from `virtual_times`. Copies whose turn ends the budget may keep fewer words.
    """
    copies = (
        served.where("size > 0")
        .select("*", F.explode(F.array(*[F.lit(n) for n in range(times)])).alias("copy"))
        .withColumn("begin", F.col("start") + F.col("copy") * F.col("source_size"))
        .where(F.col("begin") < F.col("target"))
        .withColumn("finish", (F.col("begin") + F.col("size")) / F.col("target"))
        .withColumn("served", F.least(F.col("size"), F.ceil("target") - F.col("begin")))
    )
    order = (F.col("finish"), F.col("source_rank"), F.col("copy"), F.col("begin"))
    ranged = in_ranges(copies, order, scratch)
    budget = _budget(served)
    return (
        running_totals(ranged, order, ("served",))
        .withColumnRenamed("served_before", "mix_start")
        .withColumn("words", F.greatest(F.lit(0), F.least(F.col("served"), budget - F.col("mix_start"))))
    )


def _budget(served: DataFrame) -> Column:
    return F.coalesce(served.agg(F.sum("size").alias("budget")).scalar(), F.lit(0))


def mix_totals(
    docs: DataFrame, weights: tuple = WEIGHTS, times: int = MAX_TIMES,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Per document: doc_id, size, source_size, target and taken, its words in the mix.

    Every input row gives one row: repeated rows are separate documents, a NULL source is
    a source of its own, documents without words take nothing.
    """
    scratch = session_scratch(docs.sparkSession)
    served = scratch.store(virtual_times(sized(docs, doc_id, text, source), weights, times, scratch))
    copies = mix(served, times, scratch)
    columns = ("doc_id", "size", "source_size", "target")
    # a document with words is the only one of its source that begins where it does
    taken = copies.groupBy(*columns, "source_rank", "start").agg(F.sum("words").alias("taken"))
    unserved = served.where((F.col("size") == 0) | (F.col("start") >= F.col("target")))
    return taken.select(*columns, "taken").unionByName(
        unserved.select(*columns, F.lit(0).cast("long").alias("taken"))
    )


def mixed_documents(
    docs: DataFrame, weights: tuple = WEIGHTS, times: int = MAX_TIMES,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix itself: the input's columns for each copy taken, with copy, mix_start and words.

    mix_start is the copy's place in the mix, words how many of its words are taken; columns
    of these names in the input are replaced.
    """
    scratch = session_scratch(docs.sparkSession)
    served = scratch.store(virtual_times(sized(docs, doc_id, text, source), weights, times, scratch))
    copies = mix(served, times, scratch).where("words > 0")
    # rows alike in id and text are told apart by a number
    nth = "row_number() OVER (PARTITION BY {} ORDER BY {})"
    id_name, text_name, nth_name, source_name, key, number = free_names(
        docs, "_id", "_text", "_nth", "_source", "_key", "_number"
    )
    taken = copies.select(
        F.col("doc_id").alias(id_name), F.col("text_key").alias(text_name),
        F.expr(nth.format("doc_id, text_key, source_rank, copy", "begin")).alias(nth_name),
        F.col("source").alias(source_name), "copy", "mix_start", "words",
    )
    named = [c for c in docs.columns if c not in ("copy", "mix_start", "words")]
    rows = docs.select(*[F.col(f"`{c}`") for c in named]).withColumn(key, F.xxhash64(text)).withColumn(
        number, F.expr(nth.format(f"`{doc_id}`, {key}, `{source}`", "1"))
    )
    kept = [F.col(f"`{c}`") for c in named]
    same = (
        rows[doc_id].eqNullSafe(F.col(id_name))
        & rows[source].eqNullSafe(F.col(source_name))
        & (F.col(key) == F.col(text_name))
        & (F.col(number) == F.col(nth_name))
    )
    return rows.join(taken, same).select(*kept, "copy", "mix_start", "words")
