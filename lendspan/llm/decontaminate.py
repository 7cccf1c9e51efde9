"""Benchmark decontamination by a prefix-filtered containment join, in DataFrame operations.

A window is `SIZE` consecutive words of an item, or all words of a shorter item. A
document contains a window if it contains all its words in order, so it must contain
the window's rarest word: with words ordered by their count in the documents, that one
word is the window's prefix under containment 1. Documents' words are joined with these
prefix words only; a match must leave room for the words before and after it (length and
position), and is then verified word by word.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, session_scratch
from .common import ascii_lower, free_names

SIZE = 10
# The benchmark's side of a join is broadcast up to this measured size, and else shuffled.
BROADCAST_BYTES = 32 << 20

# What a word is made of after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _fits(small: DataFrame, column: str) -> bool:
    """Whether the measured size of `small` allows a broadcast."""
    size = small.agg(F.sum(F.length(F.col(column).cast("string")) + 64)).first()[0] or 0
    return size <= BROADCAST_BYTES


def _fitted(small: DataFrame, column: str) -> DataFrame:
    """`small` with a broadcast hint if its measured size allows it."""
    return F.broadcast(small) if _fits(small, column) else small


def item_windows(items: DataFrame, item_id: str, text: str, size: int = SIZE) -> DataFrame:
    """Distinct (item_id, win): each item's windows as arrays of words."""
    split = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        split.where(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at"), F.lit(size)).alias("win"))
        .distinct()
    )


def prefix_words(windows: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (word, place, win): each window by its word that is rarest in the documents.

    `docs` has (words). Windows with a word that no document has are left out.
    """
    distinct = windows.select("win").distinct()
    places = scratch.store(distinct.select("win", F.posexplode("win").alias("place", "word")))
    vocabulary = scratch.store(places.select("word").distinct())
    counts = (
        docs.select(F.explode("words").alias("word"))
        .join(_fitted(vocabulary, "word"), "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = scratch.store(counts)
    best = (
        places.join(counts, "word")
        .groupBy("win")
        .agg(F.min(F.struct("n", "word", "place")).alias("best"), F.count(F.lit(1)).alias("known"))
        .where(F.col("known") == F.size("win"))
    )
    return scratch.store(best.select("best.word", "best.place", "win"))


def occurrences(docs: DataFrame, prefixes: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, text_key, start, win) of windows in documents (doc_id, text_key, words).

    Surroundings of window length are cut for words that begin a search. Where the prefixes are
    broadcast these are the words that meet one; else every word is shuffled, with its
    surroundings and never with the whole text.
    """
    each = docs.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "word"))
    before = F.least(F.col("pos"), F.lit(size - 1)).alias("before")
    near = F.slice("words", F.greatest(F.col("pos") - size + 2, F.lit(1)), F.lit(2 * size - 1)).alias("near")
    kept = ("doc_id", "text_key", "word", "pos", before, near)
    if _fits(prefixes, "win"):
        met = each.join(F.broadcast(prefixes), "word").select(*kept, "place", "win")
    else:
        met = each.select(*kept).join(prefixes, "word")
    first = F.col("before") - F.col("place")
    return (
        met.where((first >= 0) & (first + F.size("win") <= F.size("near")))
        .where(F.slice("near", F.greatest(first, F.lit(0)) + 1, F.size("win")) == F.col("win"))
        .select("doc_id", "text_key", (F.col("pos") - F.col("place")).alias("start"), "win")
    )


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = SIZE,
) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated.

    A NULL text or item has no words, an item without an id marks words but is not counted
    among the items; rows with the same id and different texts are separate documents, and
    repeated rows give repeated results. No items: nothing is hit.
    """
    scratch = session_scratch(docs.sparkSession)
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    )
    # texts are split once; three passes read the words
    split = scratch.store(keyed.select("doc_id", "text_key", words(F.col("text")).alias("words")))
    windows = scratch.store(item_windows(items, item_id, item_text, size))
    prefixes = prefix_words(windows, split, scratch)
    hits = scratch.store(occurrences(split, prefixes, size).distinct())
    key = ("doc_id", "text_key")
    covered = F.sequence(F.col("start"), F.col("start") + F.size("win") - 1)
    n_hit = (
        hits.select(*key, F.explode(covered).alias("pos")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = (
        hits.select(*key, "win").distinct().join(windows.where("item_id IS NOT NULL"), "win").select(*key, "item_id").distinct()
    )
    listed = found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("ids")
    )
    both = scratch.store(
        n_hit.alias("h").join(
            listed.alias("l"),
            F.col("h.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("h.text_key") == F.col("l.text_key")),
            "left",
        ).select("h.*", "n_items", "ids")
    )
    counted = split.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_key") == F.col("b.text_key"))
    return (
        counted.alias("d")
        .join(both.alias("b"), same, "left")
        .select(
            "d.doc_id",
            "d.text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """The rows of `docs` that contain no window of an item, columns unchanged whatever their names."""
    id_name, key = free_names(docs, "_id", "_key")
    found = contamination(docs, items, doc_id, text, **names).where("contaminated").select(
        F.col("doc_id").alias(id_name), F.col("text_key").alias(key)
    ).distinct()
    same = docs[doc_id].eqNullSafe(F.col(id_name)) & (F.xxhash64(docs[text]) == F.col(key))
    return docs.join(found, same, "left_anti")
