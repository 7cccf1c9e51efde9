"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprint: 64 bits, each set where more than half of a text's shingle hashes have it.
Two fingerprints link at `DISTANCE` or fewer differing bits; a class is everything
reachable over links.

The bits are cut into five consecutive segments in a ring. If at most 4 bits differ,
some start on the ring has, for every length l, at most floor(4 l / 5) differences over
the first l segments of its chain: none in the first, one over two, and so on. The first
two segments are a join key: exact in the first, the second with at most one bit
flipped. The longer chains and the whole distance are checked inside the join.

Only distinct fingerprints are compared. Fingerprints with a common neighbour one bit
away are at most two bits apart; they are joined first, through that neighbour, which
takes 65 rows a fingerprint whatever the size of a group. The pairwise search then looks
for links between different classes only, and in a crowded key not within the class
that crowds it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, session_scratch
from .common import LOWER, UPPER, components, free_names, slices, string_texts, texts

DISTANCE = 4
SHINGLE = 4
SEED = 42
# Widths of the ring's segments, from the high bits down.
SEGMENTS = (13, 13, 13, 13, 12)
BLOCK = 1 << 15

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The unsigned fingerprint; a text without words has 0, one with few words a single shingle."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < size:
        shingles = 1
        counts = _bit_counts([b" ".join(words)])
    else:
        shingles = len(words) - size + 1
        counts = np.zeros(64, np.int64)
        for start in range(0, shingles, BLOCK):
            part = words[start : start + BLOCK + size - 1]
            counts += _bit_counts([b" ".join(g) for g in zip(*(part[k:] for k in range(size)), strict=False)])
    return int.from_bytes(np.packbits(counts * 2 > shingles).tobytes(), "big")


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    packed = b"".join([digest(s, SEED) for s in shingles])
    bits = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """One row per document: doc_id, fp, the fingerprint as a signed long, and text_key, a column
    carried along (NULL without one). NULL text is empty."""
    text_key = F.col(key) if key else F.lit(None)
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        text_key.cast("long").alias("text_key"),
    )
    schema = chosen.select("doc_id", F.lit(0).cast("long").alias("fp"), "text_key").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_normal(batch), 1):
                found = np.array([fingerprint(t) for t in texts(part.column(1))], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found), part.column(2)], ["doc_id", "fp", "text_key"]
                )

    return chosen.mapInArrow(work, schema)


def _normal(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1), batch.column(2)], ["doc_id", "text", "text_key"])


def _segment(bits: str, start: int) -> str:
    below = 64 - sum(SEGMENTS[: start + 1])
    return f"(shiftrightunsigned({bits}, {below}) & {(1 << SEGMENTS[start]) - 1}L)"


def _keys(flips: bool) -> Column:
    """Keys of all chain starts of fp; with flips, also each with one bit of its second segment changed."""
    keys = []
    for start in range(len(SEGMENTS)):
        after = (start + 1) % len(SEGMENTS)
        key = f"({start << 26}L | shiftleft({_segment('fp', start)}, 13) | {_segment('fp', after)})"
        keys.append(key)
        if flips:
            keys += [f"({key} ^ {1 << bit}L)" for bit in range(SEGMENTS[after])]
    return F.expr(f"explode(array({', '.join(keys)}))")


def _within_ring(a: str, b: str, key: str) -> Column:
    """Whether the chain that the key begins keeps within its budgets, and the whole distance."""
    differ, ring = f"({a} ^ {b})", len(SEGMENTS)
    cases = []
    for first in range(ring):
        counts = [f"bit_count({_segment(differ, (first + k) % ring)})" for k in range(ring)]
        budgets = [f"{' + '.join(counts[:k])} <= {DISTANCE * k // ring}" for k in range(1, ring)]
        cases.append(f"WHEN {first} THEN {' AND '.join(budgets)}")
    return F.expr(f"bit_count({differ}) <= {DISTANCE} AND CASE shiftright({key}, 26) {' '.join(cases)} END")


def _shuffled(frame: DataFrame) -> DataFrame:
    """`frame` for a join that is never a broadcast by estimate.

    Spark sizes exploded rows, and sums over them, as the rows before the explode: 65 rows a
    fingerprint look as small as one.
    """
    return frame.hint("merge")


def _close_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) through a shared value at most one bit away from both."""
    around = ["fp", *[f"fp ^ shiftleft(1L, {bit})" for bit in range(64)]]
    spread = distinct.select("fp", F.expr(f"explode(array({', '.join(around)}))").alias("near"))
    shared = spread.groupBy("near").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return spread.join(_shuffled(shared.select("near", "a")), "near").select("a", F.col("fp").alias("b")).where("a <> b").distinct()


def _far_links(labelled: DataFrame) -> DataFrame:
    """Links between different classes of `labelled` (fp, label) by the pigeonring filter."""
    index = labelled.select("fp", "label", _keys(False).alias("key"))
    per_label = index.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    crowd = _shuffled(per_label.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("crowd")))
    indexed = index.join(crowd, "key").select(
        "key", (F.col("label") == F.col("crowd")).alias("crowded"), F.col("fp").alias("b"), F.col("label").alias("label_b")
    )
    probes = (
        labelled.select("fp", "label", _keys(True).alias("key"))
        .join(crowd, "key")
        # the class that crowds a key looks only at the others there
        .select(
            "key",
            F.explode(
                F.when(F.col("label") == F.col("crowd"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
            ).alias("crowded"),
            F.col("fp").alias("a"),
            F.col("label").alias("label_a"),
        )
    )
    return (
        probes.join(
            _shuffled(indexed.withColumnRenamed("key", "key_b").withColumnRenamed("crowded", "crowded_b")),
            (F.col("key") == F.col("key_b"))
            & (F.col("crowded") == F.col("crowded_b"))
            & (F.col("label_a") != F.col("label_b"))
            & _within_ring("a", "b", "key"),
        )
        .select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        .distinct()
    )


def link_classes(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """Class of each distinct fingerprint: rows (fp, label), label its smallest fingerprint."""

    def labelled(frame: DataFrame, old: str, classes: DataFrame) -> DataFrame:
        joined = frame.join(classes, F.col(old) == F.col("node"), "left")
        return joined.select("fp", F.coalesce(F.col("classes.label"), F.col(old)).alias("label"))

    close = components(_close_links(distinct), scratch)
    first = scratch.store(labelled(distinct, "fp", close.alias("classes")))
    far = components(_far_links(first), scratch)
    return labelled(first.withColumnRenamed("label", "old"), "old", far.alias("classes"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest doc_id of the class, the document's own included; NULL
    ids are left out of that minimum. Every input row gives one row, repeated ids
    included; an empty table gives an empty result.
    """
    scratch = session_scratch(docs.sparkSession)
    prints = scratch.store(fingerprints(docs, doc_id, text))
    per_print = scratch.store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    classes = scratch.store(link_classes(per_print.select("fp"), scratch))
    heads = classes.join(per_print, "fp").groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_print = scratch.store(classes.join(heads, "label").select("fp", "component_id"))
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with one document of each class kept, columns unchanged.

    Kept is the document of the smallest id, of several rows with that id one with the
    smallest text hash; ids that are NULL come last. Other columns may have any names.
    """
    scratch = session_scratch(docs.sparkSession)
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    id_name, text_name, key = free_names(docs, "_id", "_text", "_key")
    prints = scratch.store(fingerprints(docs.withColumn(key, F.xxhash64(text)), doc_id, text, key))
    per_print = scratch.store(prints.groupBy("fp").agg(F.min(row).alias("first")))
    classes = link_classes(per_print.select("fp"), scratch)
    heads = scratch.store(
        classes.join(per_print, "fp").groupBy("label").agg(F.min("first").alias("head")).select("head.*")
    )
    kept = heads.select(F.col("doc_id").alias(id_name), F.col("text_key").alias(text_name))
    same = docs[doc_id].eqNullSafe(F.col(id_name)) & (F.xxhash64(docs[text]) == F.col(text_name))
    return docs.join(kept, same, "left_semi").dropDuplicates([doc_id, text])
