"""What several corpus operators share: word rules, row slices, connected components."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

# The white space that separates words, and the ASCII lower-casing.
SPACE = "\\x20\\x09-\\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

SLICE_BYTES = 4 << 20


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with underscores put before it until `docs` has no such column."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        names.append(name)
        taken.add(name.lower())
    return names


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than the fixed white space; NULL counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII texts take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; NULL is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most `limit` bytes of text, or one longer row.

    Bounds the memory of vectorised work however long the texts of a batch are.
    """
    sizes = np.diff(np.frombuffer(_offsets(batch.column(text)), dtype=np.int32))
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def _offsets(column: pa.Array) -> memoryview:
    raw = memoryview(column.buffers()[1])
    return raw[4 * column.offset : 4 * (column.offset + len(column) + 1)]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and where each begins (and the last ends)."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(_offsets(column), dtype=np.int32).astype(np.int64)
    data = column.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    if column.null_count:
        return text_buffer(column.fill_null(""))
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def string_texts(batch: pa.RecordBatch, text: int) -> pa.Array:
    """The text column with 32-bit offsets and without NULL."""
    column = batch.column(text)
    if column.type != pa.string():
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of links (a, b): rows (node, label), label the smallest node.

    Large-star and small-star steps in turn until nothing changes; only nodes with a
    link to another node have a row. The smallest neighbours are stored before they are
    joined, so that Spark can split the join rows of a hub.
    """
    spark = links.sparkSession
    edges = scratch.store(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen, before = state, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = scratch.store(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = scratch.store(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
        edges = scratch.store(small.distinct())
        scratch.drop(before)
        scratch.drop(large)
