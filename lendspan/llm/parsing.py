"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases into longer phrases, and so on. Where
a phrase begins is decided by deterministic coin tossing: each symbol gets a label from
the lowest bit in which it differs from its left neighbour; repeated four times this
leaves labels below six of which neighbours differ, and phrases begin at the local
maxima. Whether a position begins a phrase thus depends on a few symbols around it, not
on its offset, so equal substrings get equal phrases inside, whatever stands before them.
Runs of one symbol become one symbol first. A phrase's name is a hash of its symbols.

A fingerprint is a min-hash of the phrase names of the two upper levels; likeness is the
share of its lanes that agree.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import session_scratch
from .common import slices, string_texts

LEVELS = 3
# The phrases of this level and those above it are compared.
LOWEST = 2
LANES = 64
# Characters by which rows of one id are parted; whole texts order them.
BEGIN = 32
SLICE = 1 << 20

_RNG = np.random.default_rng(20)
_LANE_MULTIPLIER = _RNG.integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LANE_ADD = _RNG.integers(0, 2**63, LANES, dtype=np.uint64)
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_NAMES = mix64(np.arange(1, 257, dtype=np.uint64))


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; the first symbol of each text is compared with its complement."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    differ = symbols ^ left
    lowest = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1)).astype(np.uint8)
    bit = (symbols >> lowest.astype(symbols.dtype)) & symbols.dtype.type(1)
    return (lowest * np.uint8(2) + bit.astype(np.uint8)).astype(np.uint8)


def _without_runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol within a text as one symbol; first positions in the new array."""
    begins = np.empty(len(names), bool)
    begins[0] = True
    np.not_equal(names[1:], names[:-1], out=begins[1:])
    begins[first] = True
    at = np.flatnonzero(begins)
    if len(at) == len(names):
        return names, first
    length = np.diff(np.append(at, len(names))).astype(np.uint64)
    kept = names[at]
    run = length > 1
    kept[run] = mix64(kept[run] * np.uint64(3) + length[run])
    return kept, np.searchsorted(at, first)


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of one more level; `first` are the first positions of non-empty texts."""
    names, first = _without_runs(names, first)
    labels = _toss(names, first)
    for _ in range(3):
        labels = _toss(labels, first)
    begins = np.zeros(len(names), bool)
    begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    begins[first[1:] - 1] = False  # the last of a text has no right neighbour
    begins[first] = True
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(names)))
    offset = np.arange(len(names)) - np.repeat(at, length)
    sums = np.add.reduceat(names * _POWERS[offset % len(_POWERS)], at)
    return mix64(sums + length.astype(np.uint64)), np.searchsorted(at, first)


def signatures(texts: list[bytes]) -> np.ndarray:
    """One row of lanes per text; an empty text has all lanes zero. Equal texts get equal rows."""
    lengths = np.array([len(t) for t in texts], np.int64)
    lanes = np.zeros((len(texts), LANES), np.uint16)
    filled = np.flatnonzero(lengths)
    if not len(filled):
        return lanes
    names = _BYTE_NAMES[np.frombuffer(b"".join(texts), np.uint8)]
    first = (np.cumsum(lengths) - lengths)[filled]
    levels = []
    for level in range(1, LEVELS + 1):
        names, first = parse(names, first)
        if level >= LOWEST:
            levels.append((names, first))
    for lane in range(LANES):
        least = None
        for names, first in levels:
            low = np.minimum.reduceat(mix64(names * _LANE_MULTIPLIER[lane] + _LANE_ADD[lane]), first)
            least = low if least is None else np.minimum(least, low)
        lanes[filled, lane] = least & np.uint64(0xFFFF)
    return lanes


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _hex(lanes: np.ndarray) -> list[str]:
    packed = lanes.astype(">u2").tobytes()
    width = 2 * LANES
    return [packed[i : i + width].hex() for i in range(0, len(packed), width)]


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _compared(ids: list, texts: list[str], following: list[str]) -> list[list]:
    """Columns NAMES of documents and the texts that follow them."""
    changed = [edited(t, n).encode() for t, n in zip(texts, following, strict=True)]
    own = signatures([t.encode() for t in texts])
    other = signatures(changed)
    behind = own[1:] if texts[1:] == following[:-1] else signatures([n.encode() for n in following[:-1]])
    behind = np.concatenate([behind, signatures([following[-1].encode()])])
    return [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        _hex(own),
        _hex(other),
        likeness(own, other).tolist(),
        likeness(own, behind).tolist(),
    ]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the columns NAMES: its fingerprint, that of its edited text, and likenesses.

    The texts are range-partitioned by id once. Within a range each document meets its
    successor as rows stream by; a range's last document meets the first of the next range
    through a table of two rows a range. NULL texts are empty, NULL ids come first, rows
    with equal ids follow each other by text; a single document is its own successor. An id may
    have any type that Spark can sort.
    """
    scratch = session_scratch(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    result = (
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def rows(of_id: pa.DataType, columns: list[list], kind: int, part: int, whole: list) -> pa.RecordBatch:
        n = len(columns[0])
        types = [of_id, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        arrays += [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(whole, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [*NAMES, "kind", "part", "text"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        blank = lambda doc: [[doc], *[[None]] * (len(NAMES) - 1)]
        held: tuple | None = None
        of_id = pa.null()
        for batch in batches:
            of_id = batch.column(0).type
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for piece in slices(batch, 1, SLICE):
                ids, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                if held is None:
                    yield rows(of_id, blank(ids[0]), 1, part, texts[:1])
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                if len(ids) > 1:
                    columns = _compared(ids[:-1], texts[:-1], texts[1:])
                    yield rows(of_id, columns, 0, part, [None] * (len(ids) - 1))
                held = ids[-1], texts[-1]
        if held is not None:
            yield rows(of_id, blank(held[0]), 2, part, [held[1]])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, texts, following = (batch.column(c).slice(row, 1).to_pylist() for c in range(3))
                columns = _compared(ids, texts, following)
                yield rows(batch.column(0).type, columns, 0, 0, [None]).select(list(NAMES))

    # many rows of one id, or without one, spread over the ranges by how their texts begin
    begin = F.substring("text", 1, BEGIN)
    ordered = chosen.repartitionByRange(parts, F.col("doc_id"), begin).sortWithinPartitions("doc_id", "text")
    met = scratch.store(ordered.mapInArrow(within, f"{result}, kind int, part int, text string"))
    firsts = met.where("kind = 1").select("part", F.col("text").alias("following"))
    numbers = met.where("kind = 1").selectExpr(
        "part AS before",
        "coalesce(lead(part) OVER (ORDER BY part), min(part) OVER ()) AS part",
    )
    lasts = met.where("kind = 2").select(F.col("part").alias("before"), "doc_id", "text")
    pairs = lasts.join(numbers, "before").join(firsts, "part").select("doc_id", "text", "following")
    return met.where("kind = 0").select(*NAMES).unionByName(pairs.mapInArrow(across, result))
