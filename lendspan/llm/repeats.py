"""Removal of long repeated byte strings, by suffix buckets sorted with difference-cover ranks.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier. A window is
such a string at one start.

1. Cells. The smallest hash of the grams (`GRAM` bytes) inside a window names its suffix
   bucket, so equal windows share one. Neighbours with the same smallest gram, at most
   `SHIFTS` of them, are a cell. A cell goes to its bucket as two 64-bit hashes and its place.
   Of cells with equal bytes all but the first hold later windows only, and nothing another
   needs as source; a task settles those it meets itself, so common cells go out once a task.
2. Suffix buckets. Only buckets with several different cells can hold more. One copy of
   each such cell goes there with its bytes, in order of place.
3. Cover ranks. A task sorts one block of whole buckets at a time. Positions whose number
   mod 3 lies in a difference cover are samples, ranked to a depth of `DEPTH` bytes by doubling.
   Any two windows meet samples at a common shift below 3, so two windows are equal if there
   the ranks and the two bytes left over are: a tie of any length costs one comparison, and
   bytes are compared, not hashes.

A bucket with very many different cells is cut by the hash of whole windows into parts, so
none outgrows a task.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import session_scratch
from .common import slices, string_texts, text_buffer

LENGTH = 100
SHIFTS = 69
GRAM = LENGTH - SHIFTS + 1
# Every number below 3 is a difference of two of the cover, mod 3.
MODULUS = 3
COVER = (0, 1)
DEPTH = LENGTH - MODULUS + 1
# Ranks of 8 bytes come first; each step, a multiple of 3, joins the ranks of two samples.
FIRST = 8
STEPS = (6, 12, 24, 48)
PIECE = 1 << 21
# Bytes of buckets that a task sorts at once; different cells of one part of a bucket.
BLOCK = 1 << 21
PART = 4096
# Cells that a task settles among themselves before it sends them.
FLUSH = 1 << 20
# Low bits of a gram's sort key that hold its position, so that the leftmost of equal ones wins.
PLACE_BITS = 24

_RNG = np.random.default_rng(57)
_TABLES = _RNG.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get((base, 0))
    if held is None or len(held) < n:
        size = max(n, PIECE + 2 * LENGTH)
        held = np.full(size, np.uint64(base))
        held[0] = 1
        _POWERS[base, 0] = held = np.multiply.accumulate(held)
    return held[:n]


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    """Sum of the weighted bytes before every position."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[which][data] * _powers(_BASES[which], len(data)), out=sums[1:])
    return sums


def _mixed(raw: np.ndarray) -> np.ndarray:
    return raw ^ (raw >> np.uint64(29))


def window_hashes(data: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """64-bit hash of the `length` bytes at every start."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64)
    sums = _sums(data, which)
    inverse = _powers(pow(_BASES[which], -1, 2**64), n - length + 1)
    return _mixed((sums[length:] - sums[: n - length + 1]) * inverse)


def cells(data: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, hash, begin, number of windows) of the cells of the live window starts."""
    grams = window_hashes(data, GRAM)
    key = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    width, least = 1, key
    while 2 * width <= SHIFTS:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = SHIFTS - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    starts = np.flatnonzero(live)
    at = (least[starts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    begin, count = starts[new], np.diff(np.append(new, len(starts)))
    sums = _sums(data, 1)
    inverse = _powers(pow(_BASES[1], -1, 2**64), len(data))
    whole = (sums[begin + count + LENGTH - 1] - sums[begin]) * inverse[begin]
    return grams[at[new]], _mixed(whole) + count.astype(np.uint64), begin, count


def _stretches(batch: pa.RecordBatch, text: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, bounds of the texts, number of the first row, offset): rows together, or a piece of a long one.

    Pieces share out a text's window starts, each with the rest of its last window.
    """
    row = 0
    for part in slices(batch, text, size):
        data, bounds = text_buffer(part.column(text))
        if part.num_rows > 1 or len(data) <= size:
            yield data, bounds, row, 0
        else:
            starts = len(data) - LENGTH + 1
            for at in range(0, max(starts, 0), size):
                piece = data[at : min(at + size, starts) + LENGTH - 1]
                yield piece, np.array([0, len(piece)]), row, at
        row += part.num_rows


def _cells(docs: DataFrame, size: int, flush: int) -> DataFrame:
    """(bucket, hash, doc_id, text_key, begin, n) of all cells; n is negative for those known to come later."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            batch = batch.set_column(2, "text", string_texts(batch, 2))
            for data, bounds, row, offset in _stretches(batch, 2, size):
                if len(data) < LENGTH:
                    continue
                edge = np.zeros(len(data) + 1, np.int32)
                full = np.flatnonzero(np.diff(bounds) >= LENGTH)
                edge[bounds[full]] += 1
                edge[bounds[full + 1] - LENGTH + 1] -= 1
                live = np.cumsum(edge)[: len(data) - LENGTH + 1] > 0
                if not live.any():
                    continue
                bucket, whole, begin, windows = cells(data, live)
                owner = np.searchsorted(bounds, begin, side="right") - 1
                rows = pa.array(owner + row)
                held.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket.view(np.int64)), pa.array(whole.view(np.int64)),
                            batch.column(0).take(rows), batch.column(1).take(rows),
                            pa.array(begin - bounds[owner] + offset), pa.array(windows.astype(np.int32)),
                        ],
                        _CELL,
                    )
                )
                count += len(begin)
                if count >= flush:
                    yield from _settled(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            yield from _settled(pa.Table.from_batches(held))

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        work, f"bucket long, hash long, doc_id {_kind(docs)}, text_key long, begin long, n int"
    )


_CELL = ["bucket", "hash", "doc_id", "text_key", "begin", "n"]
_PLACE = ["doc_id", "text_key", "begin"]


def _column(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _changes(rows: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row differs from the one before it in any of the columns; NULLs are alike."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in names:
        codes = _column(rows, name)
        codes = codes.dictionary_encode("encode").indices if codes.null_count or not pa.types.is_integer(codes.type) else codes
        codes = codes.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _firsts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of cells in order: the first of each kind, and the later ones; the same place counts once."""
    kind = _changes(rows, ["bucket", "hash"])
    place = _changes(rows, _PLACE) | kind
    number = np.cumsum(place)
    later = place & (number != number[np.flatnonzero(kind)][np.cumsum(kind) - 1]) if len(rows) else place
    return kind, later


def _settled(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The first cell of each kind, and the later ones marked, dealt out by their place."""
    hashes = [rows.column(c).to_numpy() for c in ("bucket", "hash")]
    order = np.lexsort(hashes)
    same = np.concatenate([[False], (np.diff(hashes[0][order]) == 0) & (np.diff(hashes[1][order]) == 0)])
    alike = same.copy()
    alike[:-1] |= same[1:]
    yield from rows.take(pa.array(order[~alike])).to_batches()
    rows = rows.take(pa.array(order[alike]))
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in _CELL[:-1]], null_placement="at_start"))
    first, later = _firsts(rows)
    yield from rows.filter(pa.array(first)).to_batches()
    rows = rows.filter(pa.array(later))
    rows = rows.set_column(0, "bucket", pa.array(rows.column("text_key").to_numpy() ^ (rows.column("begin").to_numpy() << 32)))
    yield from rows.set_column(5, "n", pa.array(-rows.column("n").to_numpy())).to_batches()


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], size: int) -> Iterator[tuple[pa.Table, int | None]]:
    """Ordered rows in blocks of whole groups, about `size` bytes each, with the bucket that follows."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total < size:
            continue
        rows = pa.Table.from_batches(held)
        cut = int(np.flatnonzero(_changes(rows, keys))[-1]) if len(rows) else 0
        if cut:
            yield rows.slice(0, cut), rows.column("bucket")[cut].as_py()
            held = rows.slice(cut).combine_chunks().to_batches()
            total = sum(b.nbytes for b in held)
    if total:
        yield pa.Table.from_batches(held), None


def _judged(sent: DataFrame, block: int) -> DataFrame:
    """(doc_id, text_key, begin, n, bucket): cells that come later, without a bucket, and those to sort."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_bucket = None
        for rows, following in _groups(batches, ["bucket", "hash"], block):
            windows = rows.column("n").to_numpy()
            settled = rows.filter(pa.array(windows < 0))
            settled = settled.set_column(5, "n", pa.array(-settled.column("n").to_numpy()))
            rows = rows.filter(pa.array(windows > 0))
            first, later = _firsts(rows)
            kinds = rows.filter(pa.array(first))
            buckets = kinds.column("bucket").to_numpy()
            shared = np.zeros(len(buckets), bool)
            same = buckets[1:] == buckets[:-1]
            shared[1:] |= same
            shared[:-1] |= same
            # a bucket that goes on in another block has several kinds
            for other in (open_bucket, following):
                if other is not None:
                    shared |= buckets == other
            open_bucket = following
            for part, wanted in ((settled, None), (rows.filter(pa.array(later)), None), (kinds.filter(pa.array(shared)), "bucket")):
                if len(part):
                    bucket = part.column(wanted) if wanted else pa.nulls(len(part), pa.int64())
                    yield from pa.table([*(part.column(c) for c in (*_PLACE, "n")), bucket], [*_PLACE, "n", "bucket"]).to_batches()

    ordered = sent.repartition("bucket").sortWithinPartitions("bucket", "hash", *_PLACE)
    return ordered.mapInArrow(work, f"doc_id {_kind(sent)}, text_key long, begin long, n int, bucket long")


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _lists(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bounds of each row's list of structs, NULL being empty, and the fields of all lists."""
    held = batch.column(column)
    bounds = np.concatenate([[0], np.cumsum(held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    return bounds.astype(np.int64), [f.to_numpy(zero_copy_only=False) for f in held.flatten().flatten()]


def _sent(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text_key, begin, bytes): the listed cells, those of cut buckets by parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, (begins, counts, buckets, parts) = _lists(batch, 3)
            texts = string_texts(batch, 2).cast(pa.binary())
            rows, keys, places, found, held = [], [], [], [], 0

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                at = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(places, pa.int64()), pa.array(found, pa.binary())],
                    ["bucket", "doc_id", "text_key", "begin", "bytes"],
                )

            for row in range(batch.num_rows):
                if bounds[row] == bounds[row + 1]:
                    continue
                text = texts[row].as_py()
                part = slice(bounds[row], bounds[row + 1])
                for begin, count, bucket, of in zip(*(c[part].tolist() for c in (begins, counts, buckets, parts)), strict=True):
                    whole = text[begin : begin + count + LENGTH - 1]
                    if of == 1:
                        entries = [(bucket, begin, whole)]
                    else:
                        share = window_hashes(np.frombuffer(whole, np.uint8), LENGTH) % np.uint64(of)
                        entries = [
                            (hash((bucket, s)), begin + k, whole[k : k + LENGTH]) for k, s in enumerate(share.tolist())
                        ]
                    for key, place, string in entries:
                        rows.append(row)
                        keys.append(key)
                        places.append(place)
                        found.append(string)
                        held += len(string)
                    if held > PIECE:
                        yield flush()
                        held = 0
                        for column in (rows, keys, places, found):
                            column.clear()
            if rows:
                yield flush()

    return docs.select("doc_id", "text_key", "text", "cells").mapInArrow(
        work, f"bucket long, doc_id {_kind(docs)}, text_key long, begin long, bytes binary"
    )


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of numbers."""
    order = np.argsort(keys)
    held = keys[order]
    ranks = np.empty(len(keys), np.uint64)
    ranks[order] = np.cumsum(np.concatenate([[False], held[1:] != held[:-1]]), dtype=np.uint64)
    return ranks


def _is_sample(places: np.ndarray) -> np.ndarray:
    return np.isin(places % MODULUS, COVER)


def sample_ranks(data: np.ndarray) -> np.ndarray:
    """Rank of the `DEPTH` bytes at each sample position, 0 elsewhere; bytes past the end are 0."""
    padded = np.concatenate([data, np.zeros(FIRST, np.uint8)])
    places = np.flatnonzero(_is_sample(np.arange(len(data))))
    words = np.zeros(len(places), np.uint64)
    for k in range(FIRST):
        words = (words << np.uint64(8)) | padded[places + k]
    ranks = np.zeros(len(data) + max(STEPS), np.uint64)
    ranks[places] = _ranks(words) + np.uint64(1)
    for step in STEPS:
        ranks[places] = _ranks((ranks[places] << np.uint64(32)) | ranks[places + step]) + np.uint64(1)
    return ranks[: len(data)]


def later_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether an equal window stands at an earlier of the ascending starts."""
    ranks = sample_ranks(data)
    later = np.zeros(len(starts), bool)
    for shift in range(MODULUS):
        mine = np.flatnonzero(_is_sample(starts + shift))
        at = starts[mine]
        key = ranks[at + shift]
        for k in (*range(shift), *range(shift + DEPTH, LENGTH)):
            key = (key << np.uint64(8)) | data[at + k]
        order = np.argsort(key, kind="stable")
        held = key[order]
        later[mine[order[1:][held[1:] == held[:-1]]]] = True
    return later


def _decided(sent: DataFrame, block: int) -> DataFrame:
    """(doc_id, text_key, begin, end): spans of later windows of the cells sent, bucket by bucket."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        # a repeated row sent its cells again
        rows = rows.filter(pa.array(_changes(rows, ["bucket", *_PLACE])))
        strings = _column(rows, "bytes")
        data, bounds = text_buffer(strings)
        count = np.diff(bounds) - LENGTH + 1
        owner = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        later = later_windows(data, bounds[owner] + within)
        # runs of later windows within a cell
        opens = later & np.concatenate([[True], ~later[:-1] | (owner[1:] != owner[:-1])])
        closes = later & np.concatenate([~later[1:] | (owner[1:] != owner[:-1]), [True]])
        at = pa.array(owner[opens])
        begin = rows.column("begin").to_numpy()[owner[opens]]
        columns = [_column(rows, c).take(at) for c in ("doc_id", "text_key")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(begin + within[opens]), pa.array(begin + within[closes] + 1)],
            ["doc_id", "text_key", "begin", "end"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _groups(batches, ["bucket"], block):
            yield spans(rows)

    ordered = sent.repartition("bucket").sortWithinPartitions("bucket", *_PLACE)
    return ordered.mapInArrow(work, f"doc_id {_kind(sent)}, text_key long, begin long, end long")


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def _with_list(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    held = lists.columns[-1]
    return docs.join(lists, _same(docs, lists), how).select(docs["doc_id"], docs["text_key"], "text", held)


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    with_bytes: bool = True,
    piece: int = PIECE,
    flush: int = FLUSH,
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept, the bytes left.

    NULL texts are empty; a NULL id comes before all others, ids are of any type that sorts.
    Rows alike in id and text are one document and get one result each; rows of one id and
    different texts follow each other by a hash of their text. `piece`, `flush`, `block` and `part`
    bound what a task holds: bytes of text worked on at once, cells settled at once, bytes of
    buckets sorted at once (sixteen times that of cells), different cells of a bucket that stay
    together; results do not depend on them.
    """
    if piece >= 1 << PLACE_BITS - 1:
        raise ValueError(f"piece must be below {1 << PLACE_BITS - 1}")
    scratch = session_scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_key"), whole.alias("text"))
    key = ["doc_id", "text_key"]
    judged = scratch.store(_judged(_cells(keyed, piece, flush), 16 * block))
    copies = judged.where("bucket IS NULL").select(*key, "begin", (F.col("begin") + F.col("n")).alias("end"))

    wanted = judged.where("bucket IS NOT NULL")
    large = wanted.groupBy("bucket").agg(F.count(F.lit(1)).alias("cells")).where(F.col("cells") > part)
    parts = F.coalesce(F.floor((F.col("cells") - 1) / part).cast("int") + 1, F.lit(1))
    wanted = wanted.join(large, "bucket", "left").select(*key, "begin", "n", "bucket", parts.alias("parts"))
    wanted = wanted.groupBy(*key).agg(F.collect_list(F.struct("begin", "n", "bucket", "parts")).alias("cells"))
    later = scratch.store(_decided(_sent(_with_list(keyed, wanted, "inner")), block))

    spans = copies.unionByName(later).groupBy(*key).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return _finish(_with_list(keyed, spans, "left"), with_bytes)


def _cleaned(text: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs and what is left, by spans of later windows."""
    edge = np.zeros(len(text) + 1, np.int32)
    np.add.at(edge, begins, 1)
    np.add.at(edge, ends + LENGTH - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
    return int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


def _finish(marked: DataFrame, with_bytes: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            at = held = 0

            def rows(at: int, batch: pa.RecordBatch = batch, out: list = out) -> pa.RecordBatch:
                ids = batch.column(0).slice(at, len(out[0]))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(out, types, strict=True))], _RESULT)

            bounds, (begins, ends) = _lists(batch, 2)
            for row, text in enumerate(batch.column(1)):
                whole = text.as_py().encode()
                mine = slice(bounds[row], bounds[row + 1])
                if bounds[row] < bounds[row + 1]:
                    removed, runs, kept = _cleaned(whole, begins[mine], ends[mine])
                else:
                    removed, runs, kept = 0, 0, whole
                for column, value in zip(out, (len(whole), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None), strict=True):
                    column.append(value)
                held += len(whole)
                if held > PIECE:
                    yield rows(at)
                    at += len(out[0])
                    held = 0
                    for column in out:
                        column.clear()
            if out[0]:
                yield rows(at)

    cleaned = marked.select("doc_id", "text", "spans").mapInArrow(
        work, f"doc_id {_kind(marked)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return cleaned if with_bytes else cleaned.drop("kept")


_RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
