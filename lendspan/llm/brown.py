"""Language-model scores of a Brown class bigram model.

A text is its lower-cased words and one end. Every training word has its own class, in two
steps. First units are clustered on the driver: each of the `CORE` most frequent words is
one, the others fall into `GROUPS` units by their last letters. From there every word moves
by itself: Spark counts, for all words, the classes that stand before and after them, and
in `BATCHES` hashed batches each word goes to the class that makes its neighbours' classes
most likely; the class totals follow after every batch. A word that training lacks takes
the class that most training words of its ending have. A token's probability is that of its class after
the class before it, times that of the word among its class:

    P(w | w') = P(c | c') (n(w) + 0.1) / (n(c) + 0.1 (v(c) + 1))

with n the counts and v the distinct words in training; c' is the end's class for the
first word. Counts cover all training texts and are gathered by Spark. Counts and classes of
the `FREQUENT` commonest words go to the tasks; rarer words of a document, once each, are
joined with the table of words.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import session_scratch
from .common import slices, string_texts, text_buffer

CORE = 1024
GROUPS = 255
CLASSES = 64
ROUNDS = 6
BATCHES = 4
# Tokens whose neighbours a task counts before it passes them on.
COUNTED = 2_000_000
# Distinct words that a task counts before it passes them on.
HELD = 300_000
# Counts of one word that are joined at once; a corpus with more goes through a step in between.
LISTS = 256
FREQUENT = 100_000
ADD = 0.1
# Weight of the class's overall share in the smoothed transition.
PRIOR = 5.0
END = 0
# Place of a word in a line whose class is not known yet.
OPEN = 255
# Words that a task passes on in one batch.
PASSED = 50_000


def held_out(doc_id: Column) -> Column:
    """Whether an id is in the fold that is not learned from; an unknown id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every lower-cased word of the texts in turn, and the distinct words by code."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(column))
    rows = np.repeat(np.arange(len(column)), split.value_lengths().to_numpy(zero_copy_only=False))
    found = split.flatten().dictionary_encode()
    words, codes = found.dictionary, found.indices.to_numpy().astype(np.int64)
    empty = pc.index(words, "").as_py()  # white space at either end of a text leaves an empty word there
    if empty >= 0:
        is_word = codes != empty
        rows, codes = rows[is_word], codes[is_word]
        codes -= codes > empty
        words = words.filter(pc.not_equal(words, ""))
    return rows, codes, words


def chained(rows: np.ndarray, numbers: np.ndarray, texts: int) -> np.ndarray:
    """The numbers of all words in one line, with an end before, between and after the texts."""
    line = np.full(len(numbers) + texts + 1, END, np.int64)
    line[np.arange(1, len(numbers) + 1) + rows] = numbers
    return line


def merged_words(parts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of several lists, and the place in them of each listed word."""
    found = pa.concat_arrays(parts).dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64)


def group_of(word: bytes) -> int:
    """Which of the groups a word outside the core belongs to, by its ending."""
    return zlib.crc32(word[-3:]) % GROUPS


class Units(dict):
    """Unit numbers of words, kept once asked for: the end is 0, then the core, then the groups."""

    def __init__(self, core: list[bytes]) -> None:
        self.core = {w: 1 + i for i, w in enumerate(core)}
        self.size = 1 + len(core) + GROUPS

    def __missing__(self, word: bytes) -> int:
        self[word] = unit = self.core.get(word) or 1 + len(self.core) + group_of(word)
        return unit

    def of(self, words: list[bytes]) -> list[int]:
        if len(self) > 300_000:
            self.clear()
        return [self[w] for w in words]

    def of_column(self, words: pa.Array) -> np.ndarray:
        """The same for a column of words; each ending among them is hashed once."""
        if not len(words):
            return np.zeros(0, np.int64)
        data, bounds = text_buffer(words)
        sizes = np.minimum(np.diff(bounds), 3)
        endings = sizes
        for back in (3, 2, 1):
            endings = endings * 256 + np.where(sizes >= back, data[np.maximum(bounds[1:] - back, 0)], 0)
        endings, place = np.unique(endings, return_inverse=True)
        groups = np.array([group_of((e & 0xFFFFFF).to_bytes(3)[3 - (e >> 24) :]) for e in endings.tolist()])
        core = pc.index_in(words, value_set=pa.array(list(self.core), pa.binary()).cast(pa.string()))
        core = core.fill_null(-1).to_numpy().astype(np.int64)
        return np.where(core >= 0, 1 + core, 1 + len(self.core) + groups[place])


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit by exchange clustering of the pair counts; the end keeps class 0 alone.

    Each round offers every unit, most frequent first, the class that makes the class
    bigrams most likely, until a round moves none.
    """
    size = len(pairs)
    order = np.argsort(-pairs.sum(0), kind="stable")
    order = order[order != END]
    assigned = np.zeros(size, np.int64)
    assigned[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.eye(classes)[assigned]
    after, before = pairs @ member, pairs.T @ member
    joint = member.T @ after
    for _ in range(rounds):
        moved = 0
        for unit in order:
            old, own = assigned[unit], pairs[unit, unit]
            out, into = after[unit].copy(), before[unit].copy()
            joint[old] -= out
            joint[:, old] -= into
            joint[old, old] += own
            out[old] -= own
            into[old] -= own
            held = _xlogx(joint)
            diagonal = np.diagonal(joint)
            rows = _xlogx(joint + out) - held
            columns = _xlogx(joint + into[:, None]) - held
            gain = rows.sum(1) - np.diagonal(rows) + columns.sum(0) - np.diagonal(columns)
            gain += _xlogx(diagonal + out + into + own) - _xlogx(diagonal)
            for total, more in ((joint.sum(1), out.sum() + own), (joint.sum(0), into.sum() + own)):
                gain -= _xlogx(total + more) - _xlogx(total)
            gain[END] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            joint[new] += out
            joint[:, new] += into
            joint[new, new] += own
            if new != old:
                moved += 1
                assigned[unit] = new
                after[:, old] -= pairs[:, unit]
                after[:, new] += pairs[:, unit]
                before[:, old] -= pairs[unit]
                before[:, new] += pairs[unit]
        if not moved:
            break
    return assigned


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; a task sums its texts and passes on HELD words at a time."""

    def merged(held: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
        words, places = merged_words([w for w, _ in held])
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, places, np.concatenate([n for _, n in held]))
        return words, counts

    def rows(words: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(words), PASSED):
            part = [words.slice(at, PASSED), pa.array(counts[at : at + PASSED])]
            yield pa.RecordBatch.from_arrays(part, ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(pa.RecordBatch.from_arrays([string_texts(batch, 0)], ["text"]), 0):
                _, codes, words = coded(part.column(0))
                held.append((words, np.bincount(codes, minlength=len(words))))
                size += len(words)
                if size > HELD:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from rows(*held[0])
                        held, size = [], 0
        if held:
            yield from rows(*merged(held))

    return docs.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, core: list[bytes]) -> DataFrame:
    """(pair, n): counts of neighbouring units, pair = left * units + right; one row per pair and task shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(core)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(shared.value)
        total = np.zeros(units.size * units.size, np.int64)
        for batch in batches:
            for part in slices(pa.RecordBatch.from_arrays([string_texts(batch, 0)], ["text"]), 0):
                rows, codes, words = coded(part.column(0))
                line = chained(rows, units.of_column(words)[codes], part.num_rows)
                total += np.bincount(line[:-1] * units.size + line[1:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["pair", "n"])

    counted = docs.select("text").mapInArrow(work, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def salts(total: int) -> int:
    """Groups that the counts of one word are summed in first, in a corpus of `total` tokens.

    A word comes once for every COUNTED tokens. Up to LISTS of these are joined at once; of
    more, F in number, the root of F are, first within each group and then across groups.
    """
    flushes = total // COUNTED + 1
    return 1 if flushes <= LISTS else math.isqrt(flushes - 1) + 1


def neighbours(docs: DataFrame, core: list[bytes], assigned: np.ndarray, total: int) -> DataFrame:
    """(word, class, codes, times): a word's first class and how often which class stands beside it.

    A code is the class after the word, or CLASSES more than the class before it. Every word
    has a single row with each of its codes once, so at most twice CLASSES. `total` is the
    number of tokens; it decides how many rows of a word meet at once, not what they add up to.
    Rows of a word come sorted to the task that adds them, each with its counts in one field
    (times * 2 * CLASSES + code, 8 bytes an entry), so a task holds those of one batch.
    """
    shared = docs.sparkSession.sparkContext.broadcast((core, assigned))

    def packed(names: pa.Array, owners: np.ndarray, entries: np.ndarray, flush: int) -> Iterator[pa.RecordBatch]:
        bounds = np.searchsorted(owners, np.arange(len(names) + 1))
        for at in range(0, len(names), PASSED):
            own = bounds[at : at + PASSED + 1]
            offsets = (8 * (own - own[0])).astype(np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(entries[own[0] : own[-1]].copy())]
            counts = pa.Array.from_buffers(pa.binary(), len(own) - 1, buffers)
            flushes = pa.array(np.full(len(own) - 1, flush, np.int32))
            yield pa.RecordBatch.from_arrays([names.slice(at, PASSED), counts, flushes], ["word", "counts", "flush"])

    def counted(held: list[tuple[np.ndarray, np.ndarray, pa.Array, int]], units: Units, flush: int) -> Iterator[pa.RecordBatch]:
        names, places = merged_words([words for _, _, words, _ in held])
        classes = shared.value[1][[END, *units.of_column(names)]]
        keys, at = [], 0
        for rows, codes, words, texts in held:
            line = chained(rows, places[at + codes] + 1, texts)
            at += len(words)
            left, right = line[:-1], line[1:]
            keys += [left * 2 * CLASSES + classes[right], right * 2 * CLASSES + CLASSES + classes[left]]
        keys = np.concatenate(keys)
        keys, times = np.unique(keys[keys >= 2 * CLASSES], return_counts=True)
        owners, codes = np.divmod(keys, 2 * CLASSES)
        return packed(names, owners - 1, times * 2 * CLASSES + codes, flush)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(shared.value[0])
        held, size, flush = [], 0, 0
        for batch in batches:
            for part in slices(pa.RecordBatch.from_arrays([string_texts(batch, 0)], ["text"]), 0):
                rows, codes, words = coded(part.column(0))
                held.append((rows, codes, words, part.num_rows))
                size += len(codes) + part.num_rows
                if size > COUNTED:
                    yield from counted(held, units, flush)
                    held, size, flush = [], 0, flush + 1
        if held:
            yield from counted(held, units, flush)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """Words, owners and entries with the rows of a word in turn added up; a word that may go on waits."""
        word, waiting = pa.array([], pa.string()), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            words = pa.concat_arrays([word, batch.column(0).cast(pa.string())])
            data, bounds = text_buffer(batch.column(1).cast(pa.binary()))
            lengths = np.diff(bounds) // 8
            if len(word):
                lengths = np.concatenate([[len(waiting)], lengths])
            entries = np.concatenate([waiting, np.frombuffer(data.tobytes(), np.int64)])
            new = np.ones(len(words), bool)
            new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            owners = np.repeat(np.cumsum(new) - 1, lengths)
            times, codes = np.divmod(entries, 2 * CLASSES)
            keys, place = np.unique(owners * 2 * CLASSES + codes, return_inverse=True)
            times = np.bincount(place, times, len(keys)).astype(np.int64)
            owners, codes = np.divmod(keys, 2 * CLASSES)
            entries = times * 2 * CLASSES + codes
            words = words.filter(pa.array(new))
            done = np.searchsorted(owners, len(words) - 1)
            if len(words) > 1:
                yield words.slice(0, len(words) - 1), owners[:done], entries[:done]
            word, waiting = words.slice(len(words) - 1), entries[done:]
        if len(word):
            yield word, np.zeros(len(waiting), np.int64), waiting

    def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, owners, entries in added(batches):
            for batch in packed(words, owners, entries, 0):
                yield batch.select(["word", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(shared.value[0])
        for words, owners, entries in added(batches):
            times, codes = np.divmod(entries, 2 * CLASSES)
            bounds = np.searchsorted(owners, np.arange(len(words) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x, t)) for x, t in ((codes, pa.int16()), (times, pa.int64()))]
            classes = pa.array(shared.value[1][units.of_column(words)], pa.int32())
            yield pa.RecordBatch.from_arrays([words, classes, *lists], ["word", "class", "codes", "times"])

    rows = docs.select("text").mapInArrow(work, "word string, counts binary, flush int")
    many = salts(total)
    if many > 1:
        salt = F.pmod(F.spark_partition_id() + F.col("flush"), F.lit(many)).alias("salt")
        spread = rows.select("word", "counts", salt).repartition("salt", "word").sortWithinPartitions("salt", "word")
        rows = spread.select("word", "counts").mapInArrow(salted, "word string, counts binary")
    together = rows.select("word", "counts").repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(merged, "word string, class int, codes array<short>, times array<long>")


def _entries(codes: pa.ListArray, times: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and count of all entries of two list columns."""
    lengths = codes.value_lengths().to_numpy(zero_copy_only=False)
    owners = np.repeat(np.arange(len(codes)), lengths)
    return owners, codes.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy().astype(np.float64)


def best_classes(old: np.ndarray, owners: np.ndarray, codes: np.ndarray, times: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Class of each word that makes the classes beside it most likely, given the others' `totals`.

    totals[c, code] counts what stands beside the words of class c, these words included. A
    word stays where no class is better; the end's class takes none.
    """
    if not len(old):
        return old
    starts = np.searchsorted(owners, np.arange(len(old)))
    n = np.add.reduceat(np.where(codes < CLASSES, times, 0.0), starts)
    beside, size = np.ascontiguousarray(totals.T), totals[:, :CLASSES].sum(1)
    rows = np.arange(len(old))
    step = lambda held, more: _xlogx(held + more) - _xlogx(held)
    known = _xlogx(beside)
    gain = np.add.reduceat(_xlogx(beside[codes] + times[:, None]) - known[codes], starts)
    gain -= 2 * step(size[None, :], n[:, None])
    held = np.maximum(beside[codes, old[owners]] - times, 0.0)
    gain[rows, old] = np.add.reduceat(step(held, times), starts) - 2 * step(np.maximum(size[old] - n, 0.0), n)
    gain[:, END] = -np.inf
    new = gain.argmax(1)
    return np.where(gain[rows, new] > gain[rows, old] + 1e-9, new, old)


def move_words(found: DataFrame, totals: np.ndarray, batch: int) -> DataFrame:
    """The words of a batch as (word, n, class), and rows (at, change) of what their moves change in `totals`."""
    shared = found.sparkSession.sparkContext.broadcast(totals)
    names = ["word", "n", "class", "at", "change"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = np.zeros(2 * CLASSES * CLASSES)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                part = whole.slice(at, 2000)
                old = part.column(1).to_numpy().astype(np.int64)
                owners, codes, times = _entries(part.column(2), part.column(3))
                new = best_classes(old, owners, codes, times, shared.value)
                n = np.bincount(owners, np.where(codes < CLASSES, times, 0.0), len(old)).astype(np.int64)
                change += np.bincount(new[owners] * 2 * CLASSES + codes, times, len(change))
                change -= np.bincount(old[owners] * 2 * CLASSES + codes, times, len(change))
                none = [pa.nulls(len(old), t) for t in (pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(new, pa.int32()), *none], names)
        at = np.flatnonzero(change)
        none = [pa.nulls(len(at), t) for t in (pa.string(), pa.int64(), pa.int32())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int32()), pa.array(change[at].astype(np.int64))], names)

    mine = F.pmod(F.xxhash64("word"), F.lit(BATCHES)) == batch
    return found.where(mine).mapInArrow(work, "word string, n long, class int, at int, change long")


class Classes:
    """Classes and counts of words as far as a task needs them: those of the frequent ones."""

    def __init__(self, frequent: dict[bytes, tuple[float, int]], groups: np.ndarray) -> None:
        self.frequent, self.groups = frequent, groups

    def columns(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The frequent words, and their logs and classes with those of a rarer word last."""
        logs, classes = zip(*self.frequent.values(), strict=True) if self.frequent else ((), ())
        words = pa.array(list(self.frequent), pa.binary()).cast(pa.string())
        return words, np.array([*logs, 0.0]), np.array([*classes, OPEN], np.uint8)


def cluster(training: DataFrame, scratch) -> tuple[Classes, DataFrame]:
    """Classes of the training words, and all of them as (word, n, class)."""
    counts = word_counts(training)
    core = [r.word.encode() for r in counts.orderBy(F.desc("n"), "word").limit(CORE).collect()]
    size = Units(core).size
    pairs = np.zeros(size * size)
    for r in pair_counts(training, core).toArrow().to_batches():
        pairs[r.column(0).to_numpy()] = r.column(1).to_numpy()
    pairs = pairs.reshape(size, size)
    assigned = exchange(pairs)
    member = np.eye(CLASSES)[assigned]
    joint = member.T @ pairs @ member
    totals = np.concatenate([joint, joint.T], axis=1)
    found = scratch.store(neighbours(training, core, assigned, int(pairs.sum())))
    moved = []
    for batch in range(BATCHES):
        moved.append(scratch.store(move_words(found, totals, batch)))
        for r in moved[-1].where("at IS NOT NULL").groupBy("at").agg(F.sum("change").alias("change")).collect():
            totals[divmod(r.at, 2 * CLASSES)] += r.change
    scratch.drop(found)
    words = moved[0]
    for more in moved[1:]:
        words = words.unionByName(more)
    words = words.where("word IS NOT NULL").select("word", "n", "class")
    top = words.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    group = F.crc32(F.expr("substr(cast(word AS binary), -3)")) % GROUPS
    per_group = words.groupBy(group.alias("group"), "class").agg(F.count(F.lit(1)).alias("types")).collect()
    groups = assigned[1 + len(core) :].copy()
    for r in sorted(per_group, key=lambda r: (r.types, -r["class"])):
        groups[r.group] = r["class"]
    return Classes({r.word.encode(): (math.log10(r.n + ADD), r["class"]) for r in top}, groups), words


def read_lines(docs: DataFrame, classes: Classes, words: DataFrame, scratch) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, known, logs and line, the class of each word as a byte."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, log_of, class_of = shared.value.columns()
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for part in slices(batch, 1):
                n, (rows, codes, words) = part.num_rows, coded(part.column(1))
                entry = pc.index_in(words, value_set=frequent).fill_null(len(frequent)).to_numpy()[codes]
                line, is_open = class_of[entry], entry == len(frequent)
                sizes = np.bincount(rows, minlength=n)
                # a rarer word of a text is listed once; the open places say which of the list they hold
                listed, place, times = np.unique(
                    rows[is_open] * len(words) + codes[is_open], return_inverse=True, return_counts=True
                )
                owners, listed = np.divmod(listed, max(1, len(words)))
                rare = np.searchsorted(owners, np.arange(n + 1))
                opened = np.searchsorted(rows[is_open], np.arange(n + 1))
                places = place - rare[rows[is_open]]
                ends = np.cumsum([0, *sizes]).astype(np.int32)
                entries = pa.StructArray.from_arrays([words.take(pa.array(listed)), pa.array(times)], ["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes + 1),
                        pa.array(np.bincount(rows, ~is_open, n).astype(np.int64)),
                        pa.array(np.bincount(rows, log_of[entry], n)),
                        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(line)]),
                        pa.ListArray.from_arrays(pa.array(opened, pa.int32()), pa.array(places, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(rare, pa.int32()), entries),
                    ],
                    ["doc_id", "n_tokens", "known", "logs", "line", "places", "rare"],
                )

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n_tokens, known, logs, lines, places, rarer = (
                batch.column(c) for c in ("doc_id", "n_tokens", "known", "logs", "line", "places", "rarer")
            )
            lines = lines.cast(pa.binary())
            line, ends = text_buffer(lines)
            line = line.copy()
            listed, opened = (pc.fill_null(pc.list_value_length(c), 0).to_numpy() for c in (rarer, places))
            starts, rows = np.cumsum(listed) - listed, np.arange(len(lines))
            entries = rarer.flatten().to_numpy()
            of = np.zeros(len(entries), np.uint8)
            of[np.repeat(starts, listed) + entries // CLASSES] = entries % CLASSES
            line[line == OPEN] = of[starts[np.repeat(rows, opened)] + places.flatten().to_numpy()]
            whole = pa.Array.from_buffers(
                pa.binary(), len(lines), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(line)]
            )
            yield pa.RecordBatch.from_arrays([doc, n_tokens, known, logs, whole], ["doc_id", "n_tokens", "known", "logs", "line"])

    partial = docs.select("doc_id", "text").mapInArrow(
        work,
        f"doc_id {kind}, n_tokens long, known long, logs double, line binary, places array<int>, "
        "rare array<struct<word:string,times:long>>",
    )
    partial = scratch.store(partial.withColumn("row", F.monotonically_increasing_id()))
    unseen = F.element_at(
        F.array(*[F.lit(int(c)) for c in classes.groups]),
        (F.crc32(F.expr("substr(cast(word AS binary), -3)")) % GROUPS + 1).cast("int"),
    )
    rarer = (
        partial.select("row", F.posexplode("rare").alias("place", "r"))
        .select("row", "place", "r.word", "r.times")
        .join(words, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("more_logs"),
            F.collect_list(F.col("place").cast("long") * CLASSES + F.coalesce("class", unseen)).alias("rarer"),
        )
    )
    whole = (
        partial.drop("rare")
        .join(rarer, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("known"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"),
            "line",
            "places",
            "rarer",
        )
        .mapInArrow(filled, f"doc_id {kind}, n_tokens long, known long, logs double, line binary")
    )
    stored = scratch.store(whole)
    scratch.drop(partial)
    return stored


def _ended(lines: pa.Array) -> np.ndarray:
    """All lines one after the other, with the end's class before, between and after them."""
    end = bytes([END])
    return np.frombuffer(end + end.join(lines.to_pylist()) + end, np.uint8).astype(np.int64)


def class_pairs(lines: DataFrame) -> np.ndarray:
    """How often which class follows which in the lines."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            if batch.num_rows:
                line = _ended(batch.column(0))
                total += np.bincount(line[:-1] * CLASSES + line[1:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["pair", "n"])

    joint = np.zeros((CLASSES, CLASSES))
    counted = lines.select("line").mapInArrow(work, "pair long, n long")
    for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        joint[divmod(r.pair, CLASSES)] = r.n
    return joint


class Model:
    """Probabilities of classes, and the classes of words as far as tasks hold them."""

    def __init__(self, classes: Classes, words: DataFrame, joint: np.ndarray) -> None:
        n_docs = int(joint[:, END].sum())
        types = np.zeros(CLASSES)
        for r in words.groupBy("class").agg(F.count(F.lit(1)).alias("types")).collect():
            types[r["class"]] = r.types
        types[END] = n_docs > 0
        share = joint.sum(0) / max(1.0, joint.sum())
        self.transition = np.log10((joint + PRIOR * share + 1e-9) / (joint.sum(1, keepdims=True) + PRIOR + 1e-9 * CLASSES))
        self.size = np.log10(joint.sum(0) + ADD * (types + 1))
        self.core = list(classes.frequent)
        self.assigned = np.array([END, *[c for _, c in classes.frequent.values()], *classes.groups])
        self.n_total = int(joint.sum())
        self.base = math.log10(self.n_total + ADD * (types.sum() + 1))
        self.end_log = math.log10(n_docs + ADD)
        self.end_known = int(n_docs > 0)


def learn(training: DataFrame, scratch) -> tuple[Model, DataFrame]:
    """The model of the training texts, and their words with counts and classes."""
    classes, words = cluster(training, scratch)
    return Model(classes, words, class_pairs(read_lines(training, classes, words, scratch))), words


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    NULL texts are empty and have their end alone; every row gives a row, repeated rows
    too. Without any training text nothing is known and all tokens are equally unlikely.
    """
    scratch = session_scratch(docs.sparkSession)
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    classes, words = cluster(chosen.where(~held_out(F.col("doc_id"))), scratch)
    lines = read_lines(chosen, classes, words, scratch)
    model = Model(classes, words, class_pairs(lines.where(~held_out(F.col("doc_id")))))
    step = model.transition - model.size
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            line = _ended(batch.column(4))
            starts = np.cumsum([0, *batch.column(1).to_pylist()[:-1]])
            chain = np.add.reduceat(step[line[:-1], line[1:]], starts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(chain)], ["doc_id", "n_tokens", "known", "logs", "chain"])

    chained = lines.mapInArrow(work, f"doc_id {kind}, n_tokens long, known long, logs double, chain double")
    logs = F.col("logs") + F.lit(model.end_log)
    return chained.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.lit(model.end_known)).cast("long").alias("n_known"),
        F.lit(model.n_total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(model.base)).alias("base_score"),
        (logs + F.col("chain")).alias("score"),
    )
