"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece model (B).

Both tokenizers read a space and the text. Where an A token and a B token end at the same
byte the text is cut into groups; an A and a B token whose bytes overlap are linked.

Spans give coarse cuts: the character offsets of `tokenizers` and the spans of the
sentencepiece proto (version 0.2.3 replaced the immutable proto by `proto`, with spans in
bytes). A span end counts only where the next span begins, so tokens that share a
character, and byte pieces with an empty span, are no cut. Between two coarse cuts the ends
are refined with the decoded bytes of the tokens.

A single space between two other characters that are no white space always starts a token
of both (checked on the vocabulary), so a text is encoded word by word, and a bounded memory
keeps the words that repeat, over the tasks of a Python worker. Where this can't be proven, whole texts are encoded.

Corpus counts of linked id pairs go in two steps: each task hands on blocks of some MB with
their distinct pairs and counts, the counts of all blocks are summed in Spark, and each block
gets back the totals of its own pairs. What is shuffled beside the pairs of the blocks is one
small number a link.
"""

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import session_scratch
from .common import slices, string_texts
from .tokens import BYTE_CHARACTERS

SPACE_PIECE = "▁"
# Bytes of text whose links form one block, characters encoded at a time, links remembered.
BLOCK_BYTES = 8 << 20
PIECE_CHARS = 1 << 20
MEMORY = 4_000_000
# New words encoded as one text.
JOINED = 400
# A document with more links than this hands on its distinct pairs with counts.
LONG = 1 << 20

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def bytes_of_a(tokenizer: Tokenizer) -> list[bytes]:
    """Decoded bytes per id of a byte-level vocabulary; added tokens are their own text."""
    back = {c: b for b, c in BYTE_CHARACTERS.items()}
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    table = [b""] * (max(tokenizer.get_vocab().values()) + 1)
    for entry, i in tokenizer.get_vocab().items():
        table[i] = added[i].encode() if i in added else bytes(back[c] for c in entry)
    return table


def bytes_of_b(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Decoded bytes per id: a byte piece is its byte, else UTF-8 with the space piece as a space."""
    table = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        byte = _BYTE_PIECE.fullmatch(piece) if processor.is_byte(i) else None
        table.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_PIECE, " ").encode())
    return table


def words_stand_alone(tokenizer: Tokenizer, processor: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether neither tokenizer can join what stands before and after a lone space.

    B: no piece has a space after another character, so no merge reaches over a space.
    A: plain byte-level pre-tokens, which begin at such a space, and no normaliser.
    """
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    joined = any(SPACE_PIECE in piece.lstrip(SPACE_PIECE) for piece in pieces)
    plain = str(tokenizer.pre_tokenizer).startswith("ByteLevel(") and "use_regex=True" in str(tokenizer.pre_tokenizer)
    return not joined and plain and tokenizer.normalizer is None


def _pieces(text: str, limit: int) -> Iterator[list[str]]:
    """The words of a text, in lists of about `limit` characters."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if not cut:
            break
        yield _CUT.split(text[start : cut.start()])
        start = cut.end()
    yield _CUT.split(text[start:] if start else text)


class Aligner:
    """Aligns texts; keeps the alignment of words seen, until their links pass `MEMORY`."""

    def __init__(self, definition: str, model: bytes) -> None:
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a, self.bytes_b = bytes_of_a(self.a), bytes_of_b(self.b)
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.n_b = len(self.bytes_b)
        self.alone = words_stand_alone(self.a, self.b)
        # the text of an id followed by each separator
        ids = range(max(len(self.bytes_a), self.n_b))
        self.written = [f"{i}{mark}" for i in ids for mark in ",|;"]
        self.forget()
        self.forget_pairs()

    def forget(self) -> None:
        """Forget the words; pairs keep their numbers."""
        self.known: dict[str, int] = {}
        self.strings: list[str] = []
        # per word: tokens of A, tokens of B, groups, links, 1 if its bytes differ
        self.sizes = np.zeros((0, 5), np.int64)
        # numbers of the pairs linked, word by word
        self.numbers = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def forget_pairs(self) -> None:
        """Number the pairs anew; only between blocks, whose documents hold the numbers."""
        self.forget()
        self.pairs = np.zeros(0, np.int64)
        # the same in sorted order, and their numbers
        self.sorted = np.zeros(0, np.int64)
        self.number = np.zeros(0, np.int32)

    def words(self, text: str) -> Iterator[list[str]]:
        return _pieces(text, PIECE_CHARS) if self.alone else iter([[text]])

    def learn(self, words: Iterable[list[str]]) -> None:
        """Add the alignment of new words.

        They are encoded many at a time, as one text, where they stand alone in it too. If its
        bytes do not come back, its words are tried one by one.
        """
        fresh = list(set().union(*words).difference(self.known))
        joined = [w for w in fresh if self.alone and w and not (w[0].isspace() or w[-1].isspace())]
        single = [[w] for w in set(fresh).difference(joined)]
        texts = [joined[at : at + JOINED] for at in range(0, len(joined), JOINED)]
        for some, step in ((texts, 50), (single, 20_000)):
            for at in range(0, len(some), step):
                failed = self._learn(some[at : at + step])
                if failed:
                    self._learn([[w] for t in failed for w in t])

    def _learn(self, texts: list[list[str]]) -> list[list[str]]:
        """Add the words of some texts; returns texts of several words whose bytes differ."""
        spaced = [" " + " ".join(t) for t in texts]
        raw = [t.encode() for t in spaced]
        a = self.a.encode_batch(spaced, add_special_tokens=False)
        ids_a = [e.ids for e in a]
        n_a = np.array([len(i) for i in ids_a], np.int64)
        flat_a = np.fromiter(chain.from_iterable(ids_a), np.int64, n_a.sum())
        offsets = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in a)), np.int64, 2 * n_a.sum())
        b = [t.pieces for t in self.b.encode([t[1:] for t in spaced], return_type="proto", num_threads=1)]
        n_b = np.array([len(t) for t in b], np.int64)
        told = (v for t in b for p in t for v in (p.id, p.begin, p.end))
        flat_b, *spans = np.fromiter(told, np.int64, 3 * n_b.sum()).reshape(-1, 3).T
        good = self._same(raw, flat_a, n_a, self.bytes_a) & self._same(raw, flat_b, n_b, self.bytes_b)
        kept = np.flatnonzero(good).tolist()
        if kept:
            in_a, in_b = np.repeat(good, n_a), np.repeat(good, n_b)
            n_a, n_b, flat_a, flat_b = n_a[good], n_b[good], flat_a[in_a], flat_b[in_b]
            raw = [raw[k] for k in kept]
            base = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
            spans_a = self._spans_a(offsets.reshape(-1, 2)[in_a], [spaced[k] for k in kept], b"".join(raw), n_a)
            spans_b = self._spans_b(np.stack(spans, axis=1)[in_b], base, n_b)
            words = [w for k in kept for w in texts[k]]
            self._add(words, flat_a, flat_b, *self._ends(flat_a, flat_b, spans_a, spans_b))
        bad = [t for t, same in zip(texts, good.tolist(), strict=True) if not same]
        for (word,) in (t for t in bad if len(t) == 1):
            self._remember([word], [""], np.array([[0, 0, 0, 0, 1]]), np.zeros(0, np.int32))
        return [t for t in bad if len(t) > 1]

    def _add(self, words: list[str], ids_a, ids_b, ends_a, ends_b) -> None:
        """Add words that stand one after the other, each behind a space."""
        base = np.concatenate(([0], np.cumsum([len(w.encode()) + 1 for w in words])))
        in_a, in_b = _marked(ends_a, base[-1]), _marked(ends_b, base[-1])
        # each stretch between neighbouring ends belongs to one token of each side
        cuts = np.flatnonzero(in_a | in_b)
        shared_a, shared_b = in_b[ends_a], in_a[ends_b]
        codes = ids_a[_before(in_a[cuts])] * self.n_b + ids_b[_before(in_b[cuts])]
        of_word = lambda ends: np.diff(np.searchsorted(ends, base, side="right"))
        sizes = [of_word(ends) for ends in (ends_a, ends_b, ends_a[shared_a], cuts)]
        sizes = np.stack([*sizes, np.zeros(len(words), np.int64)], axis=1)
        self._remember(words, self._texts(ids_a, ids_b, shared_a, shared_b, sizes), sizes, self._numbers(codes))

    def _numbers(self, codes: np.ndarray) -> np.ndarray:
        """The number of each pair; new pairs get the next ones."""
        distinct, at = np.unique(codes, return_inverse=True)
        place = np.searchsorted(self.sorted, distinct)
        new = np.append(self.sorted, -1)[place] != distinct
        fresh = distinct[new]
        added = np.arange(len(self.pairs), len(self.pairs) + len(fresh), dtype=np.int32)
        self.pairs = np.concatenate((self.pairs, fresh))
        self.sorted = np.insert(self.sorted, place[new], fresh)
        self.number = np.insert(self.number, place[new], added)
        return self.number[place + _before(new)][at]

    def _remember(self, words: list[str], strings: Iterable[str], sizes: np.ndarray, numbers: np.ndarray) -> None:
        start = len(self.strings)
        self.known.update(zip(words, range(start, start + len(words)), strict=True))
        self.strings.extend(strings)
        self.sizes = np.concatenate((self.sizes, sizes))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes[:, 3])))
        self.numbers = np.concatenate((self.numbers, numbers))

    @staticmethod
    def _same(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, table: list[bytes]) -> np.ndarray:
        """Per word: whether the joined bytes of its tokens are its bytes."""
        tokens = [table[i] for i in ids.tolist()]
        ends = np.cumsum(counts).tolist()
        starts = [0, *ends[:-1]]
        return np.array([b"".join(tokens[s:e]) == r for s, e, r in zip(starts, ends, raw, strict=True)], bool)

    @staticmethod
    def _spans_a(offsets: np.ndarray, texts: list[str], raw: bytes, n_a: np.ndarray) -> np.ndarray:
        """Byte spans (begin, end) of A tokens from their character offsets, one text after the other."""
        chars = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        places = offsets + np.repeat(chars[:-1], n_a)[:, None]
        data = np.frombuffer(raw, np.uint8)
        begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        return begins[places]

    @staticmethod
    def _spans_b(spans: np.ndarray, base: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Byte spans of B pieces; the space that B adds belongs to the first piece."""
        spans = spans + 1 + np.repeat(base[:-1], n_b)[:, None]
        spans[np.concatenate(([0], np.cumsum(n_b)[:-1])), 0] = base[:-1]
        return spans

    def _ends(self, ids_a, ids_b, spans_a, spans_b) -> tuple[np.ndarray, np.ndarray]:
        """The byte at which each token ends: coarse cuts by spans, refined by decoded bytes."""
        n = max(spans_a[-1, 1], spans_b[-1, 1])
        common = _marked(_span_cuts(spans_a), n) & _marked(_span_cuts(spans_b), n)
        up_to = np.cumsum(common, dtype=np.int32)
        starts = np.concatenate(([0], np.flatnonzero(common)))
        refined = []
        for ids, spans, length in ((ids_a, spans_a, self.length_a), (ids_b, spans_b, self.length_b)):
            stretch = up_to[spans[:, 0]]
            sums = np.cumsum(length[ids])
            opens = np.flatnonzero(np.diff(stretch, prepend=-1))
            before = np.repeat(sums[opens] - length[ids[opens]], np.diff(np.append(opens, len(ids))))
            refined.append(starts[stretch] + sums - before)
        return refined[0], refined[1]

    def _texts(self, ids_a, ids_b, shared_a, shared_b, sizes) -> Iterator[str]:
        """Per word its groups as `a1,a2|b1;a3|b2,b3;`."""
        # tokens of each side before each group, and before the end
        to_a, to_b = (np.append(0, np.flatnonzero(ends) + 1) for ends in (shared_a, shared_b))
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        written[np.arange(len(ids_a)) + to_b[_before(shared_a)]] = 3 * ids_a + shared_a
        written[np.arange(len(ids_b)) + to_a[_before(shared_b) + 1]] = 3 * ids_b + 2 * shared_b
        table = self.written
        parts = [table[k] for k in written.tolist()]
        start = 0
        for end in np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist():
            yield "".join(parts[start:end])
            start = end


def _marked(places: np.ndarray, n: int) -> np.ndarray:
    """Whether each of 0 to n is among the places."""
    marks = np.zeros(n + 1, bool)
    marks[places] = True
    return marks


def _before(marks: np.ndarray) -> np.ndarray:
    """Per entry the number of marks before it."""
    return np.cumsum(marks) - marks


def _span_cuts(spans: np.ndarray) -> np.ndarray:
    """Ends of spans at which the next span begins and that end a whole character."""
    meets = np.append(spans[1:, 0] == spans[:-1, 1], True)
    return spans[meets & (spans[:, 1] > spans[:, 0]), 1]


class _Document:
    """What is gathered of one document over its pieces."""

    def __init__(self, doc_id: object, with_groups: bool) -> None:
        self.doc_id = doc_id
        self.sizes = np.zeros(5, np.int64)
        self.digest = hashlib.sha256()
        self.ahead = ""
        self.groups: list[str] | None = [] if with_groups else None
        self.numbers: list[np.ndarray] = []
        self.times: np.ndarray | None = None

    def add(self, sizes: np.ndarray, text: str, numbers: np.ndarray) -> None:
        self.sizes += sizes
        written = self.ahead + text[:-1]
        self.ahead = text[-1:]
        self.digest.update(written.encode())
        if self.groups is not None:
            self.groups.append(written)
        self.numbers.append(numbers)
        if self.sizes[3] > LONG:
            self._gather()

    def _gather(self) -> None:
        """Distinct pairs with counts, as a very long document would hold every link."""
        held = self.numbers if self.times is None else self.numbers[1:]
        sums = np.bincount(np.concatenate(held), minlength=1 + max(int(n.max(initial=0)) for n in self.numbers))
        if self.times is not None:
            sums[self.numbers[0]] += self.times
        distinct = np.flatnonzero(sums)
        self.numbers, self.times = [distinct.astype(np.int32)], sums[distinct]

    def links(self) -> tuple[np.ndarray, np.ndarray | None]:
        """Numbers of the pairs linked, one a link, or distinct ones with their counts."""
        if self.sizes[4] or not self.numbers:
            return np.zeros(0, np.int32), None
        return np.concatenate(self.numbers), self.times


def _aligned(aligner: Aligner, part: pa.RecordBatch, with_groups: bool) -> list[_Document]:
    """The documents of some rows (doc_id, text)."""
    documents, pending, held = [], [], 0
    if len(aligner.pairs) > MEMORY // 4:
        aligner.forget_pairs()

    def settle() -> None:
        nonlocal pending, held
        if not pending:
            return
        if len(aligner.numbers) > MEMORY:
            aligner.forget()
        aligner.learn(words for _, words in pending)
        known, strings = aligner.known, aligner.strings
        ids = [[known[w] for w in words] for _, words in pending]
        counts = np.array([len(i) for i in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
        found = aligner.sizes[flat]
        sizes = np.add.reduceat(found, np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0)
        n_links = found[:, 3]
        place = np.repeat(aligner.first[flat] - np.cumsum(n_links) + n_links, n_links) + np.arange(n_links.sum())
        numbers = aligner.numbers[place]
        ends = np.cumsum(sizes[:, 3])
        for k, (document, _) in enumerate(pending):
            written = "".join([strings[w] for w in ids[k]])
            document.add(sizes[k], written, numbers[ends[k] - sizes[k, 3] : ends[k]])
        pending, held = [], 0

    for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
        document = _Document(doc_id, with_groups)
        documents.append(document)
        for words in aligner.words(text) if text else ():
            pending.append((document, words))
            held += sum(map(len, words))
            if held >= PIECE_CHARS:
                settle()
    settle()
    return documents


def _block_rows(documents: list[_Document], pairs: np.ndarray, block: int, with_groups: bool) -> list[dict]:
    """One row per document; the first carries the distinct pairs of the block with counts."""
    found = [d.links() for d in documents]
    single = [n for n, times in found if times is None]
    sums = np.bincount(np.concatenate([np.zeros(0, np.int32), *single]), minlength=len(pairs))
    for numbers, times in found:
        if times is not None:
            sums[numbers] += times
    # the commonest pairs get the smallest ranks, which take the least room
    order = np.flatnonzero(sums)
    order = order[np.argsort(-sums[order], kind="stable")]
    rank = np.zeros(len(pairs), np.uint16 if len(order) <= 1 << 16 else np.uint32)
    rank[order] = np.arange(len(order))
    rows = []
    for document, (own, counts) in zip(documents, found, strict=True):
        bad = bool(document.sizes[4]) or not document.sizes[0]
        n_a, n_b, n_groups, n_links = (0, 0, 0, 0) if bad else document.sizes[:4].tolist()
        rows.append(
            {
                "block": block, "doc_id": document.doc_id, "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                "n_links": n_links, "groups_sha256": "" if bad else document.digest.hexdigest(),
                "width": rank.itemsize, "links": rank[own].tobytes(),
                "times": b"" if counts is None else counts.tobytes(), "codes": None, "counts": None,
            }
        )
        if with_groups:
            rows[-1]["groups"] = "" if bad else "".join(document.groups)
    rows[0]["codes"], rows[0]["counts"] = pairs[order], sums[order]
    return rows


@lru_cache(maxsize=1)
def _kept_aligner(definition: str, model: bytes) -> Aligner:
    """The aligner of this Python worker, whose memory of words serves its next tasks too."""
    return Aligner(definition, model)


def _blocks(docs: DataFrame, a_path: str, b_path: str, doc_id: str, text: str, with_groups: bool) -> DataFrame:
    """Rows of documents by block, as `_block_rows` gives them."""
    with open(a_path, encoding="utf-8") as file:
        definition = file.read()
    with open(b_path, "rb") as file:
        model = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    groups = ", groups string" if with_groups else ""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has its core; the library would start a thread for each core of the machine
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = _kept_aligner(*shared.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            of_id = batch.schema.field(0).type
            fields = [
                ("block", pa.int64()), ("doc_id", of_id), ("n_a", pa.int64()), ("n_b", pa.int64()),
                ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                ("width", pa.int32()), ("links", pa.binary()), ("times", pa.binary()),
                ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
            ]
            schema = pa.schema(fields + ([("groups", pa.string())] if with_groups else []))
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for part in slices(batch, 1, BLOCK_BYTES):
                documents = _aligned(aligner, part, with_groups)
                rows = _block_rows(documents, aligner.pairs, block, with_groups)
                block += 1
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return chosen.mapInArrow(
        work,
        f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        f"width int, links binary, times binary, codes array<long>, counts array<long>{groups}",
    )


def _pairs(blocks: DataFrame) -> DataFrame:
    """Rows (block, rank, code, n): the distinct pairs of each block."""
    zipped = F.posexplode(F.arrays_zip("codes", "counts")).alias("rank", "pair")
    return blocks.where("codes IS NOT NULL").select("block", zipped).select("block", "rank", "pair.codes", "pair.counts")


def _totals(pairs: DataFrame, n_b: int) -> DataFrame:
    """Rows (codes, total, best): links of each pair in the corpus; best: none of its B id is above.

    An id of B has at most as many pairs as A has ids, so no window grows with the documents.
    """
    sums = pairs.groupBy("codes").agg(F.sum("counts").alias("total"))
    of_b = Window.partitionBy(F.col("codes") % n_b)
    return sums.select("codes", "total", (F.col("total") == F.max("total").over(of_b)).alias("best"))


def _size_of_b(b_path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def id_links(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The links of the corpus by ids: id_a, id_b, n_links, best (highest of its id_b, ties included)."""
    blocks = session_scratch(docs.sparkSession).store(_blocks(docs, a_path, b_path, doc_id, text, False))
    n_b = _size_of_b(b_path)
    return _totals(_pairs(blocks), n_b).select(
        F.floor(F.col("codes") / n_b).cast("int").alias("id_a"),
        (F.col("codes") % n_b).cast("int").alias("id_b"),
        F.col("total").alias("n_links"),
        "best",
    )


def alignments(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False
) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `n_best` counts links whose pair is the commonest of its B id in the corpus, ties included;
    `count_sum` adds up the corpus counts of the document's links. `with_groups` adds the
    groups themselves as `a1,a2|b1;a3|b2,b3`. A text that is NULL or empty, or that either
    tokenizer does not give back byte by byte, has no tokens: zeros and ''. Every row gives a
    row, repeated ones too; other columns of `docs` are not read, an id may have any type.
    """
    spark = docs.sparkSession
    stored = session_scratch(spark).store(_blocks(docs, a_path, b_path, doc_id, text, with_groups))
    pairs = _pairs(stored)
    totals = _totals(pairs, _size_of_b(b_path))
    of_block = F.col("block").alias("of_block")
    known = pairs.select(of_block, "rank", "codes").join(totals, "codes").select("of_block", "rank", "total", "best")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * with_groups
    rows = stored.select("block", *kept, "width", "links", "times")
    counted = rows.groupBy("block").cogroup(known.groupBy("of_block"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *kept[5:]]

    def finish(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        rank = pairs.column("rank").to_numpy()
        total, best = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        total[rank], best[rank] = pairs.column("total").to_numpy(), pairs.column("best").to_numpy()
        sums: dict[str, list[int]] = {"n_best": [], "count_sum": []}
        columns = (documents.column(c).to_pylist() for c in ("width", "links", "times"))
        for width, links, times in zip(*columns, strict=True):
            numbers = np.frombuffer(links, np.uint16 if width == 2 else np.uint32)
            weight = np.frombuffer(times, np.int64) if times else 1
            sums["n_best"].append(int((best[numbers] * weight).sum()))
            sums["count_sum"].append(int((total[numbers] * weight).sum()))
        whole = {c: documents.column(c) for c in kept} | {c: pa.array(v, pa.int64()) for c, v in sums.items()}
        return pa.table([whole[c] for c in order], names=order)

    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in order)
    return counted.applyInArrow(finish, schema)
