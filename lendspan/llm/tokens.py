"""Token counts of a byte-level BPE with word ends, by a whole-token shortcut.

Before any text is read, the driver proves which vocabulary strings encode alone, as a
text of their own, to exactly one token; this set is bounded by the vocabulary. A text is
then cut into pre-tokens; those in the set count one each and only the others go through
the merges. Pieces whose characters could be normalised or split differently here than
in the library, or that hold a special token's string, go through the library whole.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices, string_texts

LIMIT = 2048
PIECE = 1 << 16
CACHE = 400_000

# The tokenizer's pattern of pre-tokens.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Characters below the combining marks that are in composed form, have one lower case and
# are white space, letter, number or neither by every Unicode version; typographic signs.
_UNPROVEN = re.compile("[^\t-\r -~¡-įı-˿‐-‧€™]")
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")


def _bytes_to_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_CHARACTERS = _bytes_to_characters()


def whole_tokens(tokenizer: Tokenizer, word_end: str = "</w>") -> frozenset[str]:
    """The strings that, alone, are one pre-token and one token; each is tried with the library."""
    back = {c: b for b, c in BYTE_CHARACTERS.items()}
    candidates = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if entry.endswith(word_end) and all(c in back for c in entry[: -len(word_end)]):
            raw = bytes(back[c] for c in entry[: -len(word_end)])
            try:
                candidates.append(raw.decode())
            except UnicodeDecodeError:
                continue
    encoded = tokenizer.encode_batch(candidates, add_special_tokens=False)
    return frozenset(
        text
        for text, tokens in zip(candidates, encoded, strict=True)
        if len(tokens.ids) == 1 and text and PRE_TOKEN.findall(text.lower()) == [text] and not _UNPROVEN.search(text)
    )


class Counter:
    """Counts tokens of texts; keeps a bounded memory of merged words."""

    def __init__(self, definition: str, whole: frozenset[str]) -> None:
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.whole = whole
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.merged: dict[str, int] = {}

    def count(self, text: str) -> int:
        if len(text) <= PIECE:
            return self._piece(text)
        total, start = 0, 0
        while start < len(text):
            cut = _SPACE.search(text, min(start + PIECE, len(text)))
            end = cut.start() if cut else len(text)
            total += self._piece(text[start:end])
            start = end + 1 if cut else end
        return total

    def _piece(self, text: str) -> int:
        if _UNPROVEN.search(text) or any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        found = PRE_TOKEN.findall(text.lower())
        whole, merged = self.whole, self.merged
        rest = [w for w in found if w not in whole]
        total = len(found) - len(rest)
        for word in rest:
            n = merged.get(word)
            if n is None:
                n = self._merge(word)
            total += n
        return total

    def _merge(self, word: str) -> int:
        if len(self.merged) >= CACHE:
            self.merged.clear()
        visible = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        n = self.merged[word] = len(self.model.tokenize(visible))
        return n


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit. NULL texts are empty; every row gives a row."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((definition, whole_tokens(Tokenizer.from_str(definition))))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), string_texts(batch, 1)], ["doc_id", "text"])
            for part in slices(batch, 1):
                rows = part.column(1).to_pylist()
                n_tokens = np.array([counter.count(t) for t in rows], np.int64)
                n_bytes = np.array([len(t.encode()) for t in rows], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return chosen.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
