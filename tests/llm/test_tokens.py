import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lendspan.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter(library):
    with open(PATH, encoding="utf-8") as file:
        return tokens.Counter(file.read(), tokens.whole_tokens(library))


def counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_whole_token_is_one_token(library, counter):
    whole = sorted(counter.whole)
    assert len(whole) > 30_000
    assert set(counts(library, whole)) == {1}


@pytest.mark.parametrize(
    "alphabet",
    [
        "abcdeéèßöñ 'stmdrevlABCÉ019½².,!?-_\n",
        "aAbé \n'st’ßİıªµ½²٣字éΣς \x1c\x85<|endoftext|>-_ſK9ǅ™€ ",
        "".join(map(chr, [*range(9, 14), *range(32, 127), *range(0xA1, 0x300)])),
    ],
)
def test_counts_equal_those_of_the_library(library, counter, alphabet):
    rng = random.Random(5)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "it's we'LL I'M they'd", "  ", ""]
    assert [counter.count(t) for t in texts] == counts(library, texts)


def test_long_texts_are_cut_at_white_space_without_effect(library, counter, monkeypatch):
    rng = random.Random(6)
    text = " ".join("".join(rng.choice("abcdefgé1'.") for _ in range(rng.randint(1, 9))) for _ in range(4000))
    monkeypatch.setattr(tokens, "PIECE", 200)
    monkeypatch.setattr(tokens, "CACHE", 50)
    assert counter.count(text) == counts(library, [text])[0]
    assert counter.count("x" * 5000) == counts(library, ["x" * 5000])[0]


def test_rows(spark, library):
    rows = [(1, None, 5), (2, "", 5), (3, "Ünïcode wörds", 5), (3, "Ünïcode wörds", 5), (None, "a " * 3000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in tokens.token_counts(docs, PATH).collect()), key=str)
    expected = []
    for i, t, _ in rows:
        n = counts(library, [t or ""])[0]
        expected.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(expected, key=str)
    assert tokens.token_counts(docs.limit(0), PATH).count() == 0
