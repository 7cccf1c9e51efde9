import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendspan.llm import align

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def ends(tokens):
    found, end = [], 0
    for _, raw in tokens:
        end += len(raw)
        found.append(end)
    return found


def brute_force(rows):
    """Whole texts, token bytes and a walk over both; no spans, words or blocks."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    back = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
    pairs, documents = Counter(), []
    for doc_id, text in rows:
        text = text or ""
        raw = (" " + text).encode()
        encoded = tokenizer.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(back[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
        b = []
        for i in processor.encode(text):
            piece = processor.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(r for _, r in a) != raw or b"".join(r for _, r in b) != raw:
            documents.append((doc_id, [], [], [], [], ""))
            continue
        ends_a, ends_b = ends(a), ends(b)
        links = []
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            for j, other in enumerate(ends_b):
                if other > start and (ends_b[j - 1] if j else 0) < end:
                    links.append((a[i][0], b[j][0]))
        groups, done_a, done_b = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(
                ",".join(str(i) for i, _ in a[done_a:to_a]) + "|" + ",".join(str(i) for i, _ in b[done_b:to_b])
            )
            done_a, done_b = to_a, to_b
        pairs.update(links)
        documents.append((doc_id, a, b, groups, links, ";".join(groups)))
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return [
        (
            i, len(a), len(b), len(groups), len(links), sum(pairs[p] == best[p[1]] for p in links),
            sum(pairs[p] for p in links), written and hashlib.sha256(written.encode()).hexdigest(),
        )
        for i, a, b, groups, links, written in documents
    ]


def odd_texts(seed, n, alphabet, longest=80):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


TEXTS = [
    None, "", " ", "  ", "\n", " x", "x ", "x  y", "naïve café 字字 x𝒳y 🙂🙂 ẞ", "<|endoftext|> <s></s> <unk> <0x41>",
    "a b 　 c d", "▁piece with its own space sign", "tab\there\r\n  indented", "é combining ́ alone",
    "\x00 zero", "the the the the", "'s it's WE'LL 2024-01-01 3.14159", "﻿mark", "x" * 3000, "字" * 500,
]


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize(
    "alphabet", ["abc  def\n'", "aé字𝒳 🙂́ .\t", "ab <|endoftext|>s/0xA1 ▁ ", "e th an in 12,.;:-()\"\n\n  "]
)
def test_rows_equal_brute_force(spark, alphabet):
    rows = list(enumerate(TEXTS + odd_texts(3, 150, alphabet)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(align.alignments(docs, A, B)) == sorted(brute_force(rows), key=str)


def test_small_blocks_pieces_and_memory_change_nothing(spark, monkeypatch):
    rows = list(enumerate(odd_texts(4, 60, "abcde fgé字 \n", 400)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    expected = sorted(brute_force(rows), key=str)
    for name, value in (("BLOCK_BYTES", 500), ("PIECE_CHARS", 40), ("MEMORY", 100), ("LONG", 20)):
        monkeypatch.setattr(align, name, value)
    aligner = align.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    documents = align._aligned(aligner, batch, True)
    digests = {d.doc_id: d.digest.hexdigest() if d.sizes[0] and not d.sizes[4] else "" for d in documents}
    assert digests == {r[0]: r[-1] for r in expected}
    assert any(d.times is not None for d in documents)
    for d, row in zip(documents, sorted(expected), strict=True):
        codes, times = d.links()
        assert (len(codes) if times is None else times.sum()) == row[4]
        assert hashlib.sha256("".join(d.groups).encode()).hexdigest() == row[-1] or not row[-1]
    assert found(align.alignments(docs, A, B)) == expected


def test_whole_texts_give_the_same_as_words(monkeypatch):
    definition, model = open(A, encoding="utf-8").read(), open(B, "rb").read()
    by_word = align.Aligner(definition, model)
    assert by_word.alone
    whole = align.Aligner(definition, model)
    whole.alone = False
    import pyarrow as pa

    texts = [t or "" for t in TEXTS] + odd_texts(9, 100, "ab é字 \n\t'", 200)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    sides = [align._aligned(a, batch, True) for a in (by_word, whole)]
    for one, other in zip(*sides, strict=True):
        if not one.sizes[4]:
            assert (one.sizes == other.sizes).all() and one.groups == other.groups
        assert bool(one.sizes[4]) == bool(other.sizes[4])


def test_groups_and_id_links_are_what_the_digests_say(spark):
    rows = [(1, "over the hills and far away"), (2, "the hills 字"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in align.alignments(docs, A, B, with_groups=True).collect():
        assert (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") == r.groups_sha256
        assert (r.groups.count(";") + 1 if r.groups else 0) == r.n_groups
    links = align.id_links(docs, A, B).collect()
    assert sum(r.n_links for r in links) == sum(r[4] for r in brute_force(rows))
    by_b = {}
    for r in links:
        by_b.setdefault(r.id_b, []).append((r.n_links, r.best))
    assert all((n == max(c for c, _ in both)) == best for both in by_b.values() for n, best in both)


def test_clashing_columns_ids_and_empty_tables(spark):
    rows = [("b", "some text", 1, 2, "x"), (None, "some text", 1, 2, "x"), ("b", "some text", 1, 2, "x"), ("", None, 0, 0, "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, block int, n_a int, codes string")
    got = found(align.alignments(docs, A, B))
    assert got == sorted(brute_force([r[:2] for r in rows]), key=str)
    assert align.alignments(docs.limit(0), A, B).count() == 0
    assert align.id_links(docs.limit(0), A, B).count() == 0
    only_empty = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert [tuple(r)[1:] for r in align.alignments(only_empty, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_memory_of_words_outlasts_a_task():
    definition, model = open(A, encoding="utf-8").read(), open(B, "rb").read()
    kept = align._kept_aligner(definition, model)
    kept.learn([["kept", "words"]])
    assert align._kept_aligner(definition, model) is kept and {"kept", "words"} <= set(kept.known)


def test_pairs_keep_their_numbers_while_words_are_forgotten(monkeypatch):
    import pyarrow as pa

    aligner = align.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = ["over the hills and far away", "away over hills 字 and 字"] * 3
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": texts})
    once = align._block_rows(align._aligned(aligner, batch, False), aligner.pairs, 0, False)
    monkeypatch.setattr(align, "PIECE_CHARS", 10)
    monkeypatch.setattr(align, "LONG", 3)
    for memory in (1, 1 << 20):
        monkeypatch.setattr(align, "MEMORY", memory)
        rows = align._block_rows(align._aligned(aligner, batch, False), aligner.pairs, 0, False)
        assert dict(zip(rows[0]["codes"], rows[0]["counts"])) == dict(zip(once[0]["codes"], once[0]["counts"]))
        assert [r["groups_sha256"] for r in rows] == [r["groups_sha256"] for r in once]
        assert any(r["times"] for r in rows)
    assert len(aligner.pairs) == len(set(aligner.pairs.tolist())) and (aligner.pairs[aligner.number] == aligner.sorted).all()
