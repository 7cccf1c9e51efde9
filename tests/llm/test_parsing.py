import hashlib
import random

import numpy as np
import pytest

from lendspan.llm import parsing


def text_of(rng, n):
    return "".join(rng.choice("abcdefghij klmnop éß字") for _ in range(n))


def names(text, levels):
    found, first = parsing._BYTE_NAMES[np.frombuffer(text, np.uint8)], np.array([0])
    for _ in range(levels):
        found, first = parsing.parse(found, first)
    return set(found.tolist())


def test_equal_substrings_share_their_interior_phrases():
    rng = random.Random(2)
    shared = text_of(rng, 3000).encode()
    for level in (1, 2, 3):
        inside = names(shared, level)
        for head in ("x", text_of(rng, 77), "zz" * 50):
            around = names(head.encode() + shared + b"tail", level)
            assert len(inside & around) >= 0.9 * len(inside)


def test_batches_do_not_change_signatures():
    rng = random.Random(3)
    texts = [text_of(rng, n).encode() for n in (1, 2, 3, 5, 40, 400)] + [b"", b"aaaaaaaaaa", b"abababab" * 20, b"a"]
    whole = parsing.signatures(texts)
    assert all((parsing.signatures([t])[0] == row).all() for t, row in zip(texts, whole, strict=True))
    assert (parsing.signatures(texts[::-1])[::-1] == whole).all()


def test_likeness_follows_what_texts_share():
    rng = random.Random(4)
    a, b = text_of(rng, 2000), text_of(rng, 2000)
    own, half, other = parsing.signatures([a.encode(), (a[:1000] + b[:1000]).encode(), b.encode()])
    like = lambda x, y: parsing.likeness(x[None], y[None])[0]
    assert like(own, own) == 1 and 0.15 < like(own, half) < 0.55 and like(own, other) < 0.1


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_rows_meet_their_successors(spark, partitions):
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.choice([1, 7, 300])), "c") for i in rng.sample(range(-50, 50), 23)]
    rows += [(60, None, "c"), (61, "", "c"), (62, text_of(rng, 9000), "c"), (62, "again", "c"), (None, "no id", "c"), (63, rows[0][1], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = parsing.fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = []
    for k, (i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        s = parsing.signatures([t.encode(), changed.encode(), following.encode()])
        expected.append(
            (i, len(t), hashlib.sha256(changed.encode()).hexdigest(), *parsing._hex(s[:2]),
             parsing.likeness(s[:1], s[1:2])[0], parsing.likeness(s[:1], s[2:])[0])
        )
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)
    same = {r.fingerprint for r in got if r.doc_id in (rows[0][0], 63)}
    assert len(same) == 1


def test_one_document_and_none(spark):
    docs = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    (row,) = parsing.fingerprints(docs).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1
    assert parsing.fingerprints(docs.limit(0)).count() == 0
