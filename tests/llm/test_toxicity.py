import itertools
import math
import random

import numpy as np
import pytest

from lendspan.llm import toxicity
from lendspan.llm.toxicity import Chain


def tables(spark, n=240, seed=1):
    rng = random.Random(seed)
    plain = ["river", "stone", "green", "walk", "table", "cloud", "paper", "house", "music", "early"]
    bad = ["grumk", "fozzle", "blarg"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(8, 40))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), "x"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_marginals_equal_sums_over_all_paths():
    chain = Chain({"a": 1, "b": 2}, np.array([-0.7, 1.3, 0.2]))
    chain.start, chain.trans = np.array([0.3, -0.4]), np.array([[0.5, -0.2], [0.1, 0.9]])
    index = [1, 0, 2, 1, 0]
    total, toxic = 0.0, np.zeros(len(index))
    for path in itertools.product((0, 1), repeat=len(index)):
        log = chain.start[path[0]] + sum(chain.weights[w] for w, s in zip(index, path) if s)
        log += sum(chain.trans[a, b] for a, b in itertools.pairwise(path))
        total += math.exp(log)
        toxic += math.exp(log) * np.array(path)
    found, none = chain.marginals(index)
    assert np.allclose(found, toxic / total)
    assert math.isclose(math.exp(none), math.exp(chain.start[0] + 4 * chain.trans[0, 0]) / total)


def test_planted_words_are_found_and_clean_documents_left(spark):
    docs, labels = tables(spark)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 240
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in rows:
        assert row.predicted == int(row.doc_id % 4 == 0), (row, texts[row.doc_id])
        words = {texts[row.doc_id][s.begin : s.end] for s in row.spans}
        assert words <= {"grumk", "fozzle", "blarg"} and bool(words) == (row.doc_id % 4 == 0)
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if i % 4]


def test_odd_rows_have_scores(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame(
        [(None, None, "x"), (900, "", "x"), (901, "river " * 5000 + "grumk blarg fozzle", "x"), (901, "stone", "x")], docs.schema
    )
    rows = toxicity.toxicity(docs.unionByName(odd), labels).where("doc_id IS NULL OR doc_id >= 900").collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.held_out for r in rows}[None] is False
    kept = toxicity.accepted(docs.unionByName(odd), labels).where("doc_id IS NULL").collect()
    assert [r.text for r in kept] == [None]


@pytest.mark.parametrize("labels", [[], [(0, 1), (4, 1)], [(1, 0)], [(1, None)]])
def test_without_both_classes_all_scores_are_alike(spark, labels):
    docs, _ = tables(spark, 12)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert len({r.score for r in toxicity.toxicity(docs, frame).collect()}) == 1
    assert toxicity.toxicity(docs.limit(0), frame).count() == 0


def test_the_held_out_fold_teaches_nothing(spark):
    docs, labels = tables(spark)
    turned = labels.withColumn("toxic", labels.toxic * 0 + 1).where(toxicity.held_out(labels.doc_id))
    rest = labels.where(~toxicity.held_out(labels.doc_id))
    scores = lambda frame: {r.doc_id: r.score for r in toxicity.toxicity(docs, frame).collect()}
    assert scores(labels) == scores(rest.unionByName(turned))


def test_long_texts_without_lexicon_words_are_scored_whole():
    chain = toxicity.Chain({}, np.array([-2.0]), np.array([-3.0, 0.6, 1.0, 0.5]))
    chain.trans = np.array([[2.0, -2.0], [-1.0, 1.0]])
    for n in (1, 2000, 2001, 9000):
        found, none = chain.marginals([0] * n)
        assert chain.read("word " * n)[0] == chain.score(sum(found), none)
    assert chain.blank(9000) > chain.blank(2000)


def test_copied_texts_do_not_crowd_out_the_lexicon(spark, monkeypatch):
    rng = random.Random(4)
    plain = [f"plain{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    text = lambda bad: " ".join(w for _ in range(30) for w in ([rng.choice(plain), "grumk"] if bad else [rng.choice(plain)]))
    copied = " ".join(f"{chr(97 + k % 26) * 3}{chr(97 + k // 26) * 3}" for k in range(200))
    # two of three toxic texts are near copies
    ends = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(240)]
    rows = [(i, f"{copied} {ends[i]}" if i % 6 in (2, 4) else text(i % 6 == 0), int(i % 2 == 0)) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    for bound in ("LEXICON", "CANDIDATES"):
        with monkeypatch.context() as patch:
            patch.setattr(toxicity, bound, 60)
            assert "grumk" in toxicity.fit(docs, labels).units_known
