import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lendspan.llm import brown


def mutual_information(pairs, classes):
    member = np.eye(classes.max() + 1)[classes]
    joint = member.T @ pairs @ member
    f = brown._xlogx
    return f(joint).sum() - f(joint.sum(0)).sum() - f(joint.sum(1)).sum()


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(3)
    kind = np.array([0, *[1 + k % 3 for k in range(30)]])
    chance = np.array([[0, 1, 0, 0], [0.1, 0, 0.9, 0], [0.1, 0, 0, 0.9], [0.2, 0.8, 0, 0]])
    weight = rng.random((31, 31)) + 0.5
    pairs = np.floor(400 * chance[kind][:, kind] * weight)
    found = brown.exchange(pairs, classes=4, rounds=20)
    assert found[0] == 0 and len({(a, b) for a, b in zip(kind, found, strict=True)}) == 4
    assert math.isclose(mutual_information(pairs, found), mutual_information(pairs, kind))


def test_a_move_is_worth_what_its_gain_says():
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 9, (12, 12)).astype(float)
    start = mutual_information(pairs, np.array([0, *[1 + k % 3 for k in range(11)]]))
    assert mutual_information(pairs, brown.exchange(pairs, 4, 1)) >= start


def tables(spark, n=160):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        words = [rng.choice(["The", "a"]) + " " + rng.choice(["dog", "cat", "bird"]) + " " + rng.choice(["runs.", "sleeps."]) for _ in range(rng.randint(1, 9))]
        rows.append((i, " ".join(words) + (f" rare{i}" if i % 7 == 0 else ""), "c"))
    rows += [(900, None, "c"), (901, "", "c"), (902, "a\tdog\x0bruns. x É é", "c"), (None, "the cat", "c"), (5, rows[5][1], "c")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, n string")


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_base_scores_by_definition(spark, monkeypatch, frequent):
    monkeypatch.setattr(brown, "FREQUENT", frequent)
    rows, docs = tables(spark)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter()
    for i, t, _ in rows:
        if not held(i):
            counts.update([*split(t), "<end>"])
    total, types = sum(counts.values()), len(counts)
    got = sorted((tuple(r) for r in brown.scores(docs).collect()), key=str)
    expected = []
    for i, t, _ in rows:
        line = [*split(t), "<end>"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in line)
        expected.append((i, held(i), len(line), sum(counts[w] > 0 for w in line), total, base))
    for row, right in zip(got, sorted(expected, key=str), strict=True):
        assert row[:5] == right[:5]
        assert math.isclose(row[5], right[5], rel_tol=1e-9)
    train_gain = sum(r[6] - r[5] for r in got)
    assert train_gain > 0


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_scores_by_definition(spark, monkeypatch, frequent):
    monkeypatch.setattr(brown, "FREQUENT", frequent)
    monkeypatch.setattr(brown, "CORE", 3)
    from lendspan.session import Scratch

    rows, docs = tables(spark)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    chosen = docs.select("doc_id", brown.F.coalesce("text", brown.F.lit("")).alias("text"))
    with Scratch(spark) as scratch:
        classes, words = brown.cluster(chosen.where(~brown.held_out(brown.F.col("doc_id"))), scratch)
        class_of = {r.word: r["class"] for r in words.collect()}
    n, types, follow, size = Counter(), Counter(), Counter(), Counter()
    for i, t, _ in rows:
        if held(i):
            continue
        before = 0
        for w in [*split(t), None]:
            c = class_of.get(w, 0)
            n[w] += 1
            size[c] += 1
            follow[before, c] += 1
            before = c
    for w in n:
        types[class_of.get(w, 0)] += 1
    total = sum(n.values())

    def score(text):
        logs, before = 0.0, 0
        for w in [*split(text), None]:
            c = 0 if w is None else class_of[w] if w in class_of else int(classes.groups[brown.group_of(w.encode())])
            step = follow[before, c] + brown.PRIOR * size[c] / total + 1e-9
            step /= size[before] + brown.PRIOR + 1e-9 * brown.CLASSES
            logs += math.log10(step) + math.log10((n[w] + 0.1) / (size[c] + 0.1 * (types[c] + 1)))
            before = c
        return logs

    expected = sorted(((i, round(score(t), 6)) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, round(r.score, 6)) for r in brown.scores(docs).collect()), key=str) == expected


@pytest.mark.parametrize("lists", [256, 1])
def test_neighbours_are_counted_exactly_however_they_are_joined(spark, monkeypatch, lists):
    monkeypatch.setattr(brown, "COUNTED", 40)
    monkeypatch.setattr(brown, "LISTS", lists)
    rows, docs = tables(spark)
    core = [b"the", b"dog"]
    size = 1 + len(core) + brown.GROUPS
    assigned = np.array([0, *[1 + k % (brown.CLASSES - 1) for k in range(size - 1)]])
    units, expected, total = brown.Units(core), Counter(), 0
    of = lambda w: int(assigned[units.of([w.encode()])[0]]) if w else 0
    for _, t, _ in rows:
        line = ["", *split(t), ""]
        total += len(line) - 1
        for left, right in zip(line, line[1:]):
            expected[left, of(right)] += 1
            expected[right, brown.CLASSES + of(left)] += 1
    assert (brown.salts(total) > 1) == (lists == 1)
    found = brown.neighbours(docs.repartition(9), core, assigned, total).collect()
    assert len(found) == len({r.word for r in found})
    got = {(r.word, c): n for r in found for c, n in zip(r.codes, r.times, strict=True)}
    assert got == {k: n for k, n in expected.items() if k[0]}
    assert all(r["class"] == of(r.word) for r in found)


def test_groups_of_a_hot_word_grow_with_the_root_of_the_corpus():
    assert brown.salts(0) == brown.salts(brown.COUNTED * (brown.LISTS - 1)) == 1
    for total in (brown.COUNTED * brown.LISTS, 10**10, 6 * 10**12):
        flushes, many = total // brown.COUNTED + 1, brown.salts(total)
        assert many**2 >= flushes and -(-flushes // many) <= many < 2 * math.sqrt(flushes)


def test_probabilities_of_next_words_sum_to_one(spark):
    _, docs = tables(spark)
    from lendspan.session import Scratch

    with Scratch(spark) as scratch:
        model, counts = brown.learn(docs.select("doc_id", "text").where("text IS NOT NULL"), scratch)
        seen = {r.word.encode(): r.n for r in counts.collect()}
    assigned = model.assigned
    transition, size = 10**model.transition, 10**model.size
    assert np.allclose(transition.sum(1), 1)
    mass = np.zeros(brown.CLASSES)
    types = np.zeros(brown.CLASSES)
    unit = brown.Units(model.core)
    for word, n in seen.items():
        mass[assigned[unit.of([word])[0]]] += n + 0.1
        types[assigned[unit.of([word])[0]]] += 1
    n_docs = docs.where("text IS NOT NULL").count()
    mass[0] += n_docs + 0.1
    assert np.allclose((mass + 0.1)[types > 0], size[types > 0])


def test_empty_and_untrained(spark):
    _, docs = tables(spark)
    assert brown.scores(docs.limit(0)).count() == 0
    alone = docs.where("doc_id IS NOT NULL AND crc32(cast(doc_id AS string)) % 10 = 0")
    rows = brown.scores(alone).collect()
    assert rows and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in rows)


def test_rare_words_are_classed_by_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(brown, "CORE", 4)
    rng = random.Random(2)
    # two kinds of rare words, alike in their endings and unlike in what stands beside them
    rows = [(i, " ".join(f"the n{rng.randrange(300)}tail was v{rng.randrange(300)}tail by" for _ in range(20))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    from lendspan.session import Scratch

    with Scratch(spark) as scratch:
        _, words = brown.learn(docs, scratch)
        found = {r.word: r["class"] for r in words.collect()}
    kinds = [Counter(c for w, c in found.items() if w[0] == k and w.endswith("tail")) for k in "nv"]
    assert sum(kinds[0].values()) == sum(kinds[1].values()) == 300
    assert brown.group_of(b"n1tail") == brown.group_of(b"v1tail")
    assert not set(kinds[0]) & set(kinds[1])


def test_scores_do_not_depend_on_what_tasks_hold(spark, monkeypatch):
    _, docs = tables(spark)
    monkeypatch.setattr(brown, "CORE", 3)
    scored = []
    for frequent in (100_000, 3):
        monkeypatch.setattr(brown, "FREQUENT", frequent)
        scored.append(sorted((tuple(r) for r in brown.scores(docs).collect()), key=str))
    for one, other in zip(*scored, strict=True):
        assert one[:5] == other[:5] and np.allclose(one[5:], other[5:])


ODD = ["", "  ", " \x0bThe\tdog\x1c.\r\nthe ", "É é\x85x\xa0y", "a\x00b A\x00b", "the", "K ſ İ a ab abc abcd \U0001f600", "\x0c"]


def test_words_of_a_column_are_those_of_its_texts():
    column = pa.array(["unread", *ODD, *ODD[::-1], "unread"]).slice(1, 2 * len(ODD))
    rows, codes, words = brown.coded(column)
    words = words.to_pylist()
    expected = [(i, w) for i, t in enumerate([*ODD, *ODD[::-1]]) for w in split(t)]
    assert [(r, words[c]) for r, c in zip(rows.tolist(), codes.tolist(), strict=True)] == expected
    assert len(set(words)) == len(words) and "" not in words
    units = brown.Units([b"the", b"abcd"])
    named = pa.array(words)
    assert units.of_column(named).tolist() == units.of([w.encode() for w in words])
    assert units.of_column(named.slice(2, 3)).tolist() == units.of([w.encode() for w in words[2:5]])
    assert all(not len(part) for part in brown.coded(pa.array(["", " "])))


def test_tasks_split_texts_by_column(monkeypatch):
    """No step of Python runs per word of the texts: tables of words are asked only for what is new."""
    asked = Counter()
    monkeypatch.setattr(brown, "group_of", lambda ending: asked.update([ending]) or zlib.crc32(ending[-3:]) % brown.GROUPS)
    _, codes, words = brown.coded(pa.array(["some words of a text, and some of it again "] * 500))
    brown.Units([]).of_column(words)
    assert len(codes) == 5000 and max(asked.values()) == 1 and len(asked) <= len(words) == 8


@pytest.mark.parametrize("held", [300_000, 3])
def test_word_counts_however_many_a_task_holds(spark, monkeypatch, held):
    monkeypatch.setattr(brown, "HELD", held)
    monkeypatch.setattr(brown, "PASSED", 2)
    docs = spark.createDataFrame([(t,) for t in [*ODD, None] * 7], "text string").repartition(2)
    expected = Counter(w for t in ODD * 7 for w in split(t))
    assert {r.word: r.n for r in brown.word_counts(docs).collect()} == expected


def test_rows_of_a_word_are_added_across_batches(spark, monkeypatch):
    monkeypatch.setattr(brown, "COUNTED", 40)
    monkeypatch.setattr(brown, "PASSED", 2)
    _, docs = tables(spark)
    assigned = np.arange(1 + brown.GROUPS) % brown.CLASSES
    found = lambda: sorted((r.word, r.codes, r.times) for r in brown.neighbours(docs, [], assigned, 0).collect())
    expected, before = found(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found() == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
