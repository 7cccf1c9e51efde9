import hashlib
from collections import defaultdict

import pytest

from lendspan.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copy string, words string, start string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def water_level(sizes, weights, times=3):
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in sizes if s not in full]
        if not open_:
            return 0.0
        level = (total - sum(times * sizes[s] for s in full)) / sum(weights[s] for s in open_)
        more = {s for s in open_ if weights[s] * level >= times * sizes[s]}
        if not more:
            return level
        full |= more


def brute(rows):
    """(doc_id, size, source_size, target, taken) by serving one word at a time is too slow; by copies."""
    sized = [(i, s, len((t or "").split())) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n in sized:
        sizes[s] += n
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(ordered)}
    level = water_level(sizes, weights)
    result = []
    for source in ordered:
        target = min(weights[source] * level, 3.0 * sizes[source])
        own = sorted(
            (d for d in sized if d[1] == source),
            key=lambda d: (hashlib.md5(str("" if d[0] is None else d[0]).encode()).hexdigest(), d[0] is not None, d[0] or 0, d[2]),
        )
        before = 0
        for i, _, n in own:
            taken = sum(max(0, min(n, -(-target // 1) - before - k * sizes[source])) for k in range(3))
            result.append((i, n, sizes[source], round(target, 6), taken))
            before += n
    return result


ROWS = [
    (1, "a b c d", "x"), (2, "e f", "x"), (3, "g " * 40, "x"), (4, "h i j", "y"), (5, None, "y"), (6, "", "y"),
    (7, "k l m n o p q", None), (8, "r", None), (9, "s t " * 15, "z"), (None, "u v w", "z"), (11, "u v w", "z"),
]


def test_taken_words_meet_the_targets(spark):
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix_totals(docs(spark, ROWS)).collect()]
    expected = brute(ROWS)
    by_key = lambda rows: sorted(rows, key=str)
    assert [r[:4] for r in by_key(got)] == [r[:4] for r in by_key(expected)]
    total = sum(r[1] for r in expected)
    assert sum(r[4] for r in got) == total
    served, wanted = defaultdict(int), {}
    for row in got:
        served[row[2:4]] += row[4]
        wanted[row[2:4]] = row[3]
        assert 0 <= row[4] <= 3 * row[1]
    assert all(abs(served[s] - wanted[s]) <= 1 for s in wanted)


def test_repeated_rows_are_separate_documents(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (1, "c d e", "x"), (2, "f", "y")]
    got = mixing.mix_totals(docs(spark, rows)).collect()
    assert len(got) == 4 and {r.source_size for r in got} == {7, 1}


def test_mixed_documents_carry_the_words_of_the_totals(spark):
    rows = [*ROWS, (2, "e f", "x")]
    table = docs(spark, rows)
    copies = mixing.mixed_documents(table)
    assert copies.columns == ["doc_id", "text", "source", "size", "start", "copy", "mix_start", "words"]
    found = copies.collect()
    assert sum(r.words for r in found) == sum(r.taken for r in mixing.mix_totals(table).collect())
    ordered = sorted(found, key=lambda r: r.mix_start)
    at = 0
    for row in ordered:  # the mix has no gaps
        assert row.mix_start == at
        at += row.words


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "x"), (2, None, "y")]])
def test_nothing_to_mix(spark, rows):
    assert [r.taken for r in mixing.mix_totals(docs(spark, rows)).collect()] == [0] * len(rows)
    assert mixing.mixed_documents(docs(spark, rows)).count() == 0
