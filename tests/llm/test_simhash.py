import random

import pytest
from pyspark.sql import functions as F

from lendspan.llm import simhash
from lendspan.session import Scratch


def brute_classes(prints):
    label = {f: f for f in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ordered = sorted(prints)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= simhash.DISTANCE:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {f: root(f) for f in prints}


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def flipped(rng, value, bits):
    for bit in rng.sample(range(64), bits):
        value ^= 1 << bit
    return value


def test_classes_equal_those_of_all_pairs(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 4, 9])):
            prints.add(signed(at))
            at = flipped(rng, at, rng.choice([1, 3, 4, 4, 5]))
    centre = rng.getrandbits(64)  # a crowd around one value
    prints |= {signed(flipped(rng, centre, rng.choice([1, 2, 3]))) for _ in range(80)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    with Scratch(spark) as scratch:
        found = dict(tuple(r) for r in simhash.link_classes(frame, scratch).collect())
    assert found == brute_classes(prints)


@pytest.mark.parametrize("links", [simhash._close_links, simhash._far_links])
def test_exploded_rows_are_never_broadcast_by_estimate(spark, tmp_path, links):
    # 16 KB by Spark's estimate and 65 rows each once exploded
    prints = spark.range(2000).select(F.xxhash64("id").alias("fp"), F.xxhash64("id").alias("label"))
    prints.write.parquet(str(tmp_path / "prints"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10MB")
    try:
        found = links(spark.read.parquet(str(tmp_path / "prints")))
        planned = found._jdf.queryExecution().executedPlan().toString()
        found.collect()
        ran = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in planned and "SortMergeJoin" in ran
    assert "BroadcastExchange" not in planned + ran


def test_fingerprint_by_definition():
    import xxhash

    words = "A b c d e A b c d".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).lower(), 42) for i in range(6)]
    expected = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > 6)
    assert simhash.fingerprint(" ".join(words).encode()) == expected
    assert simhash.fingerprint(b" \n ") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest("one two", 42)


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(str(i % 37) for i in range(500)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (5, None, "x", "c"), (7, "", "y", "c"), (3, long, None, None), (3, long, None, None), (9, long + " end", "x", "c"),
        (None, "lone words only here now", None, "c"), (11, "lone words only here now", "z", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert len(got) == 7
    by_id = {r[0]: r for r in got}
    assert by_id[5][1:] == ("0" * 16, 5) == by_id[7][1:]
    assert by_id[3][2] == 3 == by_id[9][2]
    assert by_id[None][2] == 11 == by_id[11][2]


@pytest.mark.parametrize("rows", [[], [(1, "one word")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(docs).collect()] == [r[0] for r in rows]
