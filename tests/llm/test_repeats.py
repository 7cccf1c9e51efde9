import hashlib
import random

import numpy as np
import pytest

from lendspan.llm import repeats


def brute(rows):
    order = sorted({(i is not None, i or 0, t or "") for i, t, *_ in rows}, key=lambda r: r[:2])
    seen, result = set(), {}
    for known, i, text in order:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            window = data[at : at + 100]
            if window in seen:
                gone[at : at + 100] = True
            seen.add(window)
        padded = np.concatenate([[False], gone])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if data else b""
        result[known, i, text] = (len(data), int(gone.sum()), int((padded[1:] & ~padded[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return sorted(((i, *result[i is not None, i or 0, t or ""]) for i, t, *_ in rows), key=str)


def found(spark, rows, **sizes):
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, no string, found int")
    return sorted((tuple(r)[:5] for r in repeats.without_repeats(docs, **sizes).collect()), key=str)


def make_rows():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh é字") for _ in range(n))
    passages = [text(n) for n in (80, 99, 100, 101, 130, 400, 2500)]
    rows = []
    for i in range(40):
        parts = [text(rng.choice([0, 5, 60, 300])) for _ in range(4)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        rows.append((i * 3, "".join(parts)))
    whole = rows[4][1] + passages[-1]
    rows += [(200 + k, whole) for k in range(4)]  # exact copies
    edited = list(passages[-1])
    for k in range(4):
        edited[rng.randrange(len(edited))] = "X"
        rows.append((210 + k, "".join(edited)))  # near copies
    rows += [(300, "a" * 700), (301, "ab" * 90 + "a" * 120), (302, None), (303, ""), (None, passages[5]), (304, passages[2] * 5)]
    return rows + [rows[7]]  # a repeated row


@pytest.mark.parametrize("sizes", [{}, {"piece": 256, "flush": 50, "block": 20, "part": 1}, {"flush": 1, "block": 2000, "part": 3}])
def test_equals_brute_force(spark, sizes):
    rows = make_rows()
    assert found(spark, rows, **sizes) == brute(rows)


def test_ids_that_are_no_numbers(spark):
    rows = make_rows()
    named = [(None if i is None else f"d{i:06}", t) for i, t in rows]
    docs = spark.createDataFrame(named, "doc_id string, text string")
    rows_found = sorted((tuple(r)[:5] for r in repeats.without_repeats(docs).collect()), key=str)
    assert rows_found == sorted(((None if r[0] is None else f"d{r[0]:06}", *r[1:]) for r in brute(rows)), key=str)


def test_equals_sql(spark):
    import duckdb

    from lendspan.llm import oracles

    rows = [r for r in make_rows()[:-1] if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    assert sorted((tuple(r) for r in con.execute(oracles.REPEATS).fetchall()), key=str) == found(spark, rows)


def test_the_cover_meets_every_shift():
    differences = {(a - b) % repeats.MODULUS for a in repeats.COVER for b in repeats.COVER}
    assert differences == set(range(repeats.MODULUS))
    assert repeats.FIRST + sum(repeats.STEPS) == repeats.DEPTH
    depth = repeats.FIRST
    for step in repeats.STEPS:
        assert step % repeats.MODULUS == 0 and step <= depth
        depth += step


def test_ranks_order_samples_as_bytes_do():
    rng = np.random.default_rng(1)
    data = np.tile(rng.integers(97, 99, 150).astype(np.uint8), 5)
    data[400] = 120
    ranks, raw = repeats.sample_ranks(data), data.tobytes() + bytes(repeats.LENGTH)
    samples = [p for p in range(len(data)) if p % 3 in repeats.COVER]
    strings = [raw[p : p + repeats.DEPTH] for p in samples]
    by_bytes = {s: k + 1 for k, s in enumerate(sorted(set(strings)))}
    assert [by_bytes[s] for s in strings] == ranks[samples].tolist()


def test_later_windows_are_found_at_every_phase():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 123, 140).astype(np.uint8)
    data = np.concatenate([base, base[:1], base, base[:1], base, rng.integers(97, 123, 60).astype(np.uint8)])
    starts = np.arange(len(data) - 99)
    seen, expected = set(), []
    for at in starts:
        window = data[at : at + 100].tobytes()
        expected.append(window in seen)
        seen.add(window)
    assert repeats.later_windows(data, starts).tolist() == expected and sum(expected) > 80


def test_window_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    twice = np.concatenate([data, data])
    hashes = repeats.window_hashes(twice, 100)
    assert (hashes[:2901] == hashes[3000:]).all() and len(np.unique(hashes[:3000])) == 3000


@pytest.mark.parametrize("rows", [[], [(1, "short")], [(1, None)]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)
