import math
from fractions import Fraction

import numpy as np
import pytest

from lendspan.llm import whitening


def symmetric(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    matrix = (turn * np.array(values)) @ turn.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 100, 64),
        10.0 ** -np.arange(0, 8, 0.25),
        [1, 1 + 1e-9, 1 + 2e-9, 2, 2 + 1e-7, 5],
        [3.0] * 9,
        [7, 3, 3, 3, 1, 1, 0, 0],
        [1e300, 1e290],
        [1e-200, 3e-200, 5e-200],
        [4.0],
        [0.0, 0.0],
    ],
)
def test_eigenvectors_to_double_precision(values):
    a = symmetric(values)
    found = whitening.eigenvectors(a)
    size = np.abs(a).max() or 1.0
    assert np.abs(a @ found.vectors - found.vectors * found.values).max() <= 2e-15 * len(a) * size
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(a))).max() < 1e-11
    assert np.allclose(found.values, np.sort(np.linalg.eigvalsh(a))[::-1], rtol=0, atol=1e-14 * len(a) * size)
    assert (np.diff(found.values) <= 1e-15 * size).all()


def test_float32_alone_would_not_do():
    a = symmetric(np.linspace(1, 2, 40))
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    off = lambda x: np.abs(x.T @ a @ x - np.diag(np.diag(x.T @ a @ x))).max()
    assert off(start) > 1e-8 > 1e-13 > off(whitening.eigenvectors(a).vectors)


def test_split_product_keeps_what_cancels():
    x = np.linalg.qr(np.random.default_rng(3).normal(size=(30, 30)))[0]
    exact, rest = whitening.product(x.T, x)
    for i, j in ((0, 1), (4, 4), (7, 29)):
        true = sum(Fraction(float(p)) * Fraction(float(q)) for p, q in zip(x[:, i], x[:, j]))
        assert abs(float(Fraction(float(exact[i, j])) + Fraction(float(rest[i, j])) - true)) < 1e-20


def brute_force(rows, components=8):
    """One matrix, numpy's eigenvectors, exact sums."""
    usable = [
        (i, [math.floor(1024 * float(c)) + 100_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    x = np.array([v for _, v in usable], object)
    n, sums = len(x), x.sum(axis=0)
    far = n * x - sums
    centred = (far / n).astype(float)
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return usable, n, [int(d) for d in (far * far).sum(axis=1)], centred @ vectors / np.sqrt(values), values / np.trace(v)


def embeddings(spark, rows, kind="float", parts=3):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(parts)


def test_rows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    rows += [(900, None), (901, [None] * 12), (902, [1.0] * 11 + [float("nan")]), (903, [float("inf")] + [0.0] * 11), (5, rows[5][1])]
    usable, n, far, whitened, explained = brute_force(rows)
    got = whitening.whitened(embeddings(spark, [(i, v, 0) for i, v in rows])).collect()
    assert len(got) == 8 * n == 8 * 301
    assert {r.n for r in got} == {n} and {r.identity_error for r in got if r.identity_error < 1e-12} == {got[0].identity_error}
    for component in range(1, 9):
        mine = sorted((r.vec_id, r.deviation, r.whitened, r.explained) for r in got if r.component == component)
        other = sorted(zip([i for i, _ in usable], far, whitened[:, component - 1]))
        sign = 1 if mine[0][2] * other[0][2] > 0 else -1
        assert [m[:2] for m in mine] == [o[:2] for o in other]
        assert np.allclose([m[2] for m in mine], [sign * o[2] for o in other], atol=1e-9)
        assert np.allclose([m[3] for m in mine], explained[component - 1], rtol=1e-9)


def test_order_and_partitions_do_not_show(spark):
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(np.random.default_rng(6).normal(size=(200, 9)))]
    one, other = embeddings(spark, rows, parts=1), embeddings(spark, rows[::-1], parts=7)
    assert whitening.totals(one) == whitening.totals(other)
    assert (whitening.covariance(one, whitening.totals(one)) == whitening.covariance(other, whitening.totals(other))).all()
    key = lambda f: sorted((r.vec_id, r.component, r.eigenvalue, r.explained, r.whitened) for r in f.collect())
    for a, b in zip(key(whitening.whitened(one)), key(whitening.whitened(other)), strict=True):
        # the last bit of a matrix product may hang on how many rows it has
        assert a[:-1] == b[:-1] and abs(a[-1] - b[-1]) < 1e-13


def test_deviations_beyond_a_long_stay_exact(spark):
    rows = [(1, [3e9, 0.0], 0), (2, [-3e9, 1.0], 0), (3, [0.5, 2.0], 0)]
    _, _, far, _, _ = brute_force([r[:2] for r in rows], 2)
    got = {r.vec_id: r for r in whitening.whitened(embeddings(spark, rows, "double")).collect()}
    assert [got[i].deviation_digits for i in (1, 2, 3)] == [str(d) for d in far]
    assert got[1].deviation is None and got[3].deviation == (far[2] if far[2] < 2**63 else None)


def test_edge_cases(spark):
    alike = whitening.whitened(embeddings(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)])).collect()
    assert len(alike) == 6 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in alike} == {(0, None, None, None)}
    flat = whitening.whitened(embeddings(spark, [(1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0)])).collect()
    assert sorted(abs(r.whitened) for r in flat if r.component == 1) == [1.0, 1.0]
    assert {r.whitened for r in flat if r.component == 2} == {None}
    # the commonest length counts, the longest of equally common ones
    lengths = [(1, [1.0], 0), (2, [2.0], 0), (3, [1.0, 5.0], 0), (4, [2.0, 3.0], 0), (5, [], 0), (6, [1e300, 1.0], 0)]
    assert {r.vec_id for r in whitening.whitened(embeddings(spark, lengths, "double")).collect()} == {3, 4}
    for rows in ([], [(1, [], 0)], [(1, None, 0)], [(1, [None], 0)]):
        assert whitening.whitened(embeddings(spark, rows)).count() == 0
    named = spark.createDataFrame([("a", [1.0, 2.0], 9), ("b", [4.0, 1.0], 9)], "vec_id string, embedding array<double>, n int")
    assert whitening.whitened(named).where("n = 2").count() == 4
