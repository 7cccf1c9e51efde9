"""Whitening of embeddings by mixed-precision eigenvectors of a distributed covariance.

Entries become whole numbers, x = floor(SCALE * c) + OFFSET. Sums of x are exact; the covariance
is summed over the rows centred by the whole number next to the mean, and the rest of the
mean, below one half, is taken off exactly, so no large numbers cancel. Every partial sum
carries its rounding error along (two doubles a number), so the order of rows does not show
in the covariance.

The driver holds the covariance alone, whose size is that of one vector squared. Its
eigenvectors are found in float32, then corrected by Ogita-Aishima iterations: matrix
products in float64, each split so that what cancels is exact. Eigenvalues that lie too
close for the correction formula form clusters; each is solved anew as a small problem,
shifted to its own centre, where float32 again tells its members apart.
"""

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import session_scratch

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries whose whole number leaves this range have no exact place in a long.
LARGEST = 2.0**61
# Entries of vectors held as numbers at once in a task.
HELD = 1 << 19


class Eigen(NamedTuple):
    values: np.ndarray
    vectors: np.ndarray
    rounds: int


def _leading(m: np.ndarray, axis: int, bits: int) -> np.ndarray:
    """The leading bits of each entry, counted from the largest of its row (axis 1) or column (axis 0)."""
    most = np.abs(m).max(axis=axis, keepdims=True)
    unit = np.exp2(np.ceil(np.log2(np.where(most > 0, most, 1))) + 53 - bits)
    return (m + unit) - unit


def product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a @ b as an exact part and the rest: about 20 bits more than float64 keeps.

    The leading bits of both are so few that their products and sums are exact in float64.
    """
    bits = max(4, (52 - math.ceil(math.log2(max(2, a.shape[1])))) // 2)
    a_lead, b_lead = _leading(a, 1, bits), _leading(b, 0, bits)
    return a_lead @ b_lead, a_lead @ (b - b_lead) + (a - a_lead) @ b


def refine_once(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: corrected vectors, eigenvalues, correction, and the least gap it handles."""
    exact, rest = product(x.T, x)
    r = (np.eye(len(a)) - exact) - rest
    turned, turned_rest = product(a, x)
    exact, rest = product(x.T, turned)
    s = exact + (rest + x.T @ turned_rest)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    gap = 2 * (np.linalg.norm(off) + np.linalg.norm(a) * np.linalg.norm(r))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    correction = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ correction, values, correction, gap


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Positions of eigenvalues whose neighbours by size are within `gap`."""
    order = np.argsort(values)
    breaks = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, breaks) if len(c) > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned to the eigenvectors of the small problem they span.

    Shifted by the mean of its eigenvalues and scaled, the small matrix shows differences
    far below the float32 resolution of the whole one.
    """
    part = x[:, members]
    centre = np.diag(part.T @ (a @ part)).mean()
    small = part.T @ (a @ part - centre * part)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if not size > 0:
        return part
    _, turn = np.linalg.eigh((small / size).astype(np.float32))
    turn = turn.astype(np.float64)
    # float32 rotations are orthogonal to seven digits; one step brings them near the rest
    turn = turn + turn @ (np.eye(len(members)) - turn.T @ turn) / 2
    return part @ turn


def eigenvectors(a: np.ndarray, most: int = 12) -> Eigen:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The largest entry of each vector by size is positive (ties: the first). Steps end when
    the correction no longer halves, after `most` at the latest: eigenvalues that double
    precision can't tell apart have no vectors of their own to converge to.
    """
    n = len(a)
    largest = np.abs(a).max() if n else 0.0
    if not largest > 0:
        return Eigen(np.zeros(n), np.eye(n), 0)
    scale = 2.0 ** math.ceil(math.log2(largest))
    scaled = a / scale
    _, start = np.linalg.eigh(scaled.astype(np.float32))
    x, rounds, size = start.astype(np.float64), 0, math.inf
    while rounds < most:
        rounds += 1
        x, values, correction, gap = refine_once(scaled, x)
        for members in _clusters(values, gap):
            x[:, members] = _solve_cluster(scaled, x, members)
        before, size = size, float(np.abs(correction).max())
        if size <= np.finfo(np.float64).eps or (size <= 1e-6 and size > before / 2):
            break
    x, values, _, _ = refine_once(scaled, x)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    values, x = values[order] * scale, x[:, order]
    x *= np.where(x[np.abs(x).argmax(axis=0), np.arange(n)] < 0, -1.0, 1.0)
    return Eigen(values, x, rounds)


def _whole(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number entries of the usable vectors, one length at a time and at most `HELD` entries."""
    ids, vectors = batch.column(0), batch.column(1)
    sizes = np.asarray(vectors.value_lengths().fill_null(-1))
    for size in np.unique(sizes[sizes >= 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, HELD // max(1, size))
        for at in range(0, len(rows), step):
            picked = pa.array(rows[at : at + step])
            flat = vectors.take(picked).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            entries = np.floor(flat * SCALE).reshape(len(picked), size)
            usable = (np.abs(entries) < LARGEST).all(axis=1)  # NULL and NaN compare as false
            if usable.any():
                yield ids.take(picked).filter(pa.array(usable)), entries[usable].astype(np.int64) + OFFSET


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


class Totals(NamedTuple):
    n: int
    sums: list[int]


def totals(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> Totals:
    """Number of usable vectors and exact sums of their entries, over the commonest length (ties: the longest)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for _, x in _whole(batch):
                size = x.shape[1]
                # halves of 32 bits, so that no sum of a slice leaves a long
                low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
                own = [(int(h) << 32) + int(l) for h, l in zip(high, low, strict=True)] + [len(x)]
                sums[size] = [p + q for p, q in zip(sums.get(size, [0] * (size + 1)), own, strict=True)]
        for size, own in sums.items():
            whole = pa.array([str(v) for v in own]).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * (size + 1), pa.int32()), pa.array(range(size + 1), pa.int32()), whole],
                ["size", "place", "total"],
            )

    found = _usable(vectors, vec_id, vector).mapInArrow(work, "size int, place int, total decimal(38,0)")
    # the place behind the last entry counts the vectors
    sums = session_scratch(vectors.sparkSession).store(found.groupBy("size", "place").agg(F.sum("total").alias("total")))
    chosen = sums.where("place = size").agg(F.max(F.struct("total", "size")).alias("best")).first().best
    if chosen is None:
        return Totals(0, [])
    values = {r.place: int(r.total) for r in sums.where(F.col("size") == chosen["size"]).collect()}
    return Totals(values[chosen["size"]], [values[p] for p in range(chosen["size"])])


def _add(total: np.ndarray, lost: np.ndarray, more: np.ndarray) -> None:
    """Add to a sum of two doubles a number, keeping what rounding loses."""
    grown = total + more
    part = grown - total
    lost += (total - (grown - part)) + (more - part)
    total[...] = grown


def centres(found: Totals) -> tuple[list[int], np.ndarray]:
    """Per dimension the whole number next to the mean, and the rest of the mean, in (-0.5, 0.5]."""
    whole = [round(Fraction(s, found.n)) for s in found.sums]
    rest = [float(Fraction(s, found.n) - c) for s, c in zip(found.sums, whole, strict=True)]
    return whole, np.array(rest)


def covariance(vectors: DataFrame, found: Totals, vec_id: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """Covariance of the whole-number vectors, divisor n.

    Each task sums its own products, one row a dimension leaves it, and the rows of a
    dimension meet in one task as they stream by.
    """
    size = len(found.sums)
    whole, rest = centres(found)
    centre = np.array(whole, np.int64)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lost = np.zeros((size, size)), np.zeros((size, size))
        seen = False
        for batch in batches:
            for _, x in _whole(batch):
                if x.shape[1] == size:
                    seen = True
                    y = (x - centre).astype(np.float64)
                    _add(total, lost, y.T @ y)
        if seen:
            yield _matrix_rows(np.arange(size), total, lost)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                total, lost = sums.setdefault(row["place"], (np.zeros(size), np.zeros(size)))
                _add(total, lost, np.array(row["total"]))
                _add(total, lost, np.array(row["lost"]))
        for place, (total, lost) in sums.items():
            yield _matrix_rows(np.array([place]), total[None, :], lost[None, :])

    schema = "place int, total array<double>, lost array<double>"
    parts = _usable(vectors, vec_id, vector).mapInArrow(partial, schema)
    rows = parts.repartition("place").mapInArrow(merged, schema)
    products = np.zeros((size, size), np.longdouble)
    for row in session_scratch(vectors.sparkSession).store(rows).collect():
        products[row.place] = np.array(row.total, np.longdouble) + np.array(row.lost, np.longdouble)
    shift = rest.astype(np.longdouble)
    return (products / found.n - np.outer(shift, shift)).astype(np.float64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def _matrix_rows(places: np.ndarray, total: np.ndarray, lost: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(places, pa.int32()), _lists(total), _lists(lost)], ["place", "total", "lost"]
    )


def _deviations(x: np.ndarray, found: Totals) -> list[int]:
    """Per row the exact sum of (n * x - S) squared."""
    size = x.shape[1]
    reach = max((abs(found.n * int(x.max()) - min(found.sums)), abs(found.n * int(x.min()) - max(found.sums))), default=0)
    if reach * reach * max(1, size) < 1 << 62:
        far = found.n * x - np.array(found.sums, np.int64)
        return (far * far).sum(axis=1).tolist()
    far = found.n * x.astype(object) - np.array(found.sums, object)
    return (far * far).sum(axis=1).tolist()


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per usable vector and component: vec_id, component, n, deviation, deviation_digits, whitened,
    eigenvalue, explained, identity_error.

    Left out are vectors that are NULL, that hold a NULL, a non-finite entry or one whose whole
    number leaves a long, and vectors of another length than the commonest (ties: the
    longest), as those have no place in one covariance. Repeated rows count each; a NULL id
    stays NULL; other columns are not read. There are at most as many components as
    dimensions, and none for vectors without entries or an empty table. A component without
    variance (also: all vectors alike) has `whitened` NULL and no part in `identity_error`;
    `explained` is NULL where no component has variance. `deviation` is NULL where it leaves a
    long; `deviation_digits` always has it whole. `identity_error` is measured on the
    whitened rows themselves.
    """
    spark = vectors.sparkSession
    found = totals(vectors, vec_id, vector)
    chosen = _usable(vectors, vec_id, vector)
    kind = chosen.schema["vec_id"].dataType.simpleString()
    size, n = len(found.sums), found.n
    if not size:
        return chosen.limit(0).selectExpr(
            "vec_id", "0 component", "0L n", "0L deviation", "'' deviation_digits", "0D whitened",
            "0D eigenvalue", "0D explained", "0D identity_error",
        )
    v = covariance(vectors, found, vec_id, vector)
    eigen = eigenvectors(v)
    trace = float(np.trace(v))
    kept = min(components, size)
    values = eigen.values[:kept]
    live = values > max(trace, 0.0) * size * np.finfo(np.float64).eps
    turn = eigen.vectors[:, :kept] / np.sqrt(np.where(live, values, 1.0))
    whole, rest = centres(found)
    centre = np.array(whole, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _whole(batch):
                if x.shape[1] != size:
                    continue
                rows = ((x - centre).astype(np.float64) - rest) @ turn
                digits = _deviations(x, found)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([d if d < 1 << 63 else None for d in digits], pa.int64()),
                        pa.array([str(d) for d in digits]),
                        _lists(np.where(live, rows, np.nan)),
                    ],
                    ["vec_id", "deviation", "deviation_digits", "rows"],
                )

    stored = session_scratch(spark).store(
        chosen.mapInArrow(work, f"vec_id {kind}, deviation long, deviation_digits string, rows array<double>")
    )
    error = _identity_error(stored, np.flatnonzero(live))
    known = F.create_map(*[F.lit(e) for c in range(kept) for e in (c, float(values[c]))])
    value = F.element_at(known, F.col("place"))
    return stored.select(
        "vec_id", "deviation", "deviation_digits", F.posexplode("rows").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "deviation_digits",
        F.when(~F.isnan("whitened"), F.col("whitened")).alias("whitened"),
        value.alias("eigenvalue"),
        (value / F.lit(trace) if trace > 0 else F.lit(None).cast("double")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(stored: DataFrame, live: np.ndarray) -> float | None:
    """Largest entry, by size, of the covariance of the whitened rows minus the identity."""
    if not len(live):
        return None
    at = [int(c) for c in live]
    means = stored.agg(*[F.avg(F.col("rows")[c]).alias(f"m{c}") for c in at]).first()
    moved = {c: F.col("rows")[c] - F.lit(means[f"m{c}"]) for c in at}
    pairs = [(i, j) for i in at for j in at if i <= j]
    sums = stored.agg(*[F.avg(moved[i] * moved[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"p{i}_{j}"] - (i == j)) for i, j in pairs)
