"""Whitening of embeddings; the leading components by slicing the spectrum of their covariance.

Vectors become whole numbers first, so equal vectors are exactly equal. The covariance is
that of the *distinct* vectors: sums and products are combined in each task, and only
matrices of the size of the dimension reach the driver, where the components are found.

A symmetric matrix less a shift has as many positive pivots in its LDL' factors as it has
eigenvalues above the shift. Halving an interval by such counts isolates each leading
eigenvalue with its number; Rayleigh quotient iteration then converges cubically, and
counts on both sides of what it found certify the number. An iteration that ran to another
eigenvalue fails the certificate, and the interval is halved further.

Cases: vectors that are null or empty, hold null or non-finite entries, or entries whose
number does not fit a long, are left out; so are vectors of another length than most
distinct vectors have (the greater length on a tie). Rows that share an id or a vector stay
rows of their own, and a null id stays null. Where the vectors vary in fewer directions
than asked for, there are fewer components; an empty table has no rows. A deviation
beyond a long is null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed, small_batches

SCALE = 256
COMPONENTS = 4
LIMB_BITS, LIMBS = 21, 3
LARGEST = float(1 << 53)  # entries up to this size fit a long after scaling
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors, their exact sums, and the components (one per column) by falling variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


# ---- the spectrum of a symmetric matrix


def positive_pivots(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above the shift: the inertia of the LDL' factors of what is left.

    Pivots are of size one or two, chosen so that the factors' growth is bounded
    (Bunch and Kaufman); a block of two whose determinant is negative has one of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    ratio, above, k, n = (1 + np.sqrt(17)) / 8, 0, 0, len(matrix)

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q], :] = a[[q, p], :]
            a[:, [p, q]] = a[:, [q, p]]

    while k < n:
        diagonal = abs(a[k, k])
        below = np.abs(a[k + 1:, k])
        largest = below.max(initial=0.0)
        if largest == 0.0:
            above += a[k, k] > 0
            k += 1
            continue
        r = k + 1 + int(below.argmax())
        size = 1
        if diagonal < ratio * largest:
            column = np.abs(a[k:, r])
            column[r - k] = 0.0
            widest = column.max()
            if diagonal * widest < ratio * largest * largest:
                if abs(a[r, r]) >= ratio * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        rest = slice(k + size, n)
        if size == 1:
            above += a[k, k] > 0
            a[rest, rest] -= np.outer(a[rest, k], a[rest, k]) / a[k, k]
        else:
            block = a[k:k + 2, k:k + 2]
            above += 1 if np.linalg.det(block) < 0 else 2 * int(np.trace(block) > 0)
            a[rest, rest] -= a[rest, k:k + 2] @ np.linalg.solve(block, a[k:k + 2, rest])
        k += size
    return int(above)


def _iterated(matrix: np.ndarray, shift: float, found: list[np.ndarray], scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration, started by two steps of inverse iteration at the shift."""
    n = len(matrix)
    vector = np.random.default_rng(n).standard_normal(n)

    def apart(v: np.ndarray) -> np.ndarray:
        for other in found:
            v = v - (other @ v) * other
        return v / np.linalg.norm(v)

    def solved(at: float, v: np.ndarray) -> np.ndarray:
        for step in range(60):
            try:
                w = np.linalg.solve(matrix - at * np.eye(n), v)
                if np.isfinite(w).all():
                    return w
            except np.linalg.LinAlgError:
                pass
            at += scale * EPS * 2.0**step
        return v

    vector = apart(vector)
    for _ in range(2):
        vector = apart(solved(shift, vector))
    value = vector @ matrix @ vector
    best = (np.inf, value, vector)
    for _ in range(50):
        left = np.linalg.norm(matrix @ vector - value * vector)
        if left < best[0]:
            best = (left, value, vector)
        elif best[0] <= 64 * n * EPS * scale:
            break
        vector = apart(solved(value, vector))
        value = vector @ matrix @ vector
    return best[1], best[2]


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues that are not zero, falling, and their unit vectors as columns.

    Eigenvalues too close for any count to part them are taken together: then the vectors
    span their common space.
    """
    n = len(matrix)
    radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal()) if n else np.zeros(0)
    low, high = float((matrix.diagonal() - radius).min(initial=0.0)), float((matrix.diagonal() + radius).max(initial=0.0))
    scale = max(abs(low), abs(high))
    blur = 16 * n * EPS * scale
    floor = 64 * n * EPS * scale
    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < min(wanted, n):
        number = len(values) + 1
        lo, hi = low - blur, high + blur
        while True:
            # halve until the interval holds this eigenvalue alone, or nothing parts it from the next
            while hi - lo > blur and (positive_pivots(matrix, lo) > number or positive_pivots(matrix, hi) >= number):
                middle = (lo + hi) / 2
                if positive_pivots(matrix, middle) >= number:
                    lo = middle
                else:
                    hi = middle
            value, vector = _iterated(matrix, (lo + hi) / 2, vectors, scale)
            certified = positive_pivots(matrix, value - blur) >= number > positive_pivots(matrix, value + blur)
            if certified or hi - lo <= blur:
                break
            middle = (lo + hi) / 2
            if positive_pivots(matrix, middle) >= number:
                lo = middle
            else:
                hi = middle
        if value <= floor:
            break
        values.append(value)
        vectors.append(vector)
    if not values:
        return np.zeros(0), np.zeros((n, 0))
    columns = np.column_stack(vectors)
    # one sign for all rows: the largest entry is positive
    columns *= np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(columns.shape[1])])
    return np.array(values), columns


# ---- vectors as whole numbers


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def whole_vectors(rows: DataFrame, vector_column: str) -> DataFrame:
    """The rows with a usable vector, with it as whole numbers in column ``x``."""
    vector = F.col(vector_column)
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")))
    return rows.filter(vector.isNotNull() & (F.size(vector) > 0) & usable).withColumn("x", _whole(vector))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


# ---- sums over all tasks


def _combined(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all vectors of ``part``, a matrix per batch: summed in each task, then row by row."""
    schema = f"i int, v array<{kind}>"

    def out(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = pa.array(list(total.values()), pa.list_(pa.int64() if kind == "bigint" else pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], names=["i", "v"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            yield out(dict(enumerate(total)))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)) if batch.num_rows else ()):
                total[i] = total[i] + v if i in total else v
        yield out(total)

    gathered = rows.select("x").mapInArrow(summed, schema).repartition("i").mapInArrow(added, schema)
    return np.array([r["v"] for r in gathered.orderBy("i").collect()])


def _limbs(x: np.ndarray) -> np.ndarray:
    """Sums per dimension in three parts of 21 bits, each far from overflow."""
    mask = (1 << LIMB_BITS) - 1
    parts = [x & mask, (x >> LIMB_BITS) & mask, x >> (2 * LIMB_BITS)]
    return np.array([p.sum(axis=0) for p in parts])


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray | None]:
    """x less the mean, and n x - sums exactly where that fits a long in each dimension."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most < 1 << 62:
        exact = n * x - np.array(sums, np.int64)
        if most < 1 << 53:
            return exact / n, exact
        return x - np.array([s / n for s in sums]), exact
    return x - np.array([s / n for s in sums]), None


def _squares(x: np.ndarray, exact: np.ndarray | None, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - sums) squared."""
    if exact is not None and x.shape[1] * int(np.abs(exact).max(initial=0)) ** 2 < 1 << 63:
        return (exact * exact).sum(axis=1).tolist()
    found = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in found]


def fit(rows: DataFrame, vector_column: str, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the distinct vectors' covariance; None where there are none."""
    small_batches(rows.sparkSession)
    distinct = landed(
        whole_vectors(rows, vector_column).select("x").distinct().withColumn("size", F.size("x")), "distinct-vectors"
    )
    most = distinct.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return None
    n, fitted = most["count"], distinct.filter(F.col("size") == most["size"])
    limbs = _combined(fitted, _limbs, "bigint")
    sums = tuple(sum(int(limb) << (LIMB_BITS * k) for k, limb in enumerate(column)) for column in limbs.T)

    def products(x: np.ndarray) -> np.ndarray:
        y, _ = _centred(x, n, sums)
        return y.T @ y

    covariance = _combined(fitted, products, "double") / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    if not len(values):
        return None

    def projected(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, sums)[0] @ vectors / np.sqrt(values)

    mean = _combined(fitted, lambda x: projected(x).sum(axis=0, keepdims=True), "double")[0] / n

    def again(x: np.ndarray) -> np.ndarray:
        y = projected(x) - mean
        return y.T @ y

    error = float(np.abs(_combined(fitted, again, "double") / n - np.eye(len(values))).max())
    return Whitening(n, sums, vectors, values, float(np.trace(covariance)), error)


def whitened(rows: DataFrame, id_column: str, vector_column: str, model: Whitening | None) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component."""
    id_type = rows.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k, size = len(model.values), len(model.sums)
    shares = model.values / model.trace

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(1))
        y, exact = _centred(x, model.n, model.sums)
        values = y @ model.vectors / np.sqrt(model.values)
        each = pa.array(np.repeat(np.arange(len(x)), k))
        columns = [
            batch.column(0).take(each),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            pa.array(np.full(len(x) * k, model.n, np.int64)),
            pa.array(_squares(x, exact, model.n, model.sums), pa.int64()).take(each),
            pa.array(values.ravel()),
            pa.array(np.tile(shares, len(x))),
            pa.array(np.full(len(x) * k, model.identity_error)),
        ]
        names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield one(batch)

    usable = whole_vectors(rows.select(id_column, vector_column), vector_column).filter(F.size("x") == size)
    return usable.select(id_column, "x").mapInArrow(run, schema)
