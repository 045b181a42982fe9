"""Whitening of vectors by QDWH spectral divide and conquer of their covariance.

Sums and cross products of all vectors are added up by tasks; only one row per dimension
comes to the driver, which takes the covariance apart. The polar factor of the covariance,
shifted by a value between its eigenvalues, has eigenvalues 1 and -1. It is found by the
dynamically weighted Halley iteration in its QR form, and gives projectors on the two
invariant subspaces. Each is taken apart in the same way until one eigenvalue is left.
The components are sent to all tasks, which project their vectors on them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = np.finfo(float).eps
RESULT = "component int, n long, deviation long, whitened double, explained double"


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric ``matrix`` that is not singular."""
    n = len(matrix)
    one = np.eye(n)
    x = matrix / np.linalg.norm(matrix)
    # A lower bound of the least singular value; one that is too small costs few rounds.
    low = max(EPS, 1 / (np.linalg.norm(np.linalg.inv(x)) or np.inf))
    for _ in range(12):
        # Weights that move all singular values in [low, 1] closest to 1.
        square = low * low
        root = np.cbrt(4 * (1 - square) / square**2)
        a = np.sqrt(1 + root)
        a += np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - square) / (square * np.sqrt(1 + root)))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
        new = (b / c) * x + (a - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (a + b * square) / (1 + c * square))
        if moved <= np.cbrt(5 * EPS) and 1 - low <= 10 * EPS:
            break
    # The last digits, by one step of Newton and Schulz.
    return x @ (3 * one - x @ x) / 2


def _halves(matrix: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis, whose first columns span what lies above ``shift``, and their number."""
    n = len(matrix)
    try:
        sign = polar_factor(matrix - shift * np.eye(n))
    except np.linalg.LinAlgError:
        return None
    if not np.isfinite(sign).all():
        return None
    above = round((np.trace(sign) + n) / 2)
    if not 0 < above < n:
        return None
    upper = (np.eye(n) + sign) / 2
    lower = np.eye(n) - upper
    basis = np.random.default_rng(n).standard_normal((n, n))
    for _ in range(2):
        parts = [upper @ basis[:, :above], lower @ basis[:, above:]]
        basis, _ = np.linalg.qr(np.hstack([np.linalg.qr(p)[0] for p in parts]))
    return basis, above


def _shifts(matrix: np.ndarray) -> list[float]:
    """Values to split at: between the diagonal's entries, the middle and the widest gaps first."""
    diagonal = np.sort(np.diag(matrix))
    gaps = np.diff(diagonal)
    best = np.argsort(-gaps, kind="stable")[:6]
    middle = np.median(diagonal)
    spread = np.linalg.norm(matrix - np.mean(diagonal) * np.eye(len(matrix))) / len(matrix)
    between = [float(diagonal[i] + gaps[i] / 2) for i in best if gaps[i] > 0]
    around = [float(middle + k * spread) for k in (0.0, 0.1, -0.1, 0.37, -0.37, 0.71, -0.71)]
    return [around[0], *between, *around[1:], float(np.mean(diagonal))]


def _split(matrix: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(matrix)
    middle = np.trace(matrix) / n
    if n == 1 or np.linalg.norm(matrix - middle * np.eye(n)) <= least:
        return np.diag(matrix).copy(), np.eye(n)
    best = None
    for shift in _shifts(matrix):
        found = _halves(matrix, shift)
        if found is None:
            continue
        basis, above = found
        turned = basis.T @ matrix @ basis
        # What couples the halves: rounding alone where the shift is not an eigenvalue.
        rest = np.linalg.norm(turned[:above, above:])
        if best is None or rest < best[0]:
            best = rest, basis, above, (turned + turned.T) / 2
        if rest <= 4 * least:
            break
    if best is None:
        raise ArithmeticError("no shift takes the matrix apart")
    _, basis, above, turned = best
    values, vectors = [], np.zeros((n, n))
    for part in (slice(0, above), slice(above, n)):
        value, vector = _split(turned[part, part], least)
        values.append(value)
        vectors[:, part] = basis[:, part] @ vector
    return np.concatenate(values), vectors


def _refined(matrix: np.ndarray, vectors: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """One step that takes out, to first order, what couples vectors of different eigenvalues."""
    vectors = vectors @ (3 * np.eye(len(matrix)) - vectors.T @ vectors) / 2
    turned = vectors.T @ matrix @ vectors
    values = np.diag(turned)
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > 2**20 * least
    turn = np.where(apart, turned / np.where(apart, gaps, 1.0), 0.0)
    vectors = vectors @ (np.eye(len(matrix)) + (turn - turn.T) / 2)
    vectors = vectors @ (3 * np.eye(len(matrix)) - vectors.T @ vectors) / 2
    return np.einsum("ij,ik,kj->j", vectors, matrix, vectors, optimize=True), vectors


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric ``matrix``, falling, and the unit vectors as columns."""
    least = EPS * np.linalg.norm(matrix)
    values, vectors = _split((matrix + matrix.T) / 2, least)
    values, vectors = _refined(matrix, vectors, least)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


class Components(NamedTuple):
    """What is fitted: sums of the rounded vectors, and components by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float


def _points(vectors: pa.Array, dimensions: int, scale: int, offset: int) -> np.ndarray:
    """``floor(scale * entry) + offset`` of each entry; entries beyond a vector's end count as 0."""
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
    if len(flat) and np.abs(flat).max() * scale > 2.0**40:
        raise OverflowError("an entry is too large to be rounded to a long")
    rounded = np.floor(scale * flat).astype(np.int64)
    points = np.zeros((len(lengths), dimensions), dtype=np.int64)
    points[np.arange(dimensions) < lengths[:, None]] = rounded
    return points + offset


def _centred(points: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * point - sum``, exact."""
    if float(np.abs(points).max(initial=0)) * n >= 2.0**63:
        raise OverflowError("too many rows for exact sums in a long")
    return n * points - sums


def usable(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector and all of its entries are there and finite."""
    entries = F.col(vector).cast("array<double>")
    wrong = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vector).isNotNull() & ~wrong)


def _added(rows: DataFrame) -> np.ndarray:
    """The sum of the arrays ``part`` of each ``dimension``, by dimension; adds up in tasks.

    ``rows`` holds one row per task and dimension. The arrays of one dimension meet in one
    task, one at a time.
    """

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = batch.column("part")
            for at, dimension in enumerate(batch.column("dimension").to_pylist()):
                part = np.asarray(parts[at].values)
                held[dimension] = held[dimension] + part if dimension in held else part
        dimensions = sorted(held)
        yield pa.RecordBatch.from_pylist(
            [{"dimension": d, "part": held[d]} for d in dimensions], rows_schema
        )

    rows_schema = pa.schema([("dimension", pa.int32()), ("part", pa.list_(pa.float64()))])
    found = rows.repartition("dimension").mapInArrow(add, rows.schema).collect()
    return np.array([r["part"] for r in sorted(found, key=lambda r: r["dimension"])])


def _cross_products(df: DataFrame, vector: str, width: int, rows_of) -> np.ndarray:
    """Sum over all rows of the outer products of ``rows_of(vectors)``, ``width`` wide."""

    def multiply(batches):
        held = np.zeros((width, width))
        for batch in batches:
            rows = rows_of(batch.column(0))
            held += rows.T @ rows
        parts = pa.ListArray.from_arrays(
            pa.array(np.arange(width + 1, dtype=np.int32) * width), pa.array(held.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), parts], ["dimension", "part"]
        )

    parts = df.select(vector).mapInArrow(multiply, "dimension int, part array<double>")
    return _added(parts)


def fit(
    df: DataFrame, vector: str = "embedding", *, most: int = 32, scale: int = 64, offset: int = 1_000_000
) -> Components | None:
    """Components of the covariance of all usable rows; None if they have no spread.

    Vectors are rounded to ``floor(scale * entry) + offset``. Shorter ones than the longest are
    filled up with zeros. Only the first ``most`` components with an eigenvalue above rounding are kept.
    """
    rows = usable(df, vector).select(F.col(vector).cast("array<double>").alias("v"))
    n, dimensions = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n or not dimensions:
        return None

    def sums(batches):
        held = np.zeros(dimensions, dtype=np.int64)
        for batch in batches:
            held += _points(batch.column(0), dimensions, scale, offset).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(held)], ["dimension", "s"]
        )

    added = rows.mapInArrow(sums, "dimension int, s long").groupBy("dimension").agg(F.sum("s"))
    # One row per dimension.
    total = np.array([s for _, s in sorted(map(tuple, added.collect()))], dtype=np.int64)

    def centred(vectors):
        return _centred(_points(vectors, dimensions, scale, offset), n, total) / n

    covariance = _cross_products(rows, "v", dimensions, centred) / n
    if not covariance.any():
        return None
    values, vectors = eigenvectors(covariance)
    kept = values[:most] > 16 * dimensions * EPS * values[0]
    number = int(kept.sum())
    return Components(n, total, values[:number], vectors[:, :number], float(np.trace(covariance)))


def whiten(
    df: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    most: int = 32,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """One row per usable vector and component, with the columns of ``RESULT`` after ``key``.

    ``deviation`` is the exact sum of ``(n * point - sum)^2``; ``whitened`` the centred point's part along the
    component over the root of its eigenvalue, ``explained`` that eigenvalue's share of all, and
    ``identity_error`` how far the covariance of all whitened rows is from the identity
    at most. Vectors that are null, or hold null or non-finite entries, give nothing. A shorter vector than
    the longest counts as filled up with zeros. Components without spread (eigenvalue 0, up to rounding) are
    left out, so one row, equal rows, empty vectors and empty tables give nothing. Rows that repeat or lack
    a key are rows like any other; further columns are passed over. Entries whose rounded
    sums do not fit a long raise an OverflowError.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {RESULT}, identity_error double"
    rows = usable(df, vector).select(key, F.col(vector).cast("array<double>").alias("_vector"))
    found = fit(rows, "_vector", most=most, scale=scale, offset=offset)
    if found is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(found)
    number = len(found.values)

    def project(vectors):
        n, sums, values, components, _ = shared.value
        apart = _centred(_points(vectors, len(sums), scale, offset), n, sums)
        return apart, apart / n @ components / np.sqrt(values)

    def with_one(vectors):
        # The column of ones makes the sums that the covariance is centred by.
        whitened = project(vectors)[1]
        return np.column_stack([np.ones(len(whitened)), whitened])

    products = _cross_products(rows, "_vector", number + 1, with_one) / found.n
    means = products[0, 1:]
    error = np.abs(products[1:, 1:] - np.outer(means, means) - np.eye(number)).max()

    def whitened(batches):
        _, _, values, _, total = shared.value
        explained = values / total
        for whole in batches:
            # At most so many result rows at a time.
            step = max(1, (1 << 18) // max(number, len(shared.value.sums)))
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                apart, projected = project(batch.column(1))
                size = len(apart)
                if size and (apart.astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
                    raise OverflowError("too many rows for exact deviations in a long")
                deviation = (apart * apart).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(np.arange(size), number))),
                        pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * number, shared.value.n)),
                        pa.array(np.repeat(deviation, number)),
                        pa.array(projected.ravel()),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.full(size * number, error)),
                    ],
                    [key, *[c.split()[0] for c in RESULT.split(", ")], "identity_error"],
                )

    return rows.mapInArrow(whitened, schema)
