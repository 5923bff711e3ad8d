"""Whitening of embeddings by spectral divide and conquer.

Sums and the covariance come from the tasks as matrices of the vectors' length, added up by Spark. The
driver, which holds a few matrices of that size, splits the covariance: the polar factor of the
covariance less a shift (by the dynamically weighted Halley iteration) is its matrix sign, so
(I + sign) / 2 projects on the invariant subspace above the shift and (I - sign) / 2 on the one below,
and either is split again until a subspace is one component or a multiple of the identity. The
components, divided by the roots of their variances, go to the tasks, which whiten their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propense.llm.common import stored

#: Entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
#: Entries that large have no place among the whole numbers used here; they count as non-finite.
TOO_LARGE = 2.0**40
EPS = float(np.finfo(np.float64).eps)
SEED = 13
#: Rows that are worked on at once in a task.
ROWS = 4096


def polar(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by the weighted Halley iteration.

    The weights follow a lower bound of the singular values, which moves to 1 in about six rounds; while
    they are large a step is made by QR, later by solving with a positive definite matrix.
    """
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a)
    try:
        low = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, EPS), 1.0) if np.isfinite(low) else EPS
    for _ in range(rounds):
        square = low * low
        root = np.sqrt(1 + np.cbrt(4 * (1 - square) / square**2))
        weight = root**2 - 1
        p = root + 0.5 * np.sqrt(max(8 - 4 * weight + 8 * (2 - square) / (square * root), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            basis, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))
            step = (p - q / r) / np.sqrt(r) * (basis[:n] @ basis[n:].T)
        else:
            step = (p - q / r) * np.linalg.solve(eye + r * (x @ x), x)
        new = q / r * x + step
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        if moved <= np.sqrt(n) * np.cbrt(EPS) and 1 - low <= 10 * EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """Orthogonal matrix whose first ``rank`` columns span the projector's range, the others the rest."""
    basis, _ = np.linalg.qr(projector @ rng.standard_normal(projector.shape))
    for _ in range(2):
        sides = [projector @ basis[:, :rank], basis[:, rank:] - projector @ basis[:, rank:]]
        basis, _ = np.linalg.qr(np.hstack(sides))
    return basis


def _split(a: np.ndarray, tolerance: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """A basis that parts ``a`` into two diagonal blocks, and the size of the first.

    None where ``a`` is a multiple of the identity within the tolerance. A shift that hits an eigenvalue
    leaves the blocks coupled; then others are tried and the least coupled split is taken.
    """
    n = len(a)
    eye = np.eye(n)
    middle = np.trace(a) / n
    spread = np.linalg.norm(a - middle * eye)
    if spread <= tolerance:
        return None
    shifts = [np.median(np.diag(a)), middle]
    shifts += [middle + spread / np.sqrt(n) * t for t in rng.uniform(-0.7, 0.7, 30)]
    best, least = None, np.inf
    for shift in shifts:
        moved = a - shift * eye
        if not moved.any():
            continue
        projector = (polar(moved) + eye) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        basis = _basis(projector, rank, rng)
        coupling = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if coupling < least:
            best, least = (basis, rank), coupling
        if coupling <= tolerance:
            break
    return best


def spectrum(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a symmetric matrix."""
    rng = np.random.default_rng(SEED)
    n = len(covariance)
    tolerance = n * EPS * np.linalg.norm(covariance)
    vectors = np.eye(n)
    work = [(0, (covariance + covariance.T) / 2)]
    while work:
        first, a = work.pop()
        found = _split(a, tolerance, rng) if len(a) > 1 else None
        if found is None:
            continue
        basis, rank = found
        columns = slice(first, first + len(a))
        vectors[:, columns] = vectors[:, columns] @ basis
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2
        work += [(first, inner[:rank, :rank]), (first + rank, inner[rank:, rank:])]
    values = np.einsum("ij,ij->j", vectors, covariance @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Whitening:
    """What is fitted: number of vectors, sums by dimension, components (columns) with their variances."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    total: float
    identity_error: float = 0.0

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _whole(batch: pa.RecordBatch, size: int | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers of the usable rows of a batch, rows of one length at a time."""
    lists = batch.column(1)
    lengths = np.array([-1 if n is None else n for n in lists.value_lengths().to_pylist()], dtype=np.int64)
    for length in np.unique(lengths):
        if length < 1 or size is not None and length != size:
            continue
        some = np.flatnonzero(lengths == length)
        for k in range(0, len(some), ROWS):
            take = pa.array(some[k : k + ROWS])
            entries = lists.take(take).flatten()
            c = entries.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
            with np.errstate(invalid="ignore"):
                good = (np.abs(c) < TOO_LARGE).all(axis=1)
            if good.any():
                x = np.floor(SCALE * c[good]).astype(np.int64) + OFFSET
                yield batch.column(0).take(take).filter(pa.array(good)), x


def _differences(x: np.ndarray, fitted: Whitening) -> np.ndarray:
    """n*x - S, exactly: in 64 bits where they hold it, else as Python numbers."""
    largest = int(np.abs(x).max()) * fitted.n + max(abs(s) for s in fitted.sums)
    kind = np.int64 if largest < 2**62 else object
    return x.astype(kind) * fitted.n - np.array(fitted.sums, dtype=kind)


def _centred(differences: np.ndarray, n: int) -> np.ndarray:
    return differences.astype(np.float64) / n


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sums by dimension, for the most frequent length (of several the longest)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for _, x in _whole(batch, None):
                n, old = sums.get(x.shape[1], (0, [0] * x.shape[1]))
                sums[x.shape[1]] = n + len(x), [a + b for a, b in zip(old, x.sum(axis=0).tolist())]
        for size, (n, values) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array([size] * size, pa.int32()),
                    "i": pa.array(range(size), pa.int32()),
                    "n": pa.array([n] * size, pa.int64()),
                    "s": pa.array(values, pa.decimal128(38, 0)),
                }
            )

    parts = vectors.mapInArrow(add, "size int, i int, n long, s decimal(38,0)")
    totals = stored(parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "whitening-sums")
    most = totals.where("i = 0").orderBy(F.desc("n"), F.desc("size")).select("size").limit(1)
    # one row per dimension
    rows = totals.join(F.broadcast(most), "size").orderBy("i").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def _products(vectors: DataFrame, fitted: Whitening, matrix: np.ndarray) -> np.ndarray:
    """Mean of the products of all pairs of columns of centred rows times ``matrix``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((matrix.shape[1], matrix.shape[1]))
        for batch in batches:
            for _, x in _whole(batch, len(fitted.sums)):
                rows = _centred(_differences(x, fitted), fitted.n) @ matrix
                products += rows.T @ rows
        i, j = np.triu_indices(len(products))
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(products[i, j], pa.float64())}
        )

    parts = vectors.mapInArrow(add, "i int, j int, v double")
    # one number per pair of dimensions
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((matrix.shape[1], matrix.shape[1]))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / fitted.n
    return out


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Components of all usable vectors; None where there is no vector, or all are alike.

    Null and empty vectors and those with null, non-finite or very large (2^40) entries are left out, and
    so are vectors of another length than the most frequent one. Components without variance, to the
    precision of doubles, are none.
    """
    vectors = vectors.select(id_col, vector_col)
    n, sums = _sums(vectors)
    if not n:
        return None
    size = len(sums)
    begun = Whitening(n, tuple(sums), np.zeros(0), np.zeros((size, 0)), 0.0)
    covariance = _products(vectors, begun, np.eye(size))
    values, axes = spectrum(covariance)
    k = int((values[:components] > size * EPS * max(values[0], 0.0)).sum())
    if not k:
        return None
    found = Whitening(n, begun.sums, values[:k], axes[:, :k], float(np.trace(covariance)))
    error = float(np.abs(_products(vectors, found, found.matrix) - np.eye(k)).max())
    return Whitening(n, found.sums, found.values, found.vectors, found.total, error)


COLUMNS = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def apply(vectors: DataFrame, fitted: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors are left out as in ``fit``. Repeated rows and null ids are rows like any other. Only the two
    named columns are read, so others cannot clash.
    """
    size, k = len(fitted.sums), len(fitted.values)
    matrix, explained = fitted.matrix, fitted.values / fitted.total

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _whole(batch, size):
                differences = _differences(x, fitted)
                largest = int(np.abs(differences).max())
                exact = differences if largest**2 * size < 2**62 else differences.astype(object)
                deviation = [int(v) for v in (exact * exact).sum(axis=1)]
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), fitted.n, dtype=np.int64)),
                        pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)),
                        pa.array((_centred(differences, fitted.n) @ matrix).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(each), fitted.identity_error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(id_col, vector_col).mapInArrow(whiten, f"`{id_col}` {kind}, {COLUMNS}")


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``fit`` and ``apply`` in one; without any component the result is empty."""
    fitted = fit(vectors, id_col, vector_col, components)
    if fitted is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, {COLUMNS}")
    return apply(vectors, fitted, id_col, vector_col)
