"""Embedding whitening: components of the covariance by QDWH spectral divide and conquer.

Sums and centred products of all vectors are gathered in tasks and added up by Spark; what reaches the
driver is one number per dimension, then one per pair of dimensions. There the covariance is split: the
polar factor of the covariance less a shift (QR- and Cholesky-based dynamically weighted Halley steps)
gives the projector on the subspace of all eigenvalues above the shift; bases of it and of its
complement split the matrix in two smaller ones, and so on, until they are diagonal. The components, a
few numbers per dimension, go out to the tasks that whiten the rows.

Vectors are made whole numbers first (`entry`), so sums, and the distances from the mean scaled by the
number of rows, are exact.

Defined cases: null vectors, those with null or non-finite entries, empty ones and those of another length
than the commonest (ties: the longer) take no part; entries beyond 2^31 after scaling count as 2^31; repeated rows and
null ids are kept; a component without variance has a null value (and no variance at all a null share);
a deviation beyond 64 bits is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import store

SCALE, SHIFT = 1024, 100_000
BOUND = float(1 << 31)
COMPONENTS = 8
EPS = float(np.finfo(float).eps)


def entry(c: Column) -> Column:
    scaled = F.least(F.greatest(F.lit(float(SCALE)) * c.cast("double"), F.lit(-BOUND)), F.lit(BOUND))
    return F.floor(scaled).cast("bigint") + F.lit(SHIFT)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that take part, and their length."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = sizes["size"] if sizes else 0
    return rows.filter(F.size(v) == length).select("vec_id", F.transform(v, entry).alias("x")), length


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def sums(rows: DataFrame, length: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, np.int64)
        for batch in batches:
            n += batch.num_rows
            total += _matrix(batch.column(0), length).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["cell", "total"])

    found = rows.select("x").mapInArrow(add, "cell int, total bigint").groupBy("cell").agg(F.sum("total").alias("total")).collect()
    by_cell = {r.cell: r.total for r in found}
    return by_cell.get(-1, 0), np.array([by_cell.get(i, 0) for i in range(length)], np.int64)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return (n * x - total) / float(n)


def covariance(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Over all rows, centred before multiplying. A task adds up its products, Spark adds up the tasks."""
    length = len(total)
    upper = np.triu_indices(length)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((length, length))
        for batch in batches:
            part = _centred(_matrix(batch.column(0), length), n, total)
            out += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(out[upper])], ["cell", "total"])

    found = rows.select("x").mapInArrow(products, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((length, length))
    for r in found:
        out[upper[0][r.cell], upper[1][r.cell]] = r.total / n
    return np.triu(out) + np.triu(out, 1).T


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix: the same eigenvectors, eigenvalues 1 and -1. QDWH steps."""
    size = len(a)
    one = np.eye(size)
    x = a / np.linalg.norm(a)
    try:
        least = 1 / (np.linalg.norm(np.linalg.inv(x)) or np.inf)
    except np.linalg.LinAlgError:
        least = EPS
    least = min(1.0, max(least, EPS))
    for _ in range(30):
        square = least * least
        d = np.cbrt(4 * (1 - square) / square**2)
        wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:size] @ q[size:].T
        else:
            root = np.linalg.cholesky(one + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(root.T, np.linalg.solve(root, x.T)).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        least = min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if moved <= np.cbrt(4 * EPS) and 1 - least <= 10 * EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """Orthonormal columns that span a projector: its columns in order of what they add."""
    left, basis = projector.copy(), np.zeros((len(projector), rank))
    for k in range(rank):
        column = left[:, np.argmax((left**2).sum(axis=0))]
        for _ in range(2):
            column = column - basis[:, :k] @ (basis[:, :k].T @ column)
        basis[:, k] = column / np.linalg.norm(column)
        left -= np.outer(basis[:, k], basis[:, k] @ left)
    return basis


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces, the one with the greater eigenvalues first; None if none can be told apart."""
    size, diagonal = len(a), np.sort(np.diag(a))
    one, best = np.eye(size), None
    spread = np.linalg.norm(a - np.diag(np.diag(a)), 2) or 1.0
    middle = (diagonal[(size - 1) // 2] + diagonal[size // 2]) / 2
    for shift in (middle, diagonal.mean(), *(diagonal.mean() + s * spread for s in (0.1, -0.1, 0.37, -0.37))):
        factor = polar_factor(a - shift * one)
        rank = int(round((np.trace(factor) + size) / 2))
        if not 0 < rank < size:
            continue
        q, _ = np.linalg.qr(np.hstack([_basis((one + factor) / 2, rank), _basis((one - factor) / 2, size - rank)]))
        apart = np.linalg.norm(q[:, rank:].T @ a @ q[:, :rank])
        if best is None or apart < best[0]:
            best = apart, q[:, :rank], q[:, rank:]
        if apart <= 10 * size * EPS * np.linalg.norm(a):
            break
    return best and best[1:]


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    scale = np.linalg.norm(a)
    found: list[tuple[float, np.ndarray]] = []

    def divide(block: np.ndarray, basis: np.ndarray) -> None:
        if len(found) >= wanted:  # all that is left has smaller eigenvalues
            return
        size = len(block)
        off = np.linalg.norm(block - np.diag(np.diag(block)))
        halves = split(block) if off > size * EPS * scale else None
        if halves is None:
            order = np.argsort(-np.diag(block), kind="stable")
            found.extend((float(block[i, i]), basis[:, i]) for i in order)
            return
        for half in halves:
            part = half.T @ block @ half
            divide((part + part.T) / 2, basis @ half)

    if len(a):
        divide(a, np.eye(len(a)))
    vectors = np.array([v for _, v in found]).reshape(-1, len(a)).T
    vectors /= np.linalg.norm(vectors, axis=0) if vectors.size else 1.0
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors) if vectors.size else np.zeros(0)
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    heaviest = np.abs(vectors).argmax(axis=0) if vectors.size else []
    return values, vectors * np.sign([vectors[h, j] or 1.0 for j, h in enumerate(heaviest)]) if vectors.size else vectors


@dataclass(frozen=True)
class Whitening:
    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def varying(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.values > len(self.total) * EPS * max(self.trace, 0.0)

    def explained(self) -> list[float | None]:
        return [max(float(e), 0.0) / self.trace if self.trace > 0 else None for e in self.values]


def fit(rows: DataFrame, length: int, wanted: int = COMPONENTS) -> Whitening:
    """From all rows (vec_id, x)."""
    n, total = sums(rows, length)
    if not n:
        return Whitening(0, total, np.zeros(0), np.zeros((length, 0)), 0.0)
    spread = covariance(rows, n, total)
    values, vectors = components(spread, min(wanted, length))
    return Whitening(n, total, values, vectors, float(np.trace(spread)))


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, z): z has one value for each component."""
    length, varying = len(model.total), model.varying
    turn = model.vectors / np.sqrt(np.where(varying, model.values, 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), length)
            far = model.n * x - model.total
            fits = (far.astype(float) ** 2).sum(axis=1) < 2.0**63 * (1 - 1e-9)
            deviation = pa.array((far * far).sum(axis=1), mask=~fits)
            z = (far / float(model.n)) @ turn
            flat = pa.array(z.ravel(), mask=np.tile(~varying, len(z)))
            lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["vec_id", "deviation", "z"])

    return rows.mapInArrow(run, "vec_id bigint, deviation bigint, z array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows less the identity, over components that vary."""
    used = [i for i, v in enumerate(model.varying) if v]
    if not used:
        return None
    z = {i: F.col("z")[i] for i in used}
    mean = whitened.agg(*(F.avg(z[i]).alias(f"m{i}") for i in used)).first()
    pairs = [(i, j) for i in used for j in used if i <= j]
    found = whitened.agg(*(F.avg((z[i] - F.lit(mean[f"m{i}"])) * (z[j] - F.lit(mean[f"m{j}"]))) for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whitened_rows(vectors: DataFrame, wanted: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    rows, length = usable(vectors, vec_id, embedding)
    model = fit(rows, length, wanted)
    done = whiten(rows, model) if model.n else rows.selectExpr("vec_id", "0L as deviation", "cast(array() as array<double>) as z")
    done = store(done, "whitened")
    share = F.array(*(F.lit(e).cast("double") for e in model.explained())).cast("array<double>")
    error = F.lit(identity_error(done, model)).cast("double")
    parts = done.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return parts.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        share[F.col("at")].alias("explained"), error.alias("identity_error"),
    )
