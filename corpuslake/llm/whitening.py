"""Embedding whitening by shifted CholeskyQR: Gram matrices are summed in Spark, small triangles are solved on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Orthogonalising passes at most; two or three do unless the vectors span less than their entries.
PASSES = 6
CLOSE = 1e-13
_ROUNDING = 2.0**-53
#: Rows worked on at a time.
PIECE = 4096


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1), kind), rows.shape[1]).cast(pa.list_(kind))


class Centred:
    """The rows x - S/n, by whole numbers as far as they go: x less the mean's whole part, then less its fraction."""

    def __init__(self, n: int, sums: np.ndarray) -> None:
        self.n = n
        self.base, self.rest = np.divmod(sums, max(n, 1))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n*x - S)^2, exact; None beyond a long."""
        near = x - self.base
        if near.size and (float(np.abs(near).max()) + 1) * self.n < 2.0**31 / near.shape[1] ** 0.5:
            return ((self.n * near - self.rest) ** 2).sum(1).tolist()
        rest = self.rest.tolist()
        exact = (sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in near.tolist())
        return [d if d < 1 << 63 else None for d in exact]


def totals(vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sum of each dimension; one row per dimension comes to the driver."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"))
            n, sums = n + len(x), sums + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(sums), pa.array([n] * size, pa.int64())], names=["i", "s", "n"])

    found = vectors.select("x").mapInArrow(added, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    sums, n = np.zeros(size, np.int64), 0
    for r in found.collect():
        sums[r.i], n = r.s, r.n
    return n, sums


def gram(vectors: DataFrame, centred: Centred, change: np.ndarray, middle: np.ndarray | None = None) -> np.ndarray:
    """Q'Q for the rows Q = (x - S/n) * change, less ``middle`` if given.

    A task sums its own rows and sends a triangle of numbers; triangles are added up by entry in Spark.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((centred, change, middle))
    size = change.shape[1]
    upper = np.triu_indices(size)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred, change, middle = shared.value
        total, some = np.zeros((size, size)), False
        for batch in batches:
            x = _matrix(batch.column("x"))
            for at in range(0, len(x), PIECE):
                q = centred(x[at : at + PIECE]) @ change
                q = q if middle is None else q - middle
                total += q.T @ q
                some = True
        if some:
            i, j = upper
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[upper])], names=["i", "j", "g"])

    # At most size * (size + 1) / 2 rows come to the driver.
    found = vectors.select("x").mapInArrow(added, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros((size, size))
    for r in found.collect():
        out[r.i, r.j] = out[r.j, r.i] = r.g
    return out


def _solved(r: np.ndarray) -> np.ndarray:
    """The inverse of an upper triangle, column by column."""
    size = len(r)
    out = np.zeros((size, size))
    for j in range(size):
        out[j, j] = 1 / r[j, j]
        for i in range(j - 1, -1, -1):
            out[i, j] = -(r[i, i + 1 : j + 1] @ out[i + 1 : j + 1, j]) / r[i, i]
    return out


def factor(vectors: DataFrame, centred: Centred, size: int) -> np.ndarray:
    """R with R'R = A'A for the centred rows A.

    The first Gram matrix is shifted, so that its Cholesky factor exists however ill-conditioned the rows are. Each
    further pass makes Q from the rows by a triangular solve, takes the factor of Q'Q and multiplies it on, until Q is
    orthonormal to working precision. Directions without any spread stay without: a Gram matrix that has no
    factor is shifted again, and what is left at the end is taken up by its symmetric root.
    """
    whole, change = np.eye(size), np.eye(size)
    for turn in range(PASSES):
        g = gram(vectors, centred, change)
        if turn and np.abs(g - np.eye(size)).max() < CLOSE * max(1.0, size):
            break
        shift = 11 * (centred.n * size + size * (size + 1)) * _ROUNDING * np.trace(g)
        shift = min(shift, 1e-3 * np.trace(g) / size)
        try:
            if not turn:
                g = g + shift * np.eye(size)
            r = np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            if shift <= 0 or turn >= 2:
                break
            r = np.linalg.cholesky(g + shift * np.eye(size)).T
        whole = r @ whole
        change = change @ _solved(r)
    else:
        g = gram(vectors, centred, change)
    value, vector = np.linalg.eigh(g)
    return (vector * np.sqrt(np.maximum(value, 0))).T @ whole


def components_of(r: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance by falling size, and its unit eigenvectors as columns, from the factor's singular values.

    Directions whose spread is nothing but rounding are left out. The largest entry of a vector is positive.
    """
    _, spread, v = np.linalg.svd(r)
    kept = spread > spread.max(initial=0.0) * len(r) * 1e-13
    v = v[kept].T
    sign = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])]) if v.size else np.ones(v.shape[1])
    return spread[kept] ** 2 / n, v * sign


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries c become the whole numbers x = floor(scale * c) + offset. Components are the unit eigenvectors of x's covariance (divisor
    n) by falling eigenvalue e; ``whitened`` is x less the mean, projected on the component, over sqrt(e); ``explained`` is e over
    the sum of all; ``deviation`` is the exact sum over dimensions of (n*x - S)^2, NULL where that exceeds a long;
    ``identity_error`` is the largest entry of the covariance of what is returned, less the identity, one value for all.

    Vectors that are NULL, empty, or hold NULL or non-finite entries, or entries beyond 2^31 once scaled, take no part, nor do
    those whose length is not the commonest one (of equally common ones the greatest). Repeated rows and rows with
    equal or NULL keys count and are returned each by itself. Without spread in any direction (no rows, one row, equal
    rows) there is no component and so no row. The driver holds a few matrices of the vectors' length.
    """
    valid = rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").cast("array<double>").alias("__c"))
    sound = F.forall("__c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < float(1 << 31)))
    valid = valid.filter(F.col("__c").isNotNull() & (F.size("__c") > 0) & sound)
    x = F.transform("__c", lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    vectors = staged(valid.select(F.col(key).alias("id"), x.alias("x")), "vectors")
    lengths = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).first()
    kind = vectors.schema["id"].dataType.simpleString()
    names = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double"
    if lengths is None:
        return rows.sparkSession.createDataFrame([], names + ", identity_error double")
    size = lengths["size"]
    vectors = vectors.filter(F.size("x") == size)

    n, sums = totals(vectors, size)
    centred = Centred(n, sums)
    r = factor(vectors, centred, size)
    value, change = components_of(r, n)
    explained = (value / (r**2).sum() * n)[:components]
    change = change[:, :components] / np.sqrt(value[:components])
    width = change.shape[1]
    if not width:
        return rows.sparkSession.createDataFrame([], names + ", identity_error double")
    # Whitened rows are centred but for rounding; their own mean is taken off before they are multiplied all the same.
    middle = means(vectors, centred, change)
    error = float(np.abs(gram(vectors, centred, change, middle) / n - np.eye(width)).max())
    shared = rows.sparkSession.sparkContext.broadcast((centred, change, explained))

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred, change, explained = shared.value
        for batch in batches:
            x, ids = _matrix(batch.column("x")), batch.column("id")
            for at in range(0, len(x), PIECE):
                part = x[at : at + PIECE]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), pa.array(centred.deviations(part), pa.int64()), _lists(centred(part) @ change, pa.float64())],
                    names=["id", "deviation", "whitened"],
                )

    out = vectors.mapInArrow(applied, f"id {kind}, deviation long, whitened array<double>")
    share = F.array(*[F.lit(float(e)) for e in explained])
    out = out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )


def means(vectors: DataFrame, centred: Centred, change: np.ndarray) -> np.ndarray:
    """Means of the rows (x - S/n) * change."""
    shared = vectors.sparkSession.sparkContext.broadcast((centred, change))
    size = change.shape[1]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred, change = shared.value
        sums, some = np.zeros(size), False
        for batch in batches:
            x = _matrix(batch.column("x"))
            for at in range(0, len(x), PIECE):
                sums, some = sums + (centred(x[at : at + PIECE]) @ change).sum(0), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(sums)], names=["i", "s"])

    out = np.zeros(size)
    for r in vectors.select("x").mapInArrow(added, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r.i] = r.s / centred.n
    return out
