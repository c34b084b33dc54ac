"""Whitening of embeddings along the leading directions of their covariance.

Rows are centred and reduced by blockwise QR factorisations, first within tasks, then over groups of
tasks, to one square triangle. Its singular values and right vectors are those of all centred rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.llm.bidiagonal import EPS, top_singular
from strikeloom.llm.vectors import batch_of, common_width, integer_vectors, matrix
from strikeloom.sinks.shared import stored

COMPONENTS = 4
SCALE = 256
# Components are taken to be at most this large, so that sums of a task's rows fit a long.
LARGEST = 2**43
# Rows that are reduced at a time, besides the triangle so far.
BLOCK_ROWS = 2048
# Triangles that one task combines.
FAN_IN = 16


@dataclass(frozen=True)
class Whitening:
    """Means as ``sums / n``, unit directions as columns, and the variances along them, falling."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total_variance: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows: centred, projected and divided by the standard deviations."""
        return self.centred(x) @ self.directions / np.sqrt(self.variances)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``; from the exact integers ``n * x - sums`` where they fit a long."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if largest < 2**62:
        return (x * n - np.array(sums, np.int64)) / n
    return x - np.array([s / n for s in sums])


def _column_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension, exact; tasks add up before the shuffle."""
    schema = pa.schema([("dimension", pa.int64()), ("total", pa.int64())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(width + 1, np.int64)
        for batch in batches:
            totals[:width] += matrix(batch["x"], width).sum(0)
            totals[width] += batch.num_rows
        yield batch_of({"dimension": np.arange(width + 1), "total": totals}, schema)

    partial = rows.select("x").mapInArrow(summed, "dimension bigint, total bigint")
    added = partial.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {row.dimension: int(row.total) for row in added.collect()}
    return totals.get(width, 0), [totals.get(d, 0) for d in range(width)]


def _triangle(rows: np.ndarray, width: int) -> np.ndarray:
    """The square triangle of a QR factorisation, with zero rows where there are few rows."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def triangle(rows: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """R of a QR factorisation of all centred rows.

    Each task folds its rows into one triangle, block by block. Triangles are combined by tasks of
    ``FAN_IN`` each, level by level, until one is left: that one is all the driver sees.
    """
    kind = "place bigint, r binary"
    schema = pa.schema([("place", pa.int64()), ("r", pa.binary())])

    def one(place: int, r: np.ndarray) -> pa.RecordBatch:
        return batch_of({"place": [place], "r": [r.tobytes()]}, schema)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, seen = np.zeros((width, width)), False
        for batch in batches:
            x = matrix(batch["x"], width)
            for start in range(0, len(x), BLOCK_ROWS):
                block = _centred(x[start : start + BLOCK_ROWS], n, sums)
                r, seen = _triangle(np.vstack([r, block]), width), True
        if seen:
            yield one(TaskContext.get().partitionId(), r)

    def combined(held: pa.Table) -> pa.Table:
        # In the order of their places, so that a task that is run again gives the same triangle.
        held = held.sort_by("place")
        parts = [np.frombuffer(r, np.float64).reshape(width, width) for r in held["r"].to_pylist()]
        place = held["place"][0].as_py() // FAN_IN
        return pa.Table.from_batches([one(place, _triangle(np.vstack(parts), width))])

    level = stored(rows.select("x").mapInArrow(reduced, kind))
    while level.count() > 1:
        groups = level.groupBy(F.expr(f"place div {FAN_IN}"))
        level = stored(groups.applyInArrow(combined, kind))
    found = level.first()
    return np.frombuffer(found.r, np.float64).reshape(width, width) if found else np.zeros((width, width))


def fitted(rows: DataFrame, width: int, components: int) -> Whitening:
    """Directions of the greatest variance of ``rows`` (x), none along which nothing varies."""
    n, sums = _column_sums(rows, width)
    if not n or not width:
        return Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    r = triangle(rows, width, n, sums)
    values, directions = top_singular(r, min(components, width))
    # What rounding alone can leave of a direction without variance.
    varying = values > values[0] * (width * EPS) ** 2 if len(values) else values > 0
    varying &= values > 0
    values, directions = values[varying], directions[:, varying]
    # Either sign is right; the largest entry is made positive, so that runs agree.
    leading = directions[np.abs(directions).argmax(0), np.arange(len(values))]
    return Whitening(n, sums, directions * np.sign(leading), values / n, float((r**2).sum()) / n)


def _identity_error(rows: DataFrame, width: int, fit: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on all rows."""
    k = len(fit.variances)
    schema = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("total", pa.float64())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row and column hold the sums of the scores themselves.
        products = np.zeros((k + 1, k + 1))
        for batch in batches:
            scores = fit.scores(matrix(batch["x"], width))
            extended = np.hstack([scores, np.ones((len(scores), 1))])
            products += extended.T @ extended
        i, j = np.divmod(np.arange((k + 1) ** 2), k + 1)
        yield batch_of({"i": i, "j": j, "total": products.ravel()}, schema)

    partial = rows.select("x").mapInArrow(summed, "i bigint, j bigint, total double")
    products = np.zeros((k + 1, k + 1))
    for row in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        products[row.i, row.j] = row.total / fit.n
    means = products[:k, k]
    return float(np.abs(products[:k, :k] - np.outer(means, means) - np.eye(k)).max(initial=0.0))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the sum of the squares of ``n * x - sums``, exact; None where no long holds it."""
    rough = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(1)
    # Long arithmetic wraps around, and so is exact wherever the result itself fits.
    wrapped = n % 2**64
    wrapped = np.int64(wrapped - 2**64 if wrapped >= 2**63 else wrapped)
    s = np.array([(v + 2**63) % 2**64 - 2**63 for v in sums], np.int64)
    exact = ((x * wrapped - s) ** 2).sum(1)
    return [int(v) if about < 2**63 * 0.999 else None for v, about in zip(exact, rough)]


def whitened(
    frame: DataFrame,
    identity: str = "vec_id",
    column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> tuple[DataFrame, Whitening]:
    """A row per usable vector and component, and the fit that made them.

    Vectors become integers ``floor(scale * component)``. The fit uses each distinct integer vector
    once: n of them, covariance with divisor n, unit directions to double precision. Rows hold
    ``identity``, component (from 1, by falling variance), n, deviation (the sum over dimensions of
    ``(n * x - sum) ** 2``), whitened, explained (the component's share of all variance) and
    identity_error (one value for all rows, measured on the whitened fit vectors).

    Copies are taken out by a partial aggregate before the only shuffle of vectors, so a vector
    that a third of all rows share is no hot key. Everything else is added up or factorised within
    tasks; the driver sees a triangle and sums of the size of the vectors' width.

    Vectors that are NULL or hold NULL or non-finite components, and those of another length than
    most have (the smaller of two lengths equally frequent), have no row. Components beyond
    ``LARGEST`` count as that bound. A deviation beyond a long is NULL. Directions without variance
    have no rows: one distinct vector gives none. Equal variances share their plane: any two
    orthogonal directions in it are right. Repeated rows get rows each. An empty table gives an
    empty result; other columns are ignored.
    """
    named = frame.select(F.col(identity).alias("_id"), F.col(column).alias("_vector"))
    rows = integer_vectors(named, ("_id",), "_vector", scale, LARGEST)
    width = common_width(rows)
    rows = stored(rows.where((F.size("x") == width) & (F.size("x") > 0)))
    distinct = stored(rows.select("x").distinct())
    fit = fitted(distinct, width, components)
    k = len(fit.variances)
    error = _identity_error(distinct, width, fit) if k else 0.0
    explained = fit.variances / fit.total_variance if k else fit.variances
    kind = dict(rows.dtypes)["_id"]
    result = "_id " + kind + ", component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = matrix(batch["x"], width)
            scores = fit.scores(x)
            deviation = pa.array(_deviations(x, fit.n, fit.sums), pa.int64())
            for c in range(k):
                yield pa.record_batch(
                    {
                        "_id": batch["_id"],
                        "component": pa.array(np.full(len(x), c + 1, np.int32)),
                        "n": pa.array(np.full(len(x), fit.n)),
                        "deviation": deviation,
                        "whitened": pa.array(scores[:, c]),
                        "explained": pa.array(np.full(len(x), explained[c])),
                        "identity_error": pa.array(np.full(len(x), error)),
                    }
                )

    return rows.mapInArrow(projected, result).withColumnRenamed("_id", identity), fit
