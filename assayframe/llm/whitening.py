"""Whitening of vectors by shifted CholeskyQR.

With A the centred rows, one distributed pass sums the Gram matrix of A; its Cholesky factor,
of the matrix shifted a little so that it exists however ill-conditioned A is, makes the rows
nearly orthonormal by a triangular solve. Further passes repeat this without a shift on the
rows as they are by then (Fukaya, Kannan, Nakatsukasa, Yamamoto and Yanagisawa, 2020). The
factors multiplied give R of A = QR, and the singular values and right vectors of R are those
of A: squaring A's condition number, as its covariance would, is avoided.

Spread and bounds. A pass is narrow: a task adds up one matrix over its batches, in blocks, and
sends that on once; entries are summed by Spark, map side first. The driver gets one matrix of
width x width numbers a pass, whatever the number of rows. Sums of rows and ``deviation`` are
whole numbers and exact. Every row counts in every pass.

Vectors that are null, empty or hold null or non-finite entries take no part. Shorter vectors
are filled up with zeros. Directions in which all rows agree can't be whitened: components
whose eigenvalue is below ``RANK`` of the largest are left out, so equal rows, a single one or
none give no rows. Equal eigenvalues have no order of their own; their components are one
orthonormal choice. Repeated rows and null keys count and are returned like others. Values
whose whole numbers would not fit 64 bits raise OverflowError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .vectors import matrix_of

#: Components that are returned, factor and offset of the whole numbers.
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Passes after the shifted one, eigenvalues below this share of the largest count as zero.
PASSES, RANK = 2, 1e-13
_BLOCK = 2048
_MOST = float(1 << 62)


def whole(values: np.ndarray, scale: float = SCALE, shift: int = SHIFT) -> np.ndarray:
    """floor(scale * value) + shift as 64-bit numbers."""
    scaled = np.floor(scale * values)
    if len(scaled) and np.abs(scaled).max(initial=0.0) > _MOST / 4:
        raise OverflowError("a component is too large for a 64-bit whole number")
    return scaled.astype(np.int64) + shift


@dataclass
class Rows:
    """How a batch becomes whole-number rows; ``n`` rows and their sums once these are known."""

    width: int
    scale: float
    shift: int
    n: int = 0
    sums: np.ndarray | None = None

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        good, values = matrix_of(column)
        full = np.zeros((len(good), self.width))
        full[:, :values.shape[1]] = values[:, :self.width]
        return good, whole(full, self.scale, self.shift)

    def away(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums: n times the centred rows, exact."""
        if len(x) and float(np.abs(x).max()) * self.n > _MOST / 2:
            raise OverflowError("rows times components do not fit 64-bit whole numbers")
        return x * np.int64(self.n) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.away(x) / self.n


def _total(vectors: DataFrame, column: str, fold: Callable[[pa.Array], np.ndarray],
           size: int, kind: str) -> np.ndarray:
    """Sum over all batches of what ``fold`` gives, ``size`` numbers of type long or double."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64 if kind == "long" else np.float64)
        for batch in batches:
            total += fold(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(total.dtype)))],
            names=["part"])

    parts = vectors.select(column).mapInArrow(run, f"part array<{kind}>")
    table = parts.select(F.posexplode("part").alias("at", "value")).groupBy("at") \
        .agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    out[table["at"].to_numpy()] = table["value"].to_numpy()
    return out


def _gram(vectors: DataFrame, column: str, rows: Rows, factors: list[np.ndarray],
          turn: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after a triangular solve with each factor (and, if
    ``turn`` is given, multiplied with it)."""
    width = rows.width if turn is None else turn.shape[1]

    def fold(batch: pa.Array) -> np.ndarray:
        _, x = rows.read(batch)
        total = np.zeros((width, width))
        for i in range(0, len(x), _BLOCK):
            q = solve(rows.centred(x[i:i + _BLOCK]), factors)
            if turn is not None:
                q = q @ turn
            total += q.T @ q
        return total.ravel()

    return _total(vectors, column, fold, width * width, "double").reshape(width, width)


def solve(block: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``block`` times the inverse of each upper triangular factor, by substitution."""
    for r in factors:
        out = np.empty_like(block)
        for j in range(block.shape[1]):
            out[:, j] = (block[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        block = out
    return block


def factor(gram: np.ndarray, shift: float) -> np.ndarray | None:
    """The upper Cholesky factor of a shifted Gram matrix, None if there is none."""
    try:
        return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        return None


def root(gram: np.ndarray) -> np.ndarray:
    """W with W'W = gram, for one without a Cholesky factor: rows that do not span all."""
    value, vector = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(value, 0.0))[:, None] * vector.T


@dataclass
class Whitening:
    """Components (columns) of the rows that were fitted, by falling eigenvalue.

    ``trace`` is that of the covariance, ``spread`` the largest absolute entry of R'R after
    the last pass minus the identity (how far the rows are from orthonormal)."""

    rows: Rows
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    spread: float

    def weights(self, most: int) -> np.ndarray:
        rank = int((self.eigenvalues > RANK * self.eigenvalues.max(initial=0.0)).sum()) \
            if self.rows.n else 0
        k = min(most, rank)
        return self.components[:, :k] / np.sqrt(self.eigenvalues[:k])


def fit(vectors: DataFrame, column: str = "embedding", scale: float = SCALE, shift: int = SHIFT,
        passes: int = PASSES) -> Whitening:
    """Fits all rows of ``vectors``: one pass for sums, one shifted and ``passes`` more."""
    width = vectors.agg(F.max(F.size(column))).first()[0] or 0
    rows = Rows(max(width, 0), scale, shift)

    def fold(batch: pa.Array) -> np.ndarray:
        _, x = rows.read(batch)
        if len(x) and float(np.abs(x).max()) * len(x) > _MOST:
            raise OverflowError("sums of components do not fit 64-bit whole numbers")
        return np.append(x.sum(0), len(x))

    # Sums of tasks are added by Spark, which raises where they leave 64 bits.
    total = _total(vectors, column, fold, rows.width + 1, "long")
    rows.n, rows.sums = int(total[-1]), total[:-1]
    none = np.zeros((rows.width, rows.width))
    if rows.n == 0 or rows.width == 0:
        return Whitening(rows, np.zeros(rows.width), none, 0.0, 0.0)
    gram = first = _gram(vectors, column, rows, [])
    unit, d = np.finfo(float).eps / 2, rows.width
    # All further Cholesky factors exist if the rows have full rank and this shift was made.
    factors = []
    moved = 11 * (rows.n * d + d * (d + 1)) * unit * np.trace(gram)
    r = factor(gram, max(min(moved, 1e-3 * np.trace(gram)), np.finfo(float).tiny))
    for _ in range(passes):
        factors.append(r)
        gram = _gram(vectors, column, rows, factors)
        r = factor(gram, 0.0)
        if r is None:
            break
    composed = root(gram) if r is None else r
    for f in reversed(factors):
        composed = composed @ f
    _, singular, right = np.linalg.svd(composed)
    sign = np.sign(right[np.arange(d), np.abs(right).argmax(1)])
    return Whitening(rows, singular ** 2 / rows.n, (right * sign[:, None]).T,
                     float(np.trace(first)) / rows.n, float(np.abs(gram - np.eye(d)).max()))


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id",
           components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT,
           passes: int = PASSES) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened,
    explained, identity_error. Other columns aren't read, so their names can't clash.

    Entries become floor(scale * entry) + shift, centred by the mean over all rows.
    ``deviation`` is the sum over dimensions of (n * x - sums) squared. ``identity_error`` is
    measured by one more pass over the whitened rows.
    """
    model = fit(vectors, column, scale, shift, passes)
    rows, turn = model.rows, model.weights(components)
    k = turn.shape[1]
    error = 0.0
    if k:
        error = float(np.abs(_gram(vectors, column, rows, [], turn) / rows.n - np.eye(k)).max())
    share = model.eigenvalues[:k] / model.trace if k else np.zeros(0)
    kind = vectors.schema[key].dataType.simpleString()
    schema = (f"{key} {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, x = rows.read(batch.column(1))
            for i in range(0, len(good) if k else 0, _BLOCK):
                away = rows.away(x[i:i + _BLOCK])
                if (away.astype(np.float64) ** 2).sum(1).max() > _MOST:
                    raise OverflowError("deviations do not fit 64-bit whole numbers")
                out = (away / rows.n) @ turn
                m = len(out)
                place = np.repeat(good[i:i + _BLOCK], k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(place)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, rows.n)),
                     pa.array(np.repeat((away * away).sum(1), k)),
                     pa.array(out.ravel()), pa.array(np.tile(share, m)),
                     pa.array(np.full(m * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return vectors.select(key, column).mapInArrow(run, schema)
