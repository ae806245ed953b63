"""Whitened components of vectors: principal axes to double precision, each scaled to variance one.

Every entry c becomes the whole number floor(1024 * c) + 100000, so the sums that centre the vectors are
exact.  The covariance is a sum of matrices, one a batch, of rows that were centred before they were
multiplied; the matrices of a task are added there, those of all tasks in a grouping by row number, and
the driver gets one matrix, whose size is that of a vector squared.

Its eigenvectors are found in mixed precision.  A float32 solver gives a first basis.  Ogita and
Aishima's refinement then works with matrix products in extended precision alone, each made of
exact products of sliced doubles: from the basis X,
the defect of orthogonality R = I - X'X and the matrix in that basis S = X'AX follow better eigenvalues
and a correction X + XE, and each step doubles the correct digits.  It cannot tell eigenvalues apart
that lie closer than the error of the basis.  Columns of such a cluster are turned among themselves by
the eigenvectors of their own small block, shifted by the cluster's mean and solved in double precision,
before the next step.

Rows without a vector, or whose vector holds a null, a NaN or an infinity, take no part and get no row;
nor do vectors of another length than most (of equally many the longer).  Empty vectors have no
component.  Entries beyond 2^38 count as 2^38.  Equal vectors, and rows that come several times,
each get their rows; null ids stay null.  Components whose variance is not above rounding have no scale
and are left out, as are all of them if the vectors are all equal; no vectors, no rows.  Columns other
than the id and the vector are not read and may have any name.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

_SCALE, _SHIFT = 1024, 100_000
_BEYOND = float(1 << 48)  # 2^38 * 1024: sums of 4,096 entries stay within 64 bits
_ROWS = 4096

# Extended precision where the machine has it; else double, which still refines float32.
_HIGH = np.longdouble
_EPS = max(float(np.finfo(_HIGH).eps), 2.0**-58)
_SLICES = 3


class Basis(NamedTuple):
    """Where the fitted vectors lie: ``axes`` has unit columns by falling ``variances``."""

    n: int
    sums: list[int]
    variances: np.ndarray
    axes: np.ndarray
    total_variance: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    own = F.col(vector)
    finite = F.forall(own, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(own.isNotNull() & finite)


def _whole(entries: pa.Array, dimensions: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of whole numbers."""
    flat = entries.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(_SCALE * flat), -_BEYOND, _BEYOND).astype(np.int64) + _SHIFT
    return whole.reshape(-1, dimensions)


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            if part.num_rows and len(part.column(column).flatten()):
                yield part


def _of_length(vectors: DataFrame, vector: str, dimensions: int) -> DataFrame:
    return usable(vectors, vector).filter(F.size(vector) == dimensions)


def sums(vectors: DataFrame, vector: str = "embedding") -> tuple[int, list[int]]:
    """How many vectors of the most frequent length there are, and their exact sums."""

    def add(batches):
        found: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            lengths = np.diff(batch.column(0).offsets.to_numpy())
            for length in np.unique(lengths[lengths > 0]).tolist():
                own = batch.filter(pa.array(lengths == length))
                for part in _parts(iter([own]), 0):
                    n, total = found.get(length, (0, [0] * length))
                    whole = _whole(part.column(0), length).sum(axis=0).tolist()
                    found[length] = n + part.num_rows, [a + b for a, b in zip(total, whole)]
        for length, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * length), pa.array([n] * length), pa.array(range(length)), pa.array(map(str, total))],
                names=["length", "n", "place", "total"],
            )

    own = usable(vectors, vector).select(vector)
    parts = own.mapInArrow(add, "length long, n long, place long, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    added = parts.groupBy("length", "place").agg(F.sum("n").alias("n"), total)
    packed = F.array_sort(F.collect_list(F.struct("place", "total"))).alias("totals")
    best = added.groupBy("length").agg(F.max("n").alias("n"), packed)
    found = best.orderBy(F.desc("n"), F.desc("length")).first()
    return (found["n"], [int(t["total"]) for t in found["totals"]]) if found else (0, [])


def _second_moments(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of one ``size`` x ``size`` matrix a row of ``parts``: ``line, entries``."""
    added = parts.select("line", F.posexplode("entries").alias("place", "value"))
    summed = added.groupBy("line", "place").agg(F.sum("value").alias("value")).groupBy("line").agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("entries")
    )
    matrix = np.zeros((size, size))
    for row in summed.toLocalIterator():
        matrix[row["line"]] = [entry["value"] for entry in row["entries"]]
    return matrix


def _matrix_rows(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(matrix))), pa.array(matrix.tolist(), pa.list_(pa.float64()))], names=["line", "entries"]
    )


def _centred(whole: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """``whole`` minus the mean, which is subtracted as a whole number first and its rest after."""
    floors = np.array([t // n for t in totals], np.int64)
    return (whole - floors) - np.array([t % n / n for t in totals])


def covariance(vectors: DataFrame, n: int, totals: list[int], vector: str = "embedding") -> np.ndarray:
    size = len(totals)

    def multiply(batches):
        moments = np.zeros((size, size))
        for part in _parts(batches, 0):
            rows = _centred(_whole(part.column(0), size), n, totals)
            moments += rows.T @ rows
        yield _matrix_rows(moments)

    parts = _of_length(vectors, vector, size).select(vector).mapInArrow(multiply, "line long, entries array<double>")
    return _second_moments(parts, size) / n


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of values that follow one another closer than ``gap``, of two and more."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, ends) if len(part) > 1]


def _slices(matrix: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """Doubles that add up to ``matrix``, each with ``bits`` bits below the largest of its row or column."""
    left, found = matrix, []
    for _ in range(_SLICES):
        most = np.abs(left).max(axis=axis, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(most > 0, most, 1))) - bits).astype(_HIGH)
        whole = np.rint(left / unit) * unit
        found.append(whole.astype(np.float64))
        left = left - whole
    return found


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` in extended precision out of products of doubles that are exact.

    The slices have so few bits that no product of two of them, nor a sum of these, is rounded; what
    the last slices leave out is below the precision asked for.  So the work is done by the double
    precision matrix product of the machine, whatever the size.
    """
    bits = (52 - int(np.ceil(np.log2(max(a.shape[1], 2))))) // 2
    left, right = _slices(a, 1, bits), _slices(b, 0, bits)
    total = np.zeros((a.shape[0], b.shape[1]), _HIGH)
    for places in range(_SLICES - 1, -1, -1):  # small terms first
        for i in range(places + 1):
            total += left[i] @ right[places - i]
    return total


def _orthogonal(axes: np.ndarray) -> np.ndarray:
    """The nearest basis of unit columns at right angles, by Newton's iteration on matrix products."""
    one = np.eye(axes.shape[1], dtype=_HIGH)
    for _ in range(60):
        defect = one - product(axes.T, axes)
        axes = axes + product(axes, defect) / 2
        if np.abs(defect).max() < 4 * len(axes) * _EPS:
            break
    return axes


def refined(matrix: np.ndarray, axes: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix from an approximate basis of its eigenvectors."""
    a, x = matrix.astype(_HIGH), _orthogonal(axes.astype(_HIGH))
    one = np.eye(len(a), dtype=_HIGH)
    size = float(np.abs(a).sum(axis=1).max())
    for _ in range(steps):
        ax = product(a, x)
        defect, inside = one - product(x.T, x), product(x.T, ax)
        values = np.diag(inside) / (1 - np.diag(defect))
        off = inside - np.diag(values)
        error = 2 * (float(np.sqrt((off * off).sum())) + size * float(np.sqrt((defect * defect).sum())))
        gap = max(error, len(a) * _EPS * size)
        close = np.abs(values[:, None] - values[None, :]) <= gap
        apart = np.where(close, one[0, 0], values[None, :] - values[:, None])
        step = np.where(close, defect / 2, (inside + values[None, :] * defect) / apart)
        x = x + product(x, step)
        for cluster in _clusters(np.asarray(values, np.float64), gap):
            own = _orthogonal(x[:, cluster])
            middle = values[cluster].mean()
            block = product(own.T, product(a, own) - middle * own)
            scale = np.abs(block).max()
            if scale > 0:
                turn = np.linalg.eigh(np.asarray((block + block.T) / (2 * scale), np.float64))[1]
                own = product(own, _orthogonal(turn.astype(_HIGH)))
            x[:, cluster] = own
        if float(np.abs(step).max()) < 8 * len(a) * _EPS:
            break
    x = _orthogonal(x)
    return np.diag(product(x.T, product(a, x))), x


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, to double precision."""
    scale = np.abs(matrix).max() or 1.0
    low = (matrix / scale).astype(np.float32)
    values, axes = refined(matrix / scale, np.linalg.eigh(low)[1].astype(np.float64))
    order = np.argsort(-values, kind="stable")
    return np.asarray(values[order] * scale, np.float64), np.asarray(axes[:, order], np.float64)


def fitted(vectors: DataFrame, vector: str = "embedding") -> Basis | None:
    """The basis of all usable vectors; None if there are none.  Reads them twice."""
    n, totals = sums(vectors, vector)
    if not n:
        return None
    matrix = covariance(vectors, n, totals, vector)
    values, axes = eigen((matrix + matrix.T) / 2)
    floor = values[0] * len(values) * np.finfo(np.float64).eps * 16
    kept = values > max(floor, 0.0)
    return Basis(n, totals, values[kept], axes[:, kept], float(np.trace(matrix)))


def _projection(basis: Basis, components: int) -> np.ndarray:
    chosen = slice(0, components)
    return basis.axes[:, chosen] / np.sqrt(basis.variances[chosen])


def _deviations(whole: np.ndarray, n: int, totals: list[int]) -> list[int]:
    """The exact sum over dimensions of (n * x - S)^2."""
    far = n * max(int(np.abs(whole).max()), 1) + max(map(abs, totals), default=0)
    kind = np.int64 if far * far * max(len(totals), 1) < 1 << 62 else object
    apart = whole.astype(kind) * n - np.array(totals, kind)
    return (apart * apart).sum(axis=1).tolist()


def whitened(
    vectors: DataFrame, basis: Basis, components: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The key, the ``deviation`` (decimal) and the ``whitened`` components of each usable vector."""
    n, totals, project = basis.n, basis.sums, _projection(basis, components)
    kind = vectors.schema[key].dataType.simpleString()

    def turn(batches):
        for part in _parts(batches, 1):
            whole = _whole(part.column(1), len(totals))
            turned = (_centred(whole, n, totals) @ project).tolist()
            exact = pa.array(map(str, _deviations(whole, n, totals)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), exact, pa.array(turned, pa.list_(pa.float64()))], names=["key", "deviation", "whitened"]
            )

    own = _of_length(vectors, vector, len(totals)).select(F.col(key), F.col(vector))
    made = own.mapInArrow(turn, f"key {kind}, deviation string, whitened array<double>")
    return made.select(F.col("key").alias(key), F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"), "whitened")


def identity_error(vectors: DataFrame, basis: Basis, components: int, vector: str = "embedding") -> float:
    """The largest entry of the covariance of the whitened components minus the identity, from all rows.

    The components are centred on their own means before they are multiplied.
    """
    n, totals, project = basis.n, basis.sums, _projection(basis, components)
    size, length = project.shape[1], len(totals)
    if not size:
        return 0.0
    own = _of_length(vectors, vector, length).select(vector)

    def total(batches):
        added = np.zeros((1, size))
        for part in _parts(batches, 0):
            added += (_centred(_whole(part.column(0), length), n, totals) @ project).sum(axis=0)
        yield _matrix_rows(added)

    means = own.mapInArrow(total, "line long, entries array<double>")
    means = means.select(*(F.sum(F.col("entries")[i]).alias(str(i)) for i in range(size)))
    centre = np.array([value or 0.0 for value in (means.first() or Row())]) / n

    def multiply(batches):
        moments = np.zeros((size, size))
        for part in _parts(batches, 0):
            rows = _centred(_whole(part.column(0), length), n, totals) @ project - centre
            moments += rows.T @ rows
        yield _matrix_rows(moments)

    moments = _second_moments(own.mapInArrow(multiply, "line long, entries array<double>"), size)
    return float(np.abs(moments / n - np.eye(size)).max())


def components_of(
    vectors: DataFrame, components: int, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component: ``<key>, component, n, deviation, whitened, explained,
    identity_error``.  ``deviation`` is a long, null where the exact sum needs more than 64 bits.
    """
    basis = fitted(vectors, vector)
    kind = vectors.schema[key].dataType.simpleString()
    if basis is None or not len(basis.variances):
        schema = (f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
                  "identity_error double")
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, basis, components, vector)
    shares = basis.variances[:components] / basis.total_variance
    made = whitened(vectors, basis, components, key, vector)
    each = made.select(F.col(key).alias("key"), "deviation", F.posexplode("whitened").alias("place", "value"))
    return each.select(
        F.col("key").alias(key), (F.col("place") + 1).cast("int").alias("component"), F.lit(basis.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"), F.col("value").alias("whitened"),
        F.element_at(F.array(*map(F.lit, shares.tolist())), F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
