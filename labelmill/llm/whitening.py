"""Whitening of embeddings by polarisation.

Entries become whole numbers, so every sum is exact. Tasks sum the squares of
the centred values of each dimension and of the sum of each pair of dimensions;
a pair's variance less the variances of both is twice their covariance. The
matrix so recovered is as large as the square of the dimension, whatever the
number of vectors; its eigenvectors turn and scale the centred vectors to unit
covariance.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.session import stored

SCALE = 256.0
COMPONENTS = 4
# An eigenvalue up to this share of the trace is no spread but rounding.
NO_SPREAD = 1e-12

# Vectors summed at a time. Squares of sums of two entries below SMALL then stay
# within 64 bits; larger entries are summed as Python integers.
PIECE_ROWS = 4096
SMALL = 1 << 20
# Exact sums travel as digits of so many bits; the last one holds the rest.
DIGIT_BITS, DIGITS = 30, 7

_SUMS = ", ".join(["first int", "second int", *[f"digit_{k} long" for k in range(DIGITS)]])


def digits(number: int) -> list[int]:
    low = [(number >> DIGIT_BITS * k) & ((1 << DIGIT_BITS) - 1) for k in range(DIGITS - 1)]
    return [*low, number >> DIGIT_BITS * (DIGITS - 1)]


def exact(values: np.ndarray) -> np.ndarray:
    """As they are if small, else as Python integers."""
    small = not values.size or (values.max() < SMALL and values.min() > -SMALL)
    return values if small else values.astype(object)


def vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS)


def sums_of(values: np.ndarray) -> dict[tuple[int, int], int]:
    """The plain sum of each dimension, as ``(i, -1)``."""
    return {(i, -1): int(s) for i, s in enumerate(exact(values).sum(axis=0))}


def squares_of(centred: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squares of each dimension, ``(i, i)``, and of each sum of two, ``(i, j)``."""
    by_dimension = np.ascontiguousarray(exact(centred).T)
    found = {}
    for i, values in enumerate(by_dimension):
        found[i, i] = int((values * values).sum())
        both = by_dimension[i + 1 :] + values
        for j, square in enumerate((both * both).sum(axis=1), start=i + 1):
            found[i, j] = int(square)
    return found


def _summed(
    fit: DataFrame, dimension: int, of: Callable[[np.ndarray], dict[tuple[int, int], int]]
) -> dict[tuple[int, int], int]:
    """Exact sums over the stored vectors ``x`` of what ``of`` says of some of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for piece in pieces(batches):
            for key, value in of(vectors(piece["x"], dimension)).items():
                total[key] = total.get(key, 0) + value
        if total:
            columns = zip(*[(*key, *digits(value)) for key, value in total.items()])
            kinds = [pa.int32()] * 2 + [pa.int64()] * DIGITS
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SUMS.split(", ")])

    names = [f"digit_{k}" for k in range(DIGITS)]
    rows = (
        fit.mapInArrow(partial, _SUMS)
        .groupBy("first", "second")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toArrow()
    )
    keys = zip(rows["first"].to_pylist(), rows["second"].to_pylist())
    values = zip(*[rows[n].to_pylist() for n in names])
    return {k: sum(d << DIGIT_BITS * at for at, d in enumerate(v)) for k, v in zip(keys, values)}


class Whitening:
    """What the fit list says: its size, sums, and the directions of most spread."""

    def __init__(self, fit: DataFrame, dimension: int, components: int):
        self.n, self.dimension = fit.count(), dimension
        self.components = min(components, dimension)
        if not self.n:
            return
        n = self.n
        sums = _summed(fit, dimension, sums_of)
        self.sums = [sums[i, -1] for i in range(dimension)]
        # Centred at the nearest whole number; the rest, below one, is made up
        # for exactly: sum (n*y - d)^2 = n^2 * sum y^2 - n * d^2 with d = sum y.
        self.centre = [(2 * s + n) // (2 * n) for s in self.sums]
        self.rest = rest = [s - n * c for s, c in zip(self.sums, self.centre)]
        centred = self.centred
        squares = _summed(fit, dimension, lambda values: squares_of(centred(values)))
        covariance = np.zeros((dimension, dimension))
        own = [n * n * squares[i, i] - n * rest[i] ** 2 for i in range(dimension)]
        for (i, j), square in squares.items():
            if i == j:
                covariance[i, i] = own[i] / n**3
            else:
                both = n * n * square - n * (rest[i] + rest[j]) ** 2
                covariance[i, j] = covariance[j, i] = (both - own[i] - own[j]) / (2 * n**3)
        values, directions = np.linalg.eigh(covariance)
        trace = sum(own) / n**3
        self.explained, self.turn = [], np.zeros((dimension, self.components))
        for k in range(self.components):
            value = float(values[-1 - k])
            spread = value > trace * NO_SPREAD
            self.explained.append(max(value, 0.0) / trace if trace else None)
            self.turn[:, k] = directions[:, -1 - k] / math.sqrt(value) if spread else math.nan
        self.spread = [k for k in range(self.components) if not math.isnan(self.turn[0, k])]

    def centred(self, values: np.ndarray) -> np.ndarray:
        values = exact(values)
        far = values.dtype == object or max(map(abs, self.centre)) >= SMALL
        centre = np.array(self.centre, dtype=object if far else np.int64)
        return (values.astype(object) if far else values) - centre

    def whitened(self, values: np.ndarray) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rest])
        return (self.centred(values).astype(float) - mean) @ self.turn

    def deviations(self, values: np.ndarray) -> list[int | None]:
        """The sum over dimensions of ``(n*x - S)^2``; null beyond 64 bits."""
        centred = self.centred(values)
        bound = self.n * (max(int(centred.max()), -int(centred.min())) + 1)
        if bound * bound * self.dimension >= 1 << 62:
            centred = centred.astype(object)
        far = centred * self.n - np.array(self.rest, dtype=centred.dtype)
        found = (far * far).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in found]


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened fit list's covariance less the identity.

    Over the components that have spread; null if none has.
    """
    if not model.spread:
        return None
    names = [f"w{k}" for k in model.spread]

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = model.whitened(vectors(piece["x"], model.dimension))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in model.spread], names)

    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = (
        fit.mapInArrow(whitened, ", ".join(f"{n} double" for n in names))
        .agg(*[F.covar_pop(a, b) for a, b in pairs])
        .first()
    )
    return max(abs(value - (a == b)) for value, (a, b) in zip(found, pairs))


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(vec_id, x)`` of the rows whose vector has only finite entries, in steps of 1/256."""
    entries = F.col(vector_column)
    usable = entries.isNotNull() & F.forall(
        entries,
        lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(math.inf), F.lit(False)),
    )
    return rows.filter(usable).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(entries, lambda c: F.floor(c.cast("double") * F.lit(SCALE))).alias("x"),
    )


def whitened_vectors(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    One row per vector and component, components numbered from 1 by falling
    spread. Rows whose vector is null or holds null or non-finite entries are
    left out; so are those of another length than the commonest (of several,
    the longest), whose missing entries count as null, and empty vectors. The
    model is fitted on every different vector once; ``n`` counts these.
    ``deviation`` is null beyond 64 bits. Entries beyond the range of a long
    become its ends. A component without spread (equal vectors, dimensions that
    hang on each other) has ``whitened`` null and is left out of
    ``identity_error``; with no spread at all ``explained`` and
    ``identity_error`` are null. Null ids and repeated rows pass through; an
    empty table gives an empty result; other columns are not read. The driver
    holds one number for every pair of dimensions.
    """
    usable = whole_vectors(rows, id_column, vector_column).filter(F.size("x") > 0)
    sizes = usable.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    most = sizes.first()
    dimension = most["size"] if most else 1
    usable = usable.filter(F.size("x") == dimension)
    fit = stored(usable.select("x").distinct(), "whitening-fit")
    model = Whitening(fit, dimension, components)
    error = identity_error(fit, model) if model.n else None
    shape = (
        "vec_id long, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            values = vectors(piece["x"], dimension)
            found, many, k = model.whitened(values), len(values), model.components
            again = np.repeat(np.arange(many), k)
            flat = found.ravel()
            columns = [
                piece["vec_id"].take(pa.array(again)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                pa.array(np.full(many * k, model.n, np.int64)),
                pa.array(model.deviations(values), pa.int64()).take(pa.array(again)),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(model.explained * many, pa.float64()),
                pa.array([error] * (many * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in shape.split(", ")])

    return usable.mapInArrow(answer, shape)
