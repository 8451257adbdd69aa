"""Operator 12: whitening of embeddings from a covariance by polarisation.

Components become whole numbers x = floor(64 * c) + 1000000. Two passes aggregate the data: sums, which give a centre;
then, for each dimension and for the sum of each pair of dimensions, the squares of what is left after centring. Both are
sums of whole numbers and exact. Since var(a + b) = var(a) + var(b) + 2 cov(a, b), the differences of these variances are
all covariances. The matrix, whose size is fixed by the dimensions, goes to ``eigh`` on the driver; a third pass projects
the rows. Tasks stream Arrow batches and hold sums only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
# Entries from here on have no whole number in 64 bits and count as not finite.
_TOO_LARGE = float(2**56)
_WIDE = pa.decimal128(38, 0)
_LONG = 1 << 62


def whole_numbers(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and x, an array of longs, of all rows whose vector can be used.

    Left out are vectors that are null or empty, that hold null or non-finite entries or such of 2**56 and more, and those
    of another length than most have (of equally frequent lengths the longest stays).
    """
    def fit(entry: Column) -> Column:
        return F.coalesce(~F.isnan(entry) & (F.abs(entry) < _TOO_LARGE), F.lit(False))

    vector = F.col(f"`{vector_column}`").cast("array<double>")
    rows = rows.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", fit))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("vector") == (most.length if most else 0)).select(
        "vec_id", F.transform("vector", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _exact(values: np.ndarray, times: int) -> np.ndarray:
    """``values``, as Python's whole numbers if ``times`` as much does not fit into 64 bits."""
    largest = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return values if largest * times < _LONG else values.astype(object)


def _summed(name: str):
    """Sums of a task as rows (of, high, low): the sum is high * 2**60 + low, since it may pass 38 digits."""
    schema = pa.schema([("of", pa.int64()), ("high", _WIDE), ("low", _WIDE)])

    def rows(sums: dict[int, int]) -> pa.RecordBatch:
        of = sorted(sums)
        high, low = ([Decimal(part(sums[k])) for k in of] for part in (lambda x: x >> 60, lambda x: x & (1 << 60) - 1))
        return pa.record_batch([pa.array(of, pa.int64()), pa.array(high, _WIDE), pa.array(low, _WIDE)], schema=schema)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}
        for batch in batches:
            x = _matrix(batch.column(0))
            for k, total in enumerate(_exact(x, max(1, len(x))).sum(axis=0)) if len(x) else ():
                sums[k] = sums.get(k, 0) + int(total)
            sums[-1] = sums.get(-1, 0) + len(x)
        yield rows(sums)

    return totals if name == "totals" else rows


_SUMS = "of long, high decimal(38,0), low decimal(38,0)"


def _gathered(parts: DataFrame) -> dict[int, int]:
    sums = parts.groupBy("of").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {row.of: (int(row.high) << 60) + int(row.low) for row in sums}


@dataclass(frozen=True)
class Sums:
    """The number of vectors, and the exact sum of each dimension."""

    n: int
    sums: tuple[int, ...]

    @property
    def centre(self) -> tuple[int, ...]:
        return tuple(round(Fraction(total, self.n)) for total in self.sums)


def column_sums(numbers: DataFrame) -> Sums:
    """One row a dimension comes to the driver, whatever the number of vectors."""
    found = _gathered(numbers.select("x").mapInArrow(_summed("totals"), _SUMS))
    return Sums(found.get(-1, 0), tuple(found[k] for k in sorted(found) if k >= 0))


def pair_squares(numbers: DataFrame, about: Sums) -> dict[tuple[int, int], int]:
    """The exact sums of squares about the centre: of y[i] under (i, i), and of y[i] + y[j] under (i, j), i < j.

    The centre is the mean rounded to whole numbers; ``covariance`` accounts for the rest. One row a pair of dimensions
    comes to the driver.
    """
    centre, width, rows = np.array(about.centre, dtype=np.int64), len(about.sums), _summed("rows")

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = dict.fromkeys((i * width + j for i in range(width) for j in range(i, width)), 0)
        for batch in batches:
            y = _matrix(batch.column(0))
            if not len(y):
                continue
            y = y - centre
            largest = int(np.abs(y).max())
            # Where squares of a batch may pass 64 bits, Python's numbers take over.
            y = y if 4 * largest * largest * len(y) < _LONG else y.astype(object)
            y = np.ascontiguousarray(y.T)
            for i in range(width):
                both = y[i] + y[i:]
                both[0] = y[i]
                for j, total in enumerate((both * both).sum(axis=1), start=i):
                    sums[i * width + j] += int(total)
        yield rows(sums)

    return {divmod(of, width): total for of, total in _gathered(numbers.select("x").mapInArrow(squares, _SUMS)).items()}


def covariance(about: Sums, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance, divisor n, each entry rounded once: half of var(i + j) - var(i) - var(j)."""
    n, width = about.n, len(about.sums)
    rest = [total - n * centre for total, centre in zip(about.sums, about.centre, strict=True)]

    def variance(i: int, j: int) -> int:
        """n * n times the variance of dimension i, or of the sum of i and j."""
        total = rest[i] if i == j else rest[i] + rest[j]
        return n * squares[i, j] - total * total

    own = [variance(i, i) for i in range(width)]
    result = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            value = Fraction(own[i], n * n) if i == j else Fraction(variance(i, j) - own[i] - own[j], 2 * n * n)
            result[i, j] = result[j, i] = float(value)
    return result


@dataclass(frozen=True)
class Whitening:
    """What is fitted: the sums, and of each component its unit vector (a column), variance and part of the trace."""

    about: Sums
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def fit(numbers: DataFrame, components: int) -> Whitening:
    """The components of largest variance, at most ``components`` and no more than have one above rounding errors."""
    about = column_sums(numbers)
    if not about.n:
        return Whitening(about, np.empty((0, 0)), np.empty(0), np.empty(0))
    matrix = covariance(about, pair_squares(numbers, about))
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    least = len(matrix) * np.finfo(float).eps * max(values.max(), 0.0)
    order = order[values[order] > least]
    return Whitening(about, vectors[:, order], values[order], values[order] / np.trace(matrix))


def _projection(model: Whitening):
    """From a matrix of whole numbers: the whitened components, and what is left of each entry after centring times n."""
    n, centre = model.about.n, np.array(model.about.centre, dtype=np.int64)
    rest = [total - n * c for total, c in zip(model.about.sums, model.about.centre, strict=True)]
    scaled = model.vectors / np.sqrt(model.variances)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x - centre
        # The mean's rest is at most one half, so the difference loses no digits that matter.
        whitened = (y.astype(float) - np.array([float(Fraction(r, n)) for r in rest])) @ scaled
        left = _exact(y, 2 * n) * n - np.array(rest, dtype=object if max(map(abs, rest), default=0) >= _LONG else np.int64)
        return whitened, left

    return project


def projected(numbers: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation decimal(38,0), whitened array<double>: the exact squared distance from the mean, times n * n.

    A deviation of more than 38 digits is null.
    """
    kind = "vec_id long, deviation decimal(38,0), whitened array<double>"
    if not model.about.n:
        return numbers.sparkSession.createDataFrame([], kind)
    project = _projection(model)
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", _WIDE), ("whitened", pa.list_(pa.float64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            whitened, left = project(x)
            largest = int(np.abs(left).max(initial=0))
            left = left if largest * largest * left.shape[1] < _LONG else left.astype(object)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([Decimal(value) if value < 10**38 else None for value in map(int, (left * left).sum(axis=1))], _WIDE),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(whitened.ravel())),
                ],
                schema=schema,
            )

    return numbers.select("vec_id", "x").mapInArrow(rows, kind)


def identity_error(numbers: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the covariance of all whitened rows minus the identity; null without components.

    Whitened rows have the mean 0 by their centring, so their products are summed as they are.
    """
    width = len(model.variances)
    if not width:
        return None
    project = _projection(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                whitened = project(x)[0]
                gram += whitened.T @ whitened
        yield pa.record_batch({"of": pa.array(np.arange(width * width)), "total": pa.array(gram.ravel())})

    parts = numbers.select("x").mapInArrow(products, "of long, total double")
    found = parts.groupBy("of").agg(F.sum("total").alias("total")).collect()
    gram = np.zeros(width * width)
    for row in found:
        gram[row.of] = row.total
    return float(np.abs(gram.reshape(width, width) / model.about.n - np.eye(width)).max())


def whitened(
    rows: DataFrame, components: int = 32, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    Components are numbered by falling variance. Those without a variance above rounding errors have no whitened value and
    are left out, so equal vectors alone give no rows. Vectors with repeated or null ids count like others. deviation is
    an exact decimal(38,0), null beyond. Which vectors are usable: see ``whole_numbers``. Other columns of ``rows`` play no part.

    The whole numbers are written once to the shared folder, since three passes read them.
    """
    numbers = stored(whole_numbers(rows, id_column, vector_column), "whole-number-vectors")
    model = fit(numbers, components)
    error = identity_error(numbers, model)
    explained = F.array(*[F.lit(float(value)) for value in model.explained]).cast("array<double>")
    found = projected(numbers, model).select(
        "vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("whitened"), explained.alias("explained"))).alias("at", "value")
    )
    return found.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.about.n).cast("bigint").alias("n"),
        "deviation", "value.whitened", "value.explained", F.lit(error).cast("double").alias("identity_error"),
    )
