from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from pricefold.llm import whitening

KIND = "vec_id long, embedding array<float>, component string"


def expected(vectors: list[list[float]], components: int):
    """By whole numbers and fractions: n, deviations, covariance; whitened rows by eigh."""
    x = [[math.floor(64 * c) + 1_000_000 for c in vector] for vector in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[k] for row in x) for k in range(width)]
    left = [[n * row[k] - sums[k] for k in range(width)] for row in x]
    matrix = np.array([
        [float(Fraction(sum(row[i] * row[j] for row in left), n**3)) for j in range(width)] for i in range(width)
    ])
    values, vectors_ = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:components]
    rows = np.array([[value / n for value in row] for row in left]) @ vectors_[:, order] / np.sqrt(values[order])
    return n, [sum(value * value for value in row) for row in left], matrix, values[order] / np.trace(matrix), rows


@pytest.mark.parametrize("spread", [1.0, 40_000.0, 3e14])
def test_equals_brute_force(spark, spread):
    draw = np.random.default_rng(5)
    vectors = (draw.normal(size=(200, 6)) * [5, 4, 3, 2, 1, 0.5] * spread + spread).astype(np.float32)
    rows = spark.createDataFrame([(k, [float(c) for c in v], "x") for k, v in enumerate(vectors)], KIND).repartition(3)
    n, deviations, matrix, explained, projected = expected([[float(c) for c in v] for v in vectors], 4)
    numbers = whitening.whole_numbers(rows)
    about = whitening.column_sums(numbers)
    assert np.array_equal(whitening.covariance(about, whitening.pair_squares(numbers, about)), matrix)
    found = whitening.whitened(rows, 4).collect()
    assert len(found) == 4 * n
    signs = {}
    for row in found:
        assert row.n == n
        assert row.deviation == (deviations[row.vec_id] if deviations[row.vec_id] < 10**38 else None)
        assert row.identity_error < 1e-9
        assert row.explained == pytest.approx(explained[row.component - 1], rel=1e-9)
        value = projected[row.vec_id][row.component - 1]
        sign = signs.setdefault(row.component, math.copysign(1, value * row.whitened))
        assert sign * row.whitened == pytest.approx(value, abs=1e-7)


def test_odd_vectors(spark):
    good = [(k, [float(k % 3), float(k % 5), float(k)], None) for k in range(12)]
    odd = [
        (100, None, "x"), (101, [], "x"), (102, [1.0, None, 2.0], "x"), (103, [float("nan"), 0.0, 1.0], "x"),
        (104, [float("inf"), 0.0, 1.0], "x"), (105, [1e30, 0.0, 1.0], "x"), (106, [1.0, 2.0], "x"), (None, [1.0, 2.0, 3.0], None),
        (5, [5.0, 1.0, 0.0], "repeated id"),
    ]
    found = whitening.whitened(spark.createDataFrame(good + odd, KIND), 32)
    assert found.count() == 14 * 3
    assert {row.component for row in found.collect()} == {1, 2, 3}
    assert {row.vec_id for row in found.collect()} == {*range(12), None}
    none = whitening.whitened(spark.createDataFrame(odd[:2], KIND))
    assert none.collect() == [] and none.columns == found.columns
    assert whitening.whitened(spark.createDataFrame([], KIND)).collect() == []


def test_components_without_variance_are_left_out(spark):
    rows = spark.createDataFrame([(k, [float(k), 2.0 * k, 7.0], None) for k in range(9)], KIND)
    found = whitening.whitened(rows).collect()
    assert {row.component for row in found} == {1} and found[0].explained == pytest.approx(1.0)
    equal = spark.createDataFrame([(k, [1.0, 2.0], None) for k in range(9)], KIND)
    assert whitening.whitened(equal).collect() == []


def test_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whitened(rows).toPandas()
    table = rows.toPandas()
    n, deviations, _, explained, projected = expected([[float(c) for c in v] for v in table.embedding], 32)
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert np.abs(np.abs(wide) - np.abs(projected)).max() < 1e-6
    assert found.identity_error.max() < 1e-4
    own = found[found.component == 1].set_index("vec_id").deviation
    assert [int(own[k]) for k in table.vec_id] == deviations
