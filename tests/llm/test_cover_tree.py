from __future__ import annotations

import numpy as np
import pytest

from pricefold.llm import cover_tree


def brute(ids, vectors, cosine=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def find(row):
        while root[row] != row:
            row = root[row]
        return row

    for a, b in zip(*np.nonzero(np.triu(near))):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = {}
    for row, doc in enumerate(ids):
        least[find(row)] = min(least.get(find(row), doc), doc)
    return sorted((doc, int(near[row].sum()), least[find(row)], doc == least[find(row)]) for row, doc in enumerate(ids))


def clustered(spread):
    chance = np.random.default_rng(1)
    centres = chance.normal(size=(20, 8))
    widths = np.repeat(chance.choice(spread, 20), 20)[:, None]
    vectors = np.repeat(centres, 20, 0) + chance.normal(size=(400, 8)) * widths
    vectors[5], vectors[7] = vectors[300], 3 * vectors[6]
    return vectors


@pytest.mark.parametrize("block", [100_000, 60])
def test_equals_brute_force(spark, block):
    vectors = clustered([0.001, 0.01, 0.1, 0.3, 0.6])
    frame = spark.createDataFrame([(row, vector.tolist()) for row, vector in enumerate(vectors)], "vec_id long, embedding array<double>")
    rows = cover_tree.linked_vectors(frame, block=block, sample=100).collect()
    assert sorted(map(tuple, rows)) == brute(list(range(400)), vectors)


def test_the_traversal_prunes_and_takes_nodes_whole(monkeypatch):
    vectors = np.concatenate([clustered([0.001])] * 1)
    vectors = np.repeat(vectors, 20, 0) + np.random.default_rng(2).normal(size=(8000, 8)) * 1e-4
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    computed = []
    real = cover_tree.Links.computed
    monkeypatch.setattr(
        cover_tree.Links, "computed",
        lambda self, a, left, b, right, points, same: (computed.append(len(left) * len(right)), real(self, a, left, b, right, points, same)),
    )
    links = cover_tree.traverse([vectors], [np.ones(8000, np.int64)], 0.9)
    near = vectors @ vectors.T >= 0.9
    assert (links.counts[0] == near.sum(axis=1) - 1).all()
    assert sum(computed) < 0.2 * 8000**2


def test_nets_are_nested_and_cover():
    points = clustered([0.3])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    wide = cover_tree.net(points, 1.0, 400)
    fine = cover_tree.net(points, 0.5, 400, wide)
    assert set(wide) <= set(fine)
    assert cover_tree._distances(points, points[fine]).min(axis=1).max() <= 0.5


def test_vectors_of_all_kinds(spark):
    rows = [
        (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, []), (7, [2.0, 0.0]),
        (8, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [float("inf"), 1.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as vector", "2 as seen")
    found = sorted((tuple(row) for row in cover_tree.linked_vectors(frame).collect()), key=repr)
    alone = [(row, 0, row, True) for row in (2, 3, 4, 5, 6, 9, 10)]
    linked = [(1, 3, 1, True), (7, 3, 1, False), (8, 3, 1, False), (None, 3, 1, False), (2, 1, 2, True), (2, 1, 2, True)]
    assert found == sorted(alone + linked, key=repr)
    assert cover_tree.linked_vectors(frame.limit(0)).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    from pricefold.llm.queries import op9_cover_tree, table

    rows = table(spark, sf_dir, "embeddings").collect()
    wanted = brute([row.vec_id for row in rows], np.array([row.embedding for row in rows], float))
    assert sorted(map(tuple, op9_cover_tree(spark, sf_dir).collect())) == wanted
