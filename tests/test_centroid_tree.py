"""The tree over centroids against comparing with each of them."""

import numpy as np
import pytest

import vicinal.operators.clustering as clustering
from vicinal.functions.blocks import nearest_rows
from vicinal.functions.centroid_tree import nearest_place, plant
from vicinal.operators.clustering import Centroids, assign_cells, lloyd_round


def flat(rows, matrix, digits=None):
    at, distances, found = nearest_rows(rows, matrix, np.arange(len(matrix)), "euclidean", 1, digits)
    assert at.tolist() == list(range(len(rows)))
    return found, distances


def clustered(rng, clusters, each, width):
    middles = rng.normal(size=(clusters, width)) * 30
    return (middles[:, None] + rng.normal(size=(clusters, each, width))).reshape(-1, width)


@pytest.mark.parametrize("digits", [None, 2])
def test_same_answer_as_all_centroids(digits):
    rng = np.random.default_rng(1)
    for matrix, rows in (
        (rng.normal(size=(900, 12)), rng.normal(size=(5000, 12))),
        (clustered(rng, 30, 40, 5), clustered(rng, 30, 100, 5)),
        (np.repeat(rng.integers(-2, 3, (60, 3)).astype(float), 10, axis=0), rng.integers(-3, 4, (700, 3)).astype(float)),
        (rng.normal(size=(520, 4)) * 1e-3 + 1e4, rng.normal(size=(300, 4)) * 1e-3 + 1e4),
        (np.zeros((600, 2)), np.ones((10, 2))),
    ):
        place, best, _ = nearest_place(rows, plant(matrix), digits)
        found, distances = flat(rows, matrix, digits)
        assert (place == found).all() and (best == distances).all()


def test_work_falls_where_vectors_lie_in_clusters():
    rng = np.random.default_rng(2)
    matrix, rows = clustered(rng, 60, 60, 8), clustered(np.random.default_rng(2), 60, 50, 8)
    _, _, pairs = nearest_place(rows, plant(matrix), None)
    assert pairs < len(rows) * 8 * np.sqrt(len(matrix)) < 0.2 * len(rows) * len(matrix)
    _, _, pairs = nearest_place(rng.normal(size=(500, 40)), plant(rng.normal(size=(900, 40))), None)
    assert pairs <= 500 * (900 + 31)
    assert plant(matrix[:100]) is None


def test_assignment_and_rounds_through_the_tree(spark, random_items, monkeypatch):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(1500, 4)).astype(np.float32).astype(np.float64)
    items = random_items(matrix)
    known = Centroids(np.arange(600) * 2, matrix[:600], np.zeros(600, np.int64))
    found, _ = flat(matrix, known.matrix)
    cells = {r["id"]: r["cell"] for r in assign_cells(items, known).select("id", "cell").collect()}
    assert cells == {str(n): int(2 * p) for n, p in enumerate(found)}
    with_tree = lloyd_round(items, known)
    monkeypatch.setattr(clustering, "plant", lambda matrix: None)
    without = lloyd_round(items, known)
    assert np.allclose(with_tree.matrix, without.matrix) and (with_tree.counts == without.counts).all()
