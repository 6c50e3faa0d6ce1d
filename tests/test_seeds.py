"""Seeds that lie apart, and means added up by cell."""

import numpy as np
import pytest

from vicinal.operators.clustering import (
    Centroids,
    _apart,
    auto_lists,
    first_vectors,
    lloyd_round,
    mean_vectors,
    mini_batch_round,
    spread_seeds,
    train_centroids,
)


def vectors_of(spark, matrix, parts=4):
    return spark.createDataFrame([([float(x) for x in row],) for row in matrix], "vector array<float>").repartition(parts)


def error(matrix, centers):
    return np.square(matrix[:, None] - centers[None]).sum(axis=2).min(axis=1).mean()


def test_seeds_beat_a_random_draw(spark):
    """Forty clusters of very different sizes: random seeds miss the small ones."""
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(40, 6)) * 20
    sizes = np.where(np.arange(40) < 4, 900, 12)
    matrix = np.concatenate([m + rng.normal(size=(n, 6)) for m, n in zip(middles, sizes)]).astype(np.float32)
    frame = vectors_of(spark, matrix)
    seeds = spread_seeds(frame, 40, len(matrix), 7)
    assert seeds.shape == (40, 6) and len(np.unique(seeds, axis=0)) == 40
    known = {tuple(row) for row in matrix.astype(np.float64)}
    assert all(tuple(row) in known for row in seeds)
    drawn = first_vectors(frame.selectExpr("0 AS grp", "vector"), 1, 40, 7)["vector"]
    random = np.array(drawn.to_pylist())
    assert error(matrix, seeds) < 0.2 * error(matrix, random)
    trained = train_centroids(frame, 40, max_iters=3, seed=7)
    plain = Centroids(np.arange(40), random, np.zeros(40, np.int64))
    for _ in range(3):
        plain = lloyd_round(frame, plain)
    assert error(matrix, trained.matrix) < 0.25 * error(matrix, plain.matrix) and trained.counts.sum() == len(matrix)


def test_seeds_of_few_distinct_vectors(spark):
    copies = np.repeat(np.arange(5.0)[:, None] * [1.0, -1.0], 50, axis=0)
    seeds = spread_seeds(vectors_of(spark, copies), 9, 250, 1)
    assert sorted(map(tuple, seeds)) == [(float(n), -float(n)) for n in range(5)]
    hot = np.concatenate([np.zeros((400, 2)), np.random.default_rng(0).normal(size=(30, 2))])
    assert len(np.unique(spread_seeds(vectors_of(spark, hot), 8, 430, 1), axis=0)) == 8
    assert len(spread_seeds(vectors_of(spark, np.ones((10, 2))), 1, 10, 1)) == 1 and auto_lists(100) == 10


def test_seeds_do_not_depend_on_partitions(spark):
    matrix = np.random.default_rng(5).normal(size=(500, 3)).astype(np.float32)
    one, two = (spread_seeds(vectors_of(spark, matrix, parts), 6, 500, 3) for parts in (1, 7))
    assert one.shape == two.shape == (6, 3)


def test_drawn_candidates_are_different():
    candidates = np.repeat(np.eye(4), 3, axis=0) + np.arange(12)[:, None] * 1e-3
    for seed in range(5):
        chosen = _apart(candidates, np.ones(12), 4, seed)
        assert sorted(np.argmax(chosen - chosen.min(axis=1, keepdims=True), axis=1)) == [0, 1, 2, 3]


def test_means_of_many_tasks(spark):
    rng = np.random.default_rng(1)
    rows = [(int(s), int(c), int(n), [float(x) for x in rng.normal(size=3)]) for s, c, n in rng.integers(0, [2, 5, 9], (300, 3)) + [0, 0, 1]]
    sums = spark.createDataFrame(rows, "sub int, cell int, n bigint, total array<double>").repartition(11)
    for size in (1, 10**8):
        got = {(r["sub"], r["cell"]): (r["n"], r["centroid"]) for r in mean_vectors(sums, size).collect()}
        for key in {(s, c) for s, c, _, _ in rows}:
            own = [(n, t) for s, c, n, t in rows if (s, c) == key]
            total, count = np.sum([t for _, t in own], axis=0), sum(n for n, _ in own)
            assert got[key][0] == count and np.allclose(got[key][1], total / count)
    assert mean_vectors(sums.limit(0), 3).count() == 0


def test_mini_batches_come_close_to_full_rounds(spark):
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(12, 5)) * 6
    matrix = (middles[:, None] + rng.normal(size=(12, 150, 5))).reshape(-1, 5).astype(np.float32)
    frame = vectors_of(spark, matrix)
    full = train_centroids(frame, 12, max_iters=6, seed=3)
    mini = train_centroids(frame, 12, max_iters=12, seed=3, mini_batch=300)
    assert error(matrix, mini.matrix) < 1.15 * error(matrix, full.matrix)
    assert abs(mini.counts.sum() - len(matrix)) <= 12
    one = train_centroids(frame, 12, max_iters=2, seed=3, mini_batch=10**6)
    assert np.allclose(one.matrix, train_centroids(frame, 12, max_iters=2, seed=3).matrix)
    with pytest.raises(ValueError):
        train_centroids(frame, 12, mini_batch=0)


def test_a_mini_batch_round_moves_by_the_share_of_rows(spark):
    matrix = np.array([[0.0], [1.0], [2.0], [10.0], [11.0]])
    known = Centroids(np.arange(2), np.array([[0.0], [9.0]]), np.array([3, 1]))
    moved = mini_batch_round(vectors_of(spark, matrix), known, 0, 1)
    assert np.allclose(moved.matrix, [[0.5], [9.0 + 1.5 * 2 / 3]]) and moved.counts.tolist() == [6, 3]
