import numpy as np
import pytest
from conftest import as_answer, brute_force
from pyspark.sql import functions as F

from vicinal.operators.clustering import (
    Centroids,
    assign_cells,
    auto_lists,
    centroid_frame,
    first_vectors,
    lloyd_round,
    lloyd_step,
    load_centroids,
    most_lists,
    train_centroids,
    train_ivf,
    with_counts,
)
from vicinal.operators.evaluation import recall_at_k
from vicinal.operators.ivf import calibrate_probes, probe
from vicinal.operators.knn import knn_exact
from vicinal.operators.search import SearchLimits

BLOCKS = SearchLimits(broadcast_rows=2, block_rows=20)


@pytest.fixture(scope="module")
def clustered():
    """Ten well separated groups, one of which holds a third of all rows."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(10, 8)) * 4
    groups = np.concatenate([np.zeros(100, int), rng.integers(1, 10, 200)])
    return (centers[groups] + rng.normal(size=(300, 8))).astype(np.float32), centers


@pytest.fixture
def trained(spark, random_items, clustered):
    items = random_items(clustered[0])
    known = load_centroids(with_counts(
        centroid_frame(spark, Centroids(np.arange(10), clustered[1], np.zeros(10, np.int64))),
        assign_cells(items, Centroids(np.arange(10), clustered[1], np.zeros(10, np.int64))),
    ))
    return items, known, assign_cells(items, known)


def _nearest(rows, centers):
    return np.argmin(((rows[:, None].astype(float) - centers[None]) ** 2).sum(axis=2), axis=1)


def test_assignment_and_lloyd_step(spark, trained, clustered):
    items, known, cells = trained
    rows, centers = clustered
    nearest = _nearest(rows, centers)
    assert {int(r["id"]): r["cell"] for r in cells.collect()} == dict(enumerate(nearest))
    assert known.counts.tolist() == np.bincount(nearest, minlength=10).tolist()
    means = {r["cell"]: (r["n"], r["centroid"]) for r in lloyd_step(items, known).collect()}
    again = lloyd_round(items, known)
    for cell in range(10):
        mine = rows[nearest == cell].astype(float)
        assert means[cell][0] == len(mine) == again.counts[cell]
        wanted = mine.mean(axis=0) if len(mine) else centers[cell]
        np.testing.assert_allclose(means[cell][1], wanted, atol=1e-9)
        np.testing.assert_allclose(again.matrix[cell], wanted, atol=1e-9)


def test_a_cell_without_rows_keeps_its_centroid(spark, random_items):
    items = random_items(np.zeros((5, 2)))
    known = Centroids(np.array([3, 7]), np.array([[0.0, 1.0], [9.0, 9.0]]), np.zeros(2, np.int64))
    rows = {r["cell"]: (r["n"], r["centroid"]) for r in lloyd_step(items, known).collect()}
    assert rows == {3: (5, [0.0, 0.0]), 7: (0, [9.0, 9.0])}


def test_cosine_lists_accept_a_zero_vector(spark, random_items):
    items = random_items(np.array([[0.0, 0.0], [10.0, 0.1], [0.1, 3.0]]))
    known = Centroids(np.arange(2), np.eye(2), np.zeros(2, np.int64))
    cells = {r["id"]: r["cell"] for r in assign_cells(items, known, "cosine").collect()}
    assert cells == {"0": 0, "1": 0, "2": 1}


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "dot_product"])
@pytest.mark.parametrize("limits", [None, BLOCKS], ids=["broadcast", "blocks"])
def test_full_probe_is_exact(trained, clustered, as_queries, metric, limits):
    items, known, cells = trained
    queries = clustered[0][::40].astype(float) + 0.3
    hits = probe(cells, known, as_queries(queries), 12, 10, metric=metric, digits=6, limits=limits)
    assert as_answer(hits) == brute_force(clustered[0], queries, 12, metric)


@pytest.mark.parametrize("limits", [None, BLOCKS], ids=["broadcast", "blocks"])
def test_probes_search_the_nearest_lists_only(trained, clustered, as_queries, limits):
    items, known, cells = trained
    rows, centers = clustered
    queries = rows[::60].astype(float) + 0.3
    cell_of = _nearest(rows, centers)
    answer = as_answer(probe(cells, known, as_queries(queries), 15, 2, digits=6, limits=limits))
    for q, query in enumerate(queries):
        visited = np.argsort(((centers - query) ** 2).sum(axis=1))[:2]
        wanted = brute_force(rows, [query], 15, keep=lambda n: cell_of[n] in visited)[0]
        assert answer[q] == wanted


def test_recall_grows_with_probes(trained, clustered, as_queries):
    items, known, cells = trained
    queries = as_queries(clustered[0][::30].astype(float) + 2.0)
    truth = knn_exact(items, queries, 20)
    recalls = [recall_at_k(truth, probe(cells, known, queries, 20, n)).first()["recall"] for n in (1, 3, 10)]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_greedy_stops_once_enough_rows_are_held(trained, clustered, as_queries):
    items, known, cells = trained
    rows, centers = clustered
    queries = rows[::50].astype(float) + 0.3
    cell_of = _nearest(rows, centers)
    sizes = np.bincount(cell_of, minlength=10)
    answer = as_answer(probe(cells, known, as_queries(queries), 40, greedy=True, digits=6))
    for q, query in enumerate(queries):
        order = np.argsort(((centers - query) ** 2).sum(axis=1))
        before = np.cumsum(sizes[order]) - sizes[order]
        visited = set(order[before < 40])
        assert answer[q] == brute_force(rows, [query], 40, keep=lambda n: cell_of[n] in visited)[0]


def test_postings_without_vectors_give_the_same_hits(trained, clustered, as_queries):
    items, known, cells = trained
    queries = as_queries(clustered[0][::60].astype(float))
    flat = probe(cells, known, queries, 5, 2, filters={"group": 1}, digits=6)
    thin = probe(cells.select("id", "cell"), known, queries, 5, 2, filters={"group": 1}, items=items, digits=6)
    assert as_answer(flat) == as_answer(thin)


def test_kmeans_training(random_items, clustered, as_queries):
    items = random_items(clustered[0])
    known = load_centroids(train_ivf(items, n_lists=10, max_iters=20))
    assert len(known.cells) == 10 and known.counts.sum() == 300
    assert len(load_centroids(train_ivf(items, max_iters=2)).cells) == auto_lists(300) == 17
    one = load_centroids(train_ivf(items, n_lists=1))
    np.testing.assert_allclose(one.matrix[0], clustered[0].astype(float).mean(axis=0), atol=1e-9)
    small = load_centroids(train_ivf(items, n_lists=4, max_iters=3, max_memory=1, metric="cosine"))
    assert small.counts.sum() == 300
    with pytest.raises(ValueError):
        train_ivf(items.limit(0))


def test_calibrated_probes_reach_the_target(trained, clustered, as_queries):
    items, known, cells = trained
    queries = as_queries(clustered[0][::7].astype(float) + 1.0)
    truth = knn_exact(items, queries, 20)

    def recall(n):
        return recall_at_k(truth, probe(cells, known, queries, 20, n)).first()["recall"]

    n = calibrate_probes(cells, known, queries, 20, target=0.9)
    assert recall(n) >= 0.9 and (n == 1 or recall(n - 1) < 0.9)


def test_first_vectors_are_distinct_and_do_not_depend_on_partitions(spark):
    rows = [(0, [1.0, 2.0])] * 4000 + [(0, [float(n), 0.0]) for n in range(1000)] + [(1, [0.0]), (1, [-0.0])]
    frame = spark.createDataFrame(rows, "grp int, vector array<double>")
    first, again = (first_vectors(f, 2, 256, 7).to_pydict() for f in (frame, frame.repartition(5)))
    assert first == again and first["grp"].count(0) == 256 and first["grp"].count(1) == 1
    assert len({tuple(v) for v in first["vector"]}) == 257


def test_blocks_bound_memory_and_change_no_result(random_items, clustered):
    items = random_items(clustered[0])
    plain = train_centroids(items, n_lists=6, max_iters=4)
    small = train_centroids(items, n_lists=6, max_iters=4, batch_size=7, max_memory=1)
    np.testing.assert_allclose(plain.matrix, small.matrix)
    with pytest.raises(ValueError):
        train_centroids(items, n_lists=6, batch_size=0)


def test_centroids_bound_the_number_of_lists():
    assert auto_lists(10**12, 4) == 1 << 18 and auto_lists(10**12, 768) == most_lists(768) < 1 << 18
