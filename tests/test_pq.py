import numpy as np
import pytest
from conftest import as_answer, brute_force

from vicinal.operators.knn import knn_exact
from vicinal.operators.evaluation import recall_at_k
from vicinal.operators.pq import encode_pq, load_books, pq_step, search_pq, train_pq
from vicinal.operators.search import SearchLimits


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    return rng.normal(size=(200, 8)).astype(np.float32), rng.normal(size=(5, 8))


@pytest.fixture
def coded(random_items, vectors):
    items = random_items(vectors[0])
    books = load_books(train_pq(items, 4, 3, max_iters=8))
    return items, books, encode_pq(items, books).select("id", "codes")


def test_codes_are_the_nearest_codewords(coded, vectors):
    _, books, codes = coded
    assert books.shape == (4, 8, 2)
    slices = vectors[0].astype(float).reshape(200, 4, 1, 2)
    wanted = np.argmin(((slices - books[None]) ** 2).sum(axis=3), axis=2)
    assert {int(r["id"]): r["codes"] for r in codes.collect()} == {n: row.tolist() for n, row in enumerate(wanted)}


def test_training_lowers_the_quantisation_error(spark, random_items, vectors):
    items = random_items(vectors[0])

    def error(books):
        slices = vectors[0].astype(float).reshape(200, 4, 1, 2)
        return ((slices - books[None]) ** 2).sum(axis=3).min(axis=2).sum()

    seed = train_pq(items, 4, 3, max_iters=0)
    moved = pq_step(items, seed)
    trained = load_books(train_pq(items, 4, 3, max_iters=10))
    assert error(load_books(seed)) > error(load_books(moved)) > error(trained) - 1e-9
    assert {r["n"] for r in moved.groupBy("sub").sum("n").withColumnRenamed("sum(n)", "n").collect()} == {200}


@pytest.mark.parametrize("metric", ["euclidean", "dot_product"])
@pytest.mark.parametrize("limits", [None, SearchLimits(broadcast_rows=2, block_rows=30)], ids=["broadcast", "blocks"])
def test_lookup_distances(coded, vectors, as_queries, metric, limits):
    items, books, codes = coded
    decoded = np.stack([np.concatenate([books[s, c] for s, c in enumerate(r["codes"])]) for r in
                        sorted(codes.collect(), key=lambda r: int(r["id"]))])
    hits = as_answer(search_pq(codes, books, items, as_queries(vectors[1]), 6, rerank=0, metric=metric, digits=6, limits=limits))
    for q, query in enumerate(vectors[1]):
        exact = np.sqrt(((decoded - query) ** 2).sum(axis=1)) if metric == "euclidean" else -(decoded @ query)
        order = sorted((round(d, 6), str(n)) for n, d in enumerate(exact))[:6]
        assert [(i, pytest.approx(d, abs=2e-6)) for d, i in order] == hits[q]


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "dot_product"])
def test_reranking_everything_is_exact(coded, vectors, as_queries, metric):
    items, books, codes = coded
    hits = search_pq(codes, books, items, as_queries(vectors[1]), 10, rerank=20, metric=metric, digits=6)
    assert as_answer(hits) == brute_force(vectors[0], vectors[1], 10, metric)


def test_reranking_improves_recall(coded, vectors, as_queries):
    items, books, codes = coded
    queries = as_queries(vectors[1])
    truth = knn_exact(items, queries, 10)
    recalls = [
        recall_at_k(truth, search_pq(codes, books, items, queries, 10, rerank=r)).first()["recall"] for r in (1, 4, 20)
    ]
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_filter(coded, vectors, as_queries):
    items, books, codes = coded
    hits = search_pq(codes, books, items, as_queries(vectors[1]), 10, rerank=20, filters={"group": 2}, digits=6)
    assert as_answer(hits) == brute_force(vectors[0], vectors[1], 10, keep=lambda n: n % 3 == 2)


def test_fewer_rows_than_codewords(spark, random_items, as_queries):
    """128 dimensions, 32 slices, 256 codewords asked for, 50 rows, half of them copies."""
    ramp = np.array([[(i * 128 + j) / 1000 for j in range(128)] for i in range(25)] * 2, np.float32)
    items = random_items(ramp)
    books = load_books(train_pq(items, 32, 8, max_iters=2))
    assert books.shape[0] == 32 and 25 <= books.shape[1] <= 50
    codes = encode_pq(items, books).select("id", "codes")
    hits = as_answer(search_pq(codes, books, items, as_queries(ramp[:2]), 2, digits=6))
    assert hits == {0: [("0", 0.0), ("25", 0.0)], 1: [("1", 0.0), ("26", 0.0)]}


@pytest.mark.parametrize("pq_dim, pq_bits", [(3, 4), (4, 9), (0, 4), (4, 0)])
def test_bad_options(random_items, vectors, pq_dim, pq_bits):
    with pytest.raises(ValueError):
        train_pq(random_items(vectors[0]), pq_dim, pq_bits)
