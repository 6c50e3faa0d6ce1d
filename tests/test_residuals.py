"""Codes of residuals: distances against the decoded vectors, and what they gain at the same bits."""

import numpy as np
import pytest
from conftest import as_answer, brute_force

from vicinal.operators.clustering import Centroids, assign_cells
from vicinal.operators.evaluation import recall_at_k
from vicinal.operators.knn import knn_exact
from vicinal.operators.pq import decode_pq, encode_pq, load_books, residuals, search_pq, train_pq
from vicinal.operators.search import SearchLimits


def clustered(seed, clusters=12, each=60, width=8):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, width)) * 4
    return (middles[:, None] + rng.normal(size=(clusters, each, width))).reshape(-1, width).astype(np.float32).astype(np.float64)


@pytest.fixture
def coded(spark, random_items):
    def make(metric):
        matrix = clustered(1)
        unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
        middles = (unit if metric == "cosine" else matrix).reshape(12, 60, 8).mean(axis=1)
        known = Centroids(np.arange(12), middles, np.full(12, 60))
        items = random_items(matrix)
        less = residuals(assign_cells(items, known, metric), known, metric)
        books = load_books(train_pq(less, 4, 3, "euclidean", 5))
        return matrix, items, known, books, encode_pq(less, books, "euclidean")

    return make


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "dot_product"])
def test_distances_are_those_of_the_decoded_vectors(spark, as_queries, coded, metric):
    matrix, items, known, books, codes = coded(metric)
    rows = {r["id"]: r["decoded"] for r in decode_pq(codes, books, known).select("id", "decoded").collect()}
    decoded = np.array([rows[str(n)] for n in range(len(matrix))])
    asked = matrix[::90]
    scaled = asked / np.linalg.norm(asked, axis=1)[:, None] if metric == "cosine" else asked
    for limits in (None, SearchLimits(broadcast_rows=0, block_rows=50), SearchLimits(emit_rows=0)):
        hits = search_pq(codes.select("id", "codes", "cell"), books, items, as_queries(asked), 5, 0, metric, known, 12, residual=True, include=["distance"], prune=False, limits=limits)
        for q, row in as_answer(hits).items():
            if metric == "euclidean":
                want = np.sqrt(np.square(decoded - asked[q]).sum(axis=1))
            else:
                want = -(decoded @ scaled[q]) + (metric == "cosine")
            assert np.allclose([d for _, d in row], np.sort(want)[:5], atol=1e-9)
            assert np.allclose([want[int(i)] for i, _ in row], [d for _, d in row], atol=1e-9)


def test_more_recall_at_the_same_bits(spark, as_queries, coded):
    matrix, items, known, books, codes = coded("euclidean")
    queries = as_queries(matrix[::30])
    truth = knn_exact(items, queries, 10, include=["distance"])
    plain = load_books(train_pq(items, 4, 3, "euclidean", 5))
    before = search_pq(encode_pq(items, plain), plain, items, queries, 10, 0, "euclidean", include=["distance"])
    after = search_pq(codes.select("id", "codes", "cell"), books, items, queries, 10, 0, "euclidean", known, 12, residual=True, include=["distance"], prune=False)
    one, two = (recall_at_k(truth, hits).first()["recall"] for hits in (before, after))
    assert two > one + 0.1
    exact = search_pq(codes.select("id", "codes", "cell"), books, items, queries, 10, 100, "euclidean", known, 12, residual=True, include=["distance"], digits=6, prune=False)
    assert as_answer(exact) == brute_force(matrix, matrix[::30], 10)
    with pytest.raises(ValueError):
        search_pq(codes, books, items, queries, 10, residual=True)
