"""Bounded emission of a search over many tasks, lists visited in order, and probes that know a filter."""

import numpy as np
import pytest
from conftest import as_answer, brute_force

from vicinal.functions.blocks import VectorMetric
from vicinal.operators.clustering import Centroids, assign_cells
from vicinal.operators.ivf import matching_lists, probe, rows_of_probes, visited_lists
from vicinal.operators.knn import knn_exact
from vicinal.operators.search import SearchLimits, _asked, _shards, candidates, ship


def emitted(items, queries, top_k, limits):
    base = items.selectExpr("id", "vector AS value")
    asked, metric = _asked(queries), VectorMetric("euclidean")
    return candidates(base, asked, ship(asked, metric, top_k, limits), metric, top_k, None, limits, _shards(base, top_k, limits)).count()


def test_finer_splits_emit_hardly_more(spark, random_items, as_queries):
    rng = np.random.default_rng(7)
    matrix, asked = rng.normal(size=(4000, 6)), rng.normal(size=(5, 6))
    items, queries, k = random_items(matrix).select("id", "vector"), as_queries(asked), 10
    plain, bounded = SearchLimits(emit_rows=1 << 40), SearchLimits(emit_rows=0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        counts = {}
        for parts in (16, 160):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            split = items.repartition(parts)
            counts[parts] = [emitted(split, queries, k, limits) for limits in (plain, bounded)]
            assert as_answer(knn_exact(split, queries, k, digits=6, include=["distance"], limits=bounded)) == brute_force(matrix, asked, k)
        assert counts[16][0] == 16 * 5 * k and counts[160][0] == 160 * 5 * k
        assert counts[160][1] < 160 * 5 * k // 5 and counts[160][1] < 5 * counts[16][1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("metric", ["cosine", "dot_product"])
def test_bounds_under_ties_and_few_rows(spark, random_items, as_queries, metric):
    """Copies at the bound, tasks without rows and fewer rows than asked for."""
    matrix = np.repeat(np.random.default_rng(1).integers(-2, 3, size=(12, 3)).astype(float), 9, axis=0)
    asked = np.random.default_rng(2).integers(-2, 3, size=(6, 3)).astype(float)
    items = random_items(matrix).repartition(7)
    for k in (4, 200):
        hits = knn_exact(items, as_queries(asked), k, metric, digits=6, include=["distance"], limits=SearchLimits(emit_rows=0, pass_rows=2))
        assert as_answer(hits) == brute_force(matrix, asked, k, metric)


def test_lists_are_visited_as_far_as_needed():
    rng = np.random.default_rng(3)
    known = Centroids(np.arange(300), rng.normal(size=(300, 4)), rng.integers(0, 5, 300))
    rows = rng.normal(size=(40, 4))
    for enough, least in ((1, 0), (17, 0), (400, 3), (10**9, 2), (0, 7)):
        got = visited_lists(rows, known, "euclidean", enough, least, None)
        for row, visits in zip(rows, got):
            order = np.argsort(np.square(known.matrix - row).sum(axis=1), kind="stable")
            before = np.cumsum(known.counts[order]) - known.counts[order]
            want = order[(before < enough) | (np.arange(300) < least)]
            assert visits.tolist() == want.tolist()
    assert visited_lists(rows, Centroids(np.arange(0), np.zeros((0, 4)), np.arange(0)), "euclidean", 5, 2, None) == [[]] * 40


def test_filtered_probes_visit_more_lists(spark, random_items, as_queries):
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(900, 5))
    items, queries = random_items(matrix), as_queries(matrix[:20])
    seeds = Centroids(np.arange(30), matrix[:30], np.zeros(30, np.int64))
    cells = assign_cells(items, seeds)
    sizes = dict(cells.groupBy("cell").count().collect())
    known = Centroids(seeds.cells, seeds.matrix, np.array([sizes.get(n, 0) for n in range(30)]))
    rare = {"n": {"$lt": 45}}
    matching = matching_lists(cells, known, rare)
    assert matching.counts.sum() == 45 and rows_of_probes(known, 3) == 90
    truth = brute_force(matrix, matrix[:20], 5, keep=lambda n: n < 45)

    def recall(**options):
        hits = as_answer(probe(cells, known, queries, 5, 3, filters=rare, include=["distance"], prune=False, **options))
        return np.mean([len({i for i, _ in hits.get(q, [])} & {i for i, _ in row}) / 5 for q, row in truth.items()])

    assert recall(matching=matching) == 1.0 > recall()
    narrow = matching_lists(cells.select("id", "cell"), known, rare, items)
    assert narrow.cells.tolist() == matching.cells.tolist() and narrow.counts.tolist() == matching.counts.tolist()
    none = matching_lists(cells, known, {"n": -1})
    assert probe(cells, known, queries, 5, 3, filters={"n": -1}, matching=none).count() == 0
