import numpy as np
import pytest
from conftest import as_answer, brute_force
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vicinal.functions.blocks import TopK, VectorMetric
from vicinal.functions.distance import distance
from vicinal.operators.knn import filter_matches, knn_exact
from vicinal.operators.search import SearchLimits, search
from vicinal.options import METRICS

BLOCKS = SearchLimits(broadcast_rows=2, block_rows=13)
SHARDED = SearchLimits(merge_rows=1)
PASSES = SearchLimits(pass_rows=3)
SMALL_BASE = SearchLimits(broadcast_rows=150)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    return rng.normal(size=(150, 8)).astype(np.float32), rng.normal(size=(7, 8))


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize(
    "limits", [None, BLOCKS, SHARDED, PASSES], ids=["broadcast", "blocks", "sharded", "passes"]
)
def test_matches_brute_force(random_items, as_queries, vectors, metric, limits):
    items, queries = vectors
    hits = knn_exact(random_items(items), as_queries(queries), 9, metric, digits=6, limits=limits)
    assert as_answer(hits) == brute_force(items, queries, 9, metric)


@pytest.mark.parametrize("limits", [None, BLOCKS, SHARDED], ids=["broadcast", "blocks", "sharded"])
def test_copies_of_one_vector_tie_by_id(random_items, as_queries, limits):
    rng = np.random.default_rng(2)
    items = rng.normal(size=(120, 6)).astype(np.float32)
    items[:40] = items[0]
    queries = np.vstack([items[0], rng.normal(size=(3, 6))])
    hits = knn_exact(random_items(items), as_queries(queries), 15, digits=6, limits=limits)
    answer = as_answer(hits)
    assert answer == brute_force(items, queries, 15)
    assert {d for _, d in answer[0]} == {0.0}


@pytest.mark.parametrize("limits", [None, BLOCKS], ids=["broadcast", "blocks"])
def test_filter_is_applied_before_the_search(random_items, as_queries, vectors, limits):
    items, queries = vectors
    hits = knn_exact(random_items(items), as_queries(queries), 60, filters={"group": 1}, digits=6, limits=limits)
    answer = as_answer(hits)
    assert answer == brute_force(items, queries, 60, keep=lambda n: n % 3 == 1)
    assert all(len(rows) == 50 for rows in answer.values())


def test_no_match_and_empty_table_give_an_empty_answer(random_items, as_queries, vectors):
    items, queries = vectors
    table = random_items(items)
    assert knn_exact(table, as_queries(queries), 5, filters={"group": 9}).count() == 0
    empty = knn_exact(table.limit(0), as_queries(queries), 5, include=["distance", "metadata"])
    assert empty.columns == ["query_id", "rank", "id", "distance", "metadata"]
    assert empty.count() == 0
    assert knn_exact(table, as_queries(queries).limit(0), 5).count() == 0


def test_include_lists(random_items, as_queries, vectors):
    items, queries = vectors
    table, asked = random_items(items), as_queries(queries)
    lead = ["query_id", "rank", "id"]
    assert knn_exact(table, asked, 2, include=None).columns == lead + ["distance", "metadata"]
    assert knn_exact(table, asked, 2, include=[]).columns == lead + ["distance"]
    assert knn_exact(table, asked, 2, include=["vector"]).columns == lead + ["vector"]
    row = knn_exact(table, asked, 1, include=["vector", "contents", "metadata"]).first()
    assert row["contents"] == f"text {row['id']}"
    assert row["vector"] == [float(x) for x in items[int(row["id"])]]
    with pytest.raises(ValueError):
        knn_exact(table, asked, 2, include=["score"])


def test_large_components_and_near_zero_distances(random_items, as_queries):
    items = np.array([[1e10] * 4, [1e10] * 3 + [1e10 + 4096], [1e-10] * 4, [0.0] * 4], np.float32)
    queries = np.array([[1e10] * 4, [0.0] * 4])
    answer = as_answer(knn_exact(random_items(items), as_queries(queries), 4, digits=6))
    assert answer == brute_force(items, queries, 4)
    assert answer[0][0] == ("0", 0.0)


def test_metadata_may_be_json_text(random_items, as_queries, vectors):
    items, queries = vectors
    text = random_items(items).selectExpr("id", "vector", "to_json(metadata) AS metadata")
    hits = knn_exact(text, as_queries(queries), 5, filters={"group": 2}, digits=6)
    assert as_answer(hits) == brute_force(items, queries, 5, keep=lambda n: n % 3 == 2)


def test_string_query_ids_and_argument_checks(spark, random_items, as_queries, vectors):
    items, queries = vectors
    table = random_items(items)
    asked = as_queries(queries).selectExpr("concat('q', query_id) AS query_id", "query_vector")
    for limits in (None, BLOCKS):
        assert {r["query_id"] for r in knn_exact(table, asked, 1, limits=limits).collect()} == {f"q{n}" for n in range(7)}
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            knn_exact(table, asked, bad)
    with pytest.raises(ValueError):
        knn_exact(table, asked, 1, "manhattan")
    with pytest.raises(Exception, match="dimension"):
        knn_exact(table, as_queries(np.ones((1, 5))), 1).collect()


def test_items_without_a_vector_are_not_searched(spark, as_queries):
    rows = [("a", None), ("b", [1.0, 2.0])]
    items = spark.createDataFrame(rows, "id string, vector array<float>")
    assert [r["id"] for r in knn_exact(items, as_queries([[0.0, 0.0]]), 5).collect()] == ["b"]


def test_filter_matches(random_items, vectors):
    ids = {r["id"] for r in filter_matches(random_items(vectors[0]), {"n": {"$gt": 140}}).collect()}
    assert ids == {str(n) for n in range(141, 150)}


def test_column_distance_agrees_with_the_kernels(spark, random_items, as_queries, vectors):
    items, queries = vectors
    table, asked = random_items(items), as_queries(queries)
    for metric in METRICS:
        hits = knn_exact(table, asked, 5, metric, include=["distance", "vector"])
        again = hits.join(asked, "query_id").select("distance", distance("query_vector", "vector", metric).alias("d"))
        assert all(abs(r["distance"] - r["d"]) < 1e-12 for r in again.collect())


def test_zero_vector_has_cosine_distance_one(spark):
    frame = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<float>, b array<float>")
    assert frame.select(distance("a", "b", "cosine").alias("d")).first()["d"] == 1.0


@pytest.mark.parametrize("metric", METRICS)
def test_many_queries_against_a_small_base(random_items, as_queries, vectors, metric):
    items, _ = vectors
    queries = np.random.default_rng(9).normal(size=(200, 8))
    hits = knn_exact(random_items(items), as_queries(queries).repartition(3), 4, metric, digits=6, limits=SMALL_BASE)
    assert as_answer(hits) == brute_force(items, queries, 4, metric)
    assert "Exchange hashpartitioning" not in hits._jdf.queryExecution().toString()


def test_measured_query_count(random_items, as_queries, vectors):
    items, queries = vectors
    _, counted = search(random_items(items), as_queries(queries), VectorMetric("euclidean"), 3)
    assert counted == 7
    _, unknown = search(random_items(items), as_queries(queries), VectorMetric("euclidean"), 3, limits=BLOCKS)
    assert unknown is None


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_running_top_k_does_not_depend_on_batches(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10_000)))
    n, k = data.draw(st.integers(1, 60)), data.draw(st.integers(1, 12))
    # Few distinct values give many ties.
    rows = rng.integers(0, 3, size=(n, 3)).astype(np.float64)
    queries = rng.integers(0, 3, size=(4, 3)).astype(np.float64)
    metric = data.draw(st.sampled_from(METRICS))
    ids = np.array([str(i).encode() for i in range(n)])
    cuts = sorted(data.draw(st.lists(st.integers(0, n), max_size=4)))
    best = TopK(VectorMetric(metric).bind(queries), 4, k, 6)
    for start, stop in zip([0, *cuts], [*cuts, n]):
        if stop > start:
            best.offer(np.arange(4), rows[start:stop], ids[start:stop])
    at, distances, found = best.result()
    got = {q: [(i.decode(), d) for i, d in zip(found[at == q], distances[at == q])] for q in range(4)}
    assert got == brute_force(rows, queries, k, metric)


def test_repeated_or_fractional_query_ids_are_refused_under_every_plan(spark, random_items):
    items = random_items(np.eye(4))
    twice = spark.createDataFrame([(1, [0.0] * 4), (1, [1.0] * 4)], "query_id bigint, query_vector array<double>")
    real = spark.createDataFrame([(1.5, [0.0] * 4)], "query_id double, query_vector array<double>")
    for limits in (None, SearchLimits(broadcast_rows=1, pass_rows=1), SearchLimits(broadcast_rows=1, pass_rows=1, block_rows=2)):
        for queries in (twice, real):
            with pytest.raises(ValueError):
                knn_exact(items, queries, 2, limits=limits)


def test_ids_with_zero_bytes_come_back_whole(spark):
    names = ["a", "a\0", "a\0\0", "a\1", "a\1\2", "a\2", "b"]
    items = spark.createDataFrame([(n, [0.0]) for n in names], "id string, vector array<double>")
    queries = spark.createDataFrame([(1, [0.0])], "query_id bigint, query_vector array<double>")
    found = knn_exact(items, queries, 7).orderBy("rank").collect()
    assert [r["id"] for r in found] == sorted(names)
