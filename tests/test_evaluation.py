import pytest
from pyspark.sql import functions as F

from vicinal.operators import evaluation
from vicinal.operators.catalog import describe_index, list_indexes
from vicinal.operators.items import as_items
from vicinal.operators.training import training_status


def _pairs(spark, rows, keys=("query_id",)):
    return spark.createDataFrame(rows, ", ".join(f"{k} bigint" for k in keys) + ", id string")


def test_recall_at_k(spark):
    truth = _pairs(spark, [(1, "a"), (1, "b"), (2, "c"), (2, "d")])
    hits = _pairs(spark, [(1, "a"), (1, "b"), (2, "c"), (2, "x")])
    row = evaluation.recall_at_k(truth, hits).first()
    assert (row["n_queries"], row["recall"]) == (2, 0.75)
    with pytest.raises(Exception, match="different queries"):
        evaluation.recall_at_k(truth, _pairs(spark, [(1, "a")])).collect()
    with pytest.raises(Exception, match="different queries"):
        evaluation.recall_at_k(_pairs(spark, [(1, "a")]), hits).collect()


def test_filtered_recall(spark):
    keys = ("filter_id", "query_id")
    queries = spark.createDataFrame([(f, q) for f in (1, 2) for q in (1, 2, 3)], "filter_id bigint, query_id bigint")
    truth = _pairs(spark, [(1, 1, "a"), (1, 1, "b"), (1, 1, "-1"), (1, 2, None), (2, 3, "z")], keys)
    hits = _pairs(spark, [(1, 1, "a"), (1, 2, "x"), (2, 3, "z")], keys)
    rows = {r["filter_id"]: (r["n_queries"], round(r["recall"], 6)) for r in
            evaluation.recall_filtered(queries, truth, hits, keys=keys).collect()}
    # Filter 1: half found, a hit that nobody expected, nothing expected or found.
    assert rows == {1: (3, 0.5), 2: (3, 1.0)}


def test_filtered_recall_cap(spark):
    queries = spark.createDataFrame([(1,)], "query_id bigint")
    truth = _pairs(spark, [(1, str(n)) for n in range(150)])
    hits = _pairs(spark, [(1, str(n)) for n in range(50)])
    assert evaluation.recall_filtered(queries, truth, hits).first()["recall"] == 0.5
    with pytest.raises(Exception, match="more than 100 hits"):
        evaluation.recall_filtered(queries, truth, _pairs(spark, [(1, str(n)) for n in range(101)])).collect()


def test_thresholds(spark):
    recalls = spark.createDataFrame([(1, 0.9), (2, 0.5)], "filter_id int, recall double")
    floors = spark.createDataFrame([(1, 94.0), (2, 60.0)], "filter_id int, threshold double")
    assert [r["filter_id"] for r in evaluation.recall_failures(recalls, floors, 0.95).collect()] == [2]
    assert [r["filter_id"] for r in evaluation.recall_failures(recalls, floors).orderBy("filter_id").collect()] == [1, 2]


def test_leaks(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert evaluation.leak_check(rows, spark.createDataFrame([("b",), ("b",)], "id string")).first()["n_leaks"] == 2
    assert evaluation.leak_check(rows, spark.createDataFrame([("z",)], "id string")).first()["n_leaks"] == 0


def test_roundtrip_reasons(spark):
    schema = "id string, vector array<float>, contents string, metadata string"
    before = [
        ("same", [1.0], "x", '{"a": 1, "b": [1, 2]}'), ("near", [1.0], "x", None), ("far", [1.0], "x", None),
        ("text", [1.0], "x", None), ("meta", [1.0], "x", '{"a": 1}'), ("gone", [1.0], None, None),
        ("short", [1.0, 2.0], None, None), ("void", None, None, None), ("lost", [1.0], None, None),
    ]
    after = [
        ("same", [1.0], "x", '{"b": [1, 2], "a": 1}'), ("near", [1.0000005], "x", None), ("far", [1.001], "x", None),
        ("text", [1.0], "y", None), ("meta", [1.0], "x", '{"a": "1"}'), ("more", [1.0], None, None),
        ("short", [1.0], None, None), ("void", None, None, None), ("lost", None, None, None),
    ]
    diff = evaluation.roundtrip_diff(*(as_items(spark.createDataFrame(rows, schema)) for rows in (before, after)))
    assert {r["id"]: r["reason"] for r in diff.collect()} == {
        "far": "vector", "text": "contents", "meta": "metadata", "gone": "missing", "more": "added",
        "short": "vector", "lost": "vector",
    }


def test_prefix_count(spark):
    rows = spark.createDataFrame([(f"concurrent_{n}",) for n in range(20)] + [("other",)], "id string")
    assert evaluation.id_prefix_count(rows, "concurrent_").first()["n_items"] == 20


def test_training_status(spark):
    catalog = spark.createDataFrame(
        [("new", False, 0), ("ready", False, 0), ("grown", True, 50), ("fresh", True, 90), ("empty", False, None)],
        "index_name string, is_trained boolean, trained_count bigint",
    )
    counts = spark.createDataFrame([("new", 99), ("ready", 100), ("grown", 100), ("fresh", 100)], "index_name string, n_items bigint")
    rows = training_status(catalog, counts, threshold=100, multiplier=2.0).collect()
    assert {r["index_name"] for r in rows if r["needs_training"]} == {"ready", "grown"}
    assert {r["index_name"]: r["n_items"] for r in rows}["empty"] == 0


def test_catalogue_versions(spark):
    rows = [("a", 1, "ivf", False), ("a", 2, "ivfflat", False), ("b", 1, "ivf", False), ("b", 2, "ivf", True), ("c", 1, "ivfpq", False)]
    catalog = spark.createDataFrame(rows, "index_name string, version bigint, index_type string, dropped boolean")
    for name in ("dimension", "metric", "embedding_model", "pq_dim", "pq_bits", "n_lists", "auto_n_probes", "trained_count"):
        catalog = catalog.withColumn(name, F.lit(None).cast("string"))
    catalog = catalog.withColumn("is_trained", F.lit(False)).withColumn("uid", F.lit(""))
    assert sorted(r["index_name"] for r in list_indexes(catalog).collect()) == ["a", "c"]
    assert list_indexes(catalog.limit(0)).count() == 0
    assert describe_index(catalog, "a").first()["index_type"] == "ivfflat"
