import pytest
from pyspark.sql import functions as F

from vicinal.functions.filters import compile_filter

ROWS = {
    "int": '{"number": 0, "kind": "plum", "tags": ["a", "b"]}',
    "text": '{"number": "0"}',
    "bool": '{"number": false}',
    "real": '{"number": 0.0, "doc": {"quality": 1}}',
    "none": '{"other": 1}',
    "null": '{"number": null}',
    "list": '{"number": [0]}',
    "one": '{"number": 1, "weight": 7.5, "origin": "north", "kind": "plum", "a b": 2}',
    "big": '{"number": 9007199254740993}',
    "nested": '{"metadata": {"weight": 3.5}, "weight": 9.25}',
}


@pytest.fixture(scope="module")
def table(spark):
    rows = list(ROWS.items()) + [("absent", None)]
    return spark.createDataFrame(rows, "id string, metadata string").select("id", F.parse_json("metadata").alias("metadata"))


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({"number": 0}, {"int", "real"}),
        ({"number": "0"}, {"text"}),
        ({"number": False}, {"bool"}),
        ({"number": None}, {"none", "null", "nested", "absent"}),
        ({"number": 9007199254740993}, {"big"}),
        ({"number": 9007199254740992}, set()),
        ({"number": [0]}, {"list"}),
        ({"tags": ["a", "b"]}, {"int"}),
        ({"doc": {"quality": 1}}, {"real"}),
        ({"doc.quality": 1}, {"real"}),
        ({"a b": 2}, {"one"}),
        ({"number": {"$gt": 0}}, {"one", "big"}),
        ({"kind": {"$gt": "pl"}}, {"int", "one"}),
        ({"origin": {"$in": ["south", "north"]}}, {"one"}),
        ({"number": {"$in": [0, "0", True, None]}}, {"int", "real", "text", "none", "null", "nested", "absent"}),
        ({"number": {"$in": []}}, set()),
        ({"metadata.weight": {"$gt": 5}}, {"one"}),
        ({"metadata.weight": 3.5}, {"nested"}),
        ({"weight": {"$gt": 5}}, {"one", "nested"}),
        ({"$and": [{"weight": {"$gt": 2}}, {"number": {"$in": [1, 4]}}, {"kind": "plum"}]}, {"one"}),
        ({"number": {"$gt": 9007199254740992}}, {"big"}),
        ({"number": {"$gte": 9007199254740994}}, set()),
        ({"number": {"$lte": 9007199254740992}}, {"int", "real", "one"}),
        ({"number": {"$lt": 9007199254740994}}, {"int", "real", "one", "big"}),
        ({"kind": "plum", "number": 0}, {"int"}),
        ({"$or": [{"number": "0"}, {"number": 1}]}, {"text", "one"}),
        ({"number": {"$ne": 0}}, set(ROWS) - {"int", "real"} | {"absent"}),
        ({"number": {"$nin": [0, 1]}}, set(ROWS) - {"int", "real", "one"} | {"absent"}),
        ({"$not": {"number": {"$gte": 0}}}, set(ROWS) - {"int", "real", "one", "big"} | {"absent"}),
        ({"number": {"$not": {"$lte": 0}}}, set(ROWS) - {"int", "real"} | {"absent"}),
        ({"number": {"$gte": 0, "$lt": 1}}, {"int", "real"}),
        ({"number": {"$exists": False}}, {"none", "nested", "absent"}),
        ({"number": {"$exists": True}}, set(ROWS) - {"none", "nested"}),
        ({"number": {"$eq": 1}}, {"one"}),
        ({"$and": []}, set(ROWS) | {"absent"}),
        ({"$or": []}, set()),
        ({}, set(ROWS) | {"absent"}),
        (None, set(ROWS) | {"absent"}),
        ('{"number": 1}', {"one"}),
    ],
)
def test_selected_ids(table, filters, expected):
    assert {r["id"] for r in table.filter(compile_filter(filters)).collect()} == expected


@pytest.mark.parametrize(
    "filters",
    [
        {"$xor": []},
        {"a": {"$regex": "x"}},
        {"a": {"$in": 3}},
        {"$and": {"a": 1}},
        {"a": {"$gt": None}},
        {"a": {"$gt": True}},
        {"a..b": 1},
        {"a": {"$not": 3}},
        {"a": object()},
        [1],
    ],
)
def test_malformed_filters(spark, filters):
    with pytest.raises(ValueError):
        compile_filter(filters)


def test_comparisons_reach_the_parquet_scan(spark, table, tmp_path):
    path = str(tmp_path / "items")
    table.write.parquet(path)
    plan = (
        spark.read.parquet(path)
        .filter(compile_filter({"number": {"$gt": 0}, "kind": "plum"}))
        .select("id")
        ._jdf.queryExecution()
        .toString()
    )
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(metadata" in pushed and "GreaterThan(metadata" in pushed
