import pytest
from pyspark.sql import functions as F

from vicinal.operators.items import (
    as_items,
    compact,
    count_items,
    current_state,
    delete_state,
    duplicate_ids,
    get_items,
    list_ids,
    require_valid,
    upsert_state,
    validate_items,
)
from vicinal.sources.item_files import read_items_json, read_items_parquet, write_items_json

LOG = "id string, vector array<float>, contents string, metadata string, op string, seq bigint, uid string"


@pytest.fixture
def items(spark):
    rows = [(str(n), [float(n), 1.0], f"c{n}", f'{{"n": {n}}}') for n in range(6)]
    return as_items(spark.createDataFrame(rows, "id string, vector array<double>, contents string, metadata string"))


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_item_schema(spark, items):
    assert [f"{n} {t}" for n, t in items.dtypes] == ["id string", "vector array<float>", "contents string", "metadata variant"]
    bare = as_items(spark.createDataFrame([(1,)], "id int"))
    assert bare.first().asDict() == {"id": "1", "vector": None, "contents": None, "metadata": None}
    with pytest.raises(ValueError, match="unknown item field"):
        as_items(items.withColumn("colour", F.lit(1)))
    with pytest.raises(ValueError, match="id column"):
        as_items(items.drop("id"))


def test_metadata_may_be_a_struct(spark):
    frame = spark.range(1).select(F.lit("a").alias("id"), F.struct(F.lit(3).alias("x")).alias("metadata"))
    assert as_items(frame).select(F.to_json("metadata").alias("m")).first()["m"] == '{"x":3}'


def test_validation_reasons(spark):
    nan = float("nan")
    rows = [
        ("ok", [1.0, 2.0]), ("zero", [0.0, 0.0]), ("tiny", [1e-10, 1e-10]), ("huge", [1e10, -1e10]),
        (None, [1.0, 2.0]), ("", [1.0, 2.0]), ("none", None), ("empty", []), ("short", [1.0]), ("nan", [1.0, nan]),
        ("hole", [1.0, None]), ("inf", [float("inf"), 1.0]),
    ]
    good, bad = validate_items(spark.createDataFrame(rows, "id string, vector array<float>"), 2)
    assert _ids(good) == ["huge", "ok", "tiny", "zero"]
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {
        (None, "missing id"), ("", "missing id"), ("none", "missing vector"), ("empty", "empty vector"),
        ("short", "wrong dimension"), ("nan", "vector component is not finite"),
        ("hole", "vector component is not finite"), ("inf", "vector component is not finite"),
    }


@pytest.mark.parametrize("width, accepted", [(64, False), (256, False), (0, False), (128, True)])
def test_dimension_of_128(spark, width, accepted):
    frame = spark.createDataFrame([("a", [1.0] * width)], "id string, vector array<float>")
    if accepted:
        assert require_valid(frame, 128).count() == 1
        assert require_valid(frame, 128).first()["id"] == "a"
    else:
        with pytest.raises(Exception, match="rejected item a"):
            require_valid(frame, 128).collect()


def test_upsert_replaces_whole_rows_and_is_idempotent(spark, items):
    changes = as_items(spark.createDataFrame([("3", [9.0, 9.0]), ("new", [8.0, 8.0])], "id string, vector array<float>"))
    once = upsert_state(items, changes)
    twice = upsert_state(once, changes)
    assert _ids(once) == ["0", "1", "2", "3", "4", "5", "new"]
    replaced = once.filter("id = '3'").first()
    assert replaced["vector"] == [9.0, 9.0] and replaced["contents"] is None and replaced["metadata"] is None
    assert _ids(twice) == _ids(once)


def test_order_column_decides_between_duplicates(spark, items):
    rows = [("3", [1.0, 1.0], 1), ("3", [3.0, 3.0], 3), ("3", [2.0, 2.0], 2)]
    frame = spark.createDataFrame(rows, "id string, vector array<float>, at int")
    assert [r["n"] for r in duplicate_ids(frame).collect()] == [3]
    changes = frame.select("id", "vector", F.lit(None).cast("string").alias("contents"), F.lit(None).cast("variant").alias("metadata"), "at")
    state = upsert_state(items, changes, order_col="at")
    assert state.filter("id = '3'").first()["vector"] == [3.0, 3.0]
    assert state.count() == 6


def test_delete_ignores_unknown_ids(spark, items):
    left = delete_state(items, spark.createDataFrame([("1",), ("99",), ("1",)], "id string"))
    assert _ids(left) == ["0", "2", "3", "4", "5"]


def test_get_keeps_request_order_and_repeats(items):
    got = get_items(items, ["5", "nope", "0", "5"], ["contents"]).collect()
    assert [(r["ordinal"], r["id"], r["contents"]) for r in got] == [(0, "5", "c5"), (2, "0", "c0"), (3, "5", "c5")]
    assert get_items(items, ["1"]).columns == ["ordinal", "id", "vector", "contents", "metadata"]
    assert get_items(items, ["1"], []).columns == ["ordinal", "id"]
    with pytest.raises(ValueError):
        get_items(items, ["1"], ["distance"])


def test_get_of_a_thousand_ids(spark):
    frame = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.array(F.col("id").cast("float")).alias("vector"))
    asked = [str(n) for n in range(4999, 2999, -2)]
    got = get_items(as_items(frame), asked, ["vector"]).collect()
    assert [r["id"] for r in got] == asked
    assert all(r["vector"] == [float(r["id"])] for r in got)


def test_list_and_count(items):
    assert _ids(list_ids(items)) == ["0", "1", "2", "3", "4", "5"]
    assert count_items(items).first()["n_items"] == 6


def test_log_replay(spark, items):
    rows = [
        ("a", [1.0], "old", None, "U", 1, "x"),
        ("a", [2.0], "new", None, "U", 2, "x"),
        ("b", [3.0], "b", None, "U", 1, "x"),
        ("b", None, None, None, "D", 3, "x"),
        ("c", None, None, None, "D", 1, "x"),
        ("c", [4.0], "back", None, "U", 2, "x"),
        ("d", [5.0], "loses", None, "U", 7, "a"),
        ("d", [6.0], "wins", None, "U", 7, "b"),
        ("0", None, None, None, "D", 9, "x"),
    ]
    log = spark.createDataFrame(rows, LOG).withColumn("metadata", F.parse_json("metadata"))
    state = {r["id"]: r["contents"] for r in compact(log).collect()}
    assert state == {"a": "new", "c": "back", "d": "wins"}
    again = {r["id"]: r["contents"] for r in compact(log.union(log)).collect()}
    assert again == state
    assert _ids(current_state(log, items)) == ["1", "2", "3", "4", "5", "a", "c", "d"]


def test_json_lines(spark, items, tmp_path):
    path = str(tmp_path / "items")
    write_items_json(items, path)
    back = read_items_json(spark, path)
    assert back.select("id", "vector", "contents", F.to_json("metadata")).orderBy("id").collect() == (
        items.select("id", "vector", "contents", F.to_json("metadata")).orderBy("id").collect()
    )
    (tmp_path / "odd.json").write_text('{"id": "a", "vector": [1], "colour": 3}\n')
    with pytest.raises(Exception, match="unknown item field colour"):
        read_items_json(spark, str(tmp_path / "odd.json")).collect()
    (tmp_path / "broken.json").write_text('{"id": "a", "vec\n')
    with pytest.raises(Exception, match="malformed item line"):
        read_items_json(spark, str(tmp_path / "broken.json")).collect()


def test_parquet(spark, items, tmp_path):
    path = str(tmp_path / "items")
    items.write.parquet(path)
    assert _ids(read_items_parquet(spark, path)) == _ids(items)
