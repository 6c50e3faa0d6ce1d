import numpy as np
import pytest
from conftest import as_answer, brute_force
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vicinal.functions.crypto import key_frame
from vicinal.functions.crypto import decrypt_columns
from vicinal.operators.items import compact
from vicinal.operators.knn import knn_exact
from vicinal.plans.index import VectorStore
from vicinal.sources.index_store import log_schema, write_changes
from vicinal.streaming.ingest import query_stream, upsert_stream

CHANGES = "id string, vector array<float>, contents string, metadata string, op string, at bigint"


def _source(spark, folder, batches):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return stream.withColumn("metadata", F.parse_json("metadata"))


BATCHES = [
    [("a", [1.0], "a1", '{"n": 1}', "U", 1), ("b", [1.0], "b1", None, "U", 2)],
    [("a", [2.0], "a2", None, "U", 3), ("b", None, None, None, "D", 5), ("b", [2.0], "b2", None, "U", 4)],
    [("c", [3.0], "c1", None, "U", 6)],
]


def _state(spark, log):
    return {r["id"]: r["contents"] for r in compact(spark.read.schema(log_schema([])).parquet(f"{log}/*")).collect()}


def test_upsert_stream_replays_to_the_same_state(spark, tmp_path):
    log = str(tmp_path / "log")
    stream = _source(spark, tmp_path / "in", BATCHES)
    upsert_stream(stream, log, str(tmp_path / "check"), order_col="at").awaitTermination()
    assert _state(spark, log) == {"a": "a2", "c": "c1"}
    # Nothing is new, then everything is read again under a fresh checkpoint.
    upsert_stream(stream, log, str(tmp_path / "check"), order_col="at").awaitTermination()
    assert _state(spark, log) == {"a": "a2", "c": "c1"}
    upsert_stream(stream, log, str(tmp_path / "check2"), order_col="at").awaitTermination()
    assert _state(spark, log) == {"a": "a2", "c": "c1"}
    # A checkpoint is a stream of its own: it wrote its five changes, once.
    assert spark.read.parquet(f"{log}/*").count() == 10


def test_late_changes_lose_when_the_stream_numbers_them(spark, tmp_path):
    late = [[("a", [2.0], "newer", None, "U", 9)], [("a", [1.0], "late", None, "U", 3)]]
    stream = _source(spark, tmp_path / "in", late).withColumnRenamed("at", "seq")
    log = str(tmp_path / "log")
    upsert_stream(stream, log, str(tmp_path / "check"), order_col="seq").awaitTermination()
    assert _state(spark, log) == {"a": "newer"}


def test_stream_and_batch_writes_are_ordered_by_their_commit(spark, tmp_path):
    log = str(tmp_path / "log")

    def batch(n, text):
        rows = spark.createDataFrame([("a", [2.0], text, None, "U", 1)], CHANGES).withColumn("metadata", F.parse_json("metadata"))
        write_changes(rows, log, n, f"batch{n}")

    def streamed(n, text):
        stream = _source(spark, tmp_path / f"in{n}", [[("a", [1.0], text, None, "U", 1)]])
        upsert_stream(stream, log, str(tmp_path / f"check{n}"), order_col="at").awaitTermination()

    batch(1, "first")
    streamed(1, "second")
    assert _state(spark, log) == {"a": "second"}
    batch(3, "third")
    assert _state(spark, log) == {"a": "third"}
    streamed(2, "fourth")
    assert _state(spark, log) == {"a": "fourth"}


def test_a_stream_into_an_index_is_checked(spark, tmp_path):
    index = VectorStore(spark, str(tmp_path / "store")).create_index("checked", bytes(32), encrypt=())
    good = _source(spark, tmp_path / "good", [[("a", [1.0, 2.0], "x", None, "U", 1)]]).drop("op")
    index.upsert_stream(good, str(tmp_path / "c1"), order_col="at").awaitTermination()
    index.upsert_stream(good, str(tmp_path / "c2"), order_col="at").awaitTermination()
    assert index.count() == 1 and index.describe().first()["dimension"] == 2
    for n, vector in enumerate(([1.0], [float("nan"), 1.0])):
        bad = _source(spark, tmp_path / f"bad{n}", [[("b", vector, "x", None, "U", 1)]]).drop("op")
        with pytest.raises(StreamingQueryException):
            index.upsert_stream(bad, str(tmp_path / f"d{n}"), order_col="at").awaitTermination()
    assert index.count() == 1 and index.query(query_vector=[1.0, 2.0], top_k=3).count() == 1



def test_encrypted_stream(spark, tmp_path):
    log, key = str(tmp_path / "log"), key_frame(spark, b"k" * 32)
    stream = _source(spark, tmp_path / "in", [[("a", [1.0], "secret", None, "U", 1)]])
    upsert_stream(stream, log, str(tmp_path / "check"), encrypted=["contents"], key_df=key).awaitTermination()
    raw = spark.read.schema(log_schema(["contents"])).parquet(f"{log}/*")
    assert b"secret" not in bytes(raw.first()["contents"])
    assert decrypt_columns(raw, {"contents": "string"}, key).first()["contents"] == "secret"


def test_query_stream(spark, tmp_path, random_items, as_queries):
    rng = np.random.default_rng(8)
    matrix, asked = rng.normal(size=(60, 4)).astype(np.float32), rng.normal(size=(9, 4))
    items = random_items(matrix)
    as_queries(asked).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("query_id bigint, query_vector array<double>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query_stream(
        stream, lambda batch: knn_exact(items, batch, 4, digits=6), str(tmp_path / "out"), str(tmp_path / "check")
    ).awaitTermination()
    assert as_answer(spark.read.parquet(str(tmp_path / "out"))) == brute_force(matrix, asked, 4)
