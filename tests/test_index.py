from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from conftest import as_answer, brute_force
from pyspark.sql import functions as F

from vicinal import IVF, IVFPQ, IVFFlat, VectorStore
from vicinal.functions.embedding import hash_embedder
from vicinal.operators.evaluation import id_prefix_count, leak_check, roundtrip_diff

KEY = bytes(range(32))


@pytest.fixture
def store(spark, tmp_path):
    return VectorStore(spark, str(tmp_path / "store"))


@pytest.fixture
def rows(spark):
    def make(matrix, start=0, tag="x"):
        data = [
            (str(start + n), [float(x) for x in row], f"text {start + n}", f'{{"group": {(start + n) % 3}, "tag": "{tag}"}}')
            for n, row in enumerate(matrix)
        ]
        return spark.createDataFrame(data, "id string, vector array<float>, contents string, metadata string")

    return make


def _ids(df):
    return sorted(r["id"] for r in df.collect())


# Catalogue


def test_create_load_list_describe_delete(store):
    assert store.list_indexes().collect() == []
    index = store.create_index("first", KEY, IVFPQ(16, 4, 8), "cosine", "token-hash")
    store.create_index("second-2_b", KEY)
    assert sorted(r["index_name"] for r in store.list_indexes().collect()) == ["first", "second-2_b"]
    row = index.describe().first()
    assert (row["index_name"], row["index_type"], row["is_trained"]) == ("first", "ivfpq", False)
    assert (row["dimension"], row["metric"], row["embedding_model"], row["pq_dim"], row["pq_bits"]) == (16, "cosine", "token-hash", 4, 8)
    assert store.load_index("first", KEY).describe().first() == row
    with pytest.raises(ValueError, match="already exists"):
        store.create_index("first", KEY)
    with pytest.raises(PermissionError):
        store.load_index("first", KEY[::-1])
    with pytest.raises(LookupError):
        store.load_index("absent", KEY)
    index.delete_index()
    assert [r["index_name"] for r in store.list_indexes().collect()] == ["second-2_b"]
    for call in (index.describe, index.items, lambda: index.query(query_vector=[0.0] * 16), index.delete_index):
        with pytest.raises(LookupError):
            call()
    with pytest.raises(LookupError):
        store.load_index("first", KEY)
    assert store.create_index("first", KEY[::-1], IVF(3)).items().count() == 0


@pytest.mark.parametrize(
    "arguments",
    [
        dict(name=""), dict(name="a/b"), dict(name="a b"), dict(name=".."), dict(name=None),
        dict(key=b""), dict(key=b"x" * 31), dict(key="0" * 64),
        dict(metric="manhattan"), dict(metric=""),
        dict(config=IVF(-1)), dict(config=IVFFlat(0)), dict(config=IVFPQ(10, 3, 8)), dict(config=IVFPQ(8, 4, 9)),
        dict(config=IVFPQ(8, 4, 0)), dict(config="ivf"), dict(encrypt=["id"]),
    ],
)
def test_rejected_settings(store, arguments):
    settings = dict(name="fine", key=KEY, config=None, metric=None)
    with pytest.raises(ValueError):
        store.create_index(**{**settings, **arguments})
    assert store.list_indexes().count() == 0


# Items


def test_upsert_get_delete_flow(spark, store, rows):
    matrix = np.random.default_rng(1).normal(size=(40, 6)).astype(np.float32)
    index = store.create_index("flow", KEY)
    assert index.upsert(rows(matrix)) == {"training_triggered": False}
    assert index.describe().first()["dimension"] == 6
    assert index.count() == 40 and _ids(index.list_ids()) == sorted(str(n) for n in range(40))
    index.upsert(rows(matrix[:5] + 1, tag="y"))
    assert index.count() == 40
    got = index.get(["3", "nope", "39"]).select("ordinal", "id", "vector", "contents", F.to_json("metadata").alias("m")).collect()
    assert [(r["ordinal"], r["id"], r["contents"]) for r in got] == [(0, "3", "text 3"), (2, "39", "text 39")]
    assert got[0]["vector"] == [float(np.float32(x)) for x in matrix[3] + 1]
    assert got[0]["m"] == '{"group":0,"tag":"y"}'
    deleted = ["1", "2", "77"]
    index.delete(deleted)
    frame = spark.createDataFrame([(i,) for i in deleted], "id string")
    hits = index.query(query_vectors=matrix.tolist(), top_k=40, include=[])
    for view in (index.list_ids(), index.get(deleted, []), hits):
        assert leak_check(view, frame).first()["n_leaks"] == 0
    assert index.count() == 38
    index.upsert(rows(matrix[1:2], start=1))
    assert index.count() == 39
    listed = _ids(index.items())
    index.compact()
    index.compact()
    index.vacuum()
    assert _ids(index.items()) == listed
    index.delete(spark.createDataFrame([("0",)], "id string"))
    assert index.count() == 38


def test_items_survive_storage(spark, store):
    deep = '{"level": 1, "nested": {"level": 2, "nested": {"level": 3, "nested": {"level": 4, "nested": {"value": "leaf"}}}}}'
    metadata = [
        '{"test_key": "test_value", "number": 42, "array": [1, 2, 3, 4, 5]}', deep, f'{{"long": "{"x" * 1000}"}}',
        f'{{"list": {list(range(50))}}}', None, "{}",
    ]
    vectors = [[0.0] * 4, [1e-10] * 4, [1e10] * 4, [0.5, -0.25, 3.0, -1e5], [1.0] * 4, [-0.0, 2.0, 1 / 3, 7.0]]
    frame = spark.createDataFrame(
        [(str(n), v, None if n % 2 else f"c{n}", m) for n, (v, m) in enumerate(zip(vectors, metadata))],
        "id string, vector array<float>, contents string, metadata string",
    )
    plain = frame.withColumn("metadata", F.parse_json("metadata"))
    for encrypt in (("vector", "contents", "metadata"), ()):
        index = store.create_index(f"keeps-{len(encrypt)}", KEY, encrypt=encrypt)
        index.upsert(frame)
        assert roundtrip_diff(plain, index.items(), tolerance=0.0).collect() == []
        index.compact()
        assert roundtrip_diff(plain, index.items(), tolerance=0.0).collect() == []


def test_stored_columns_are_ciphertext(spark, store, rows, tmp_path):
    index = store.create_index("sealed", KEY)
    index.upsert(rows([[1.0, 2.0]]))
    raw = b"".join(p.read_bytes() for p in (tmp_path / "store").rglob("*.parquet"))
    assert b"text 0" not in raw and b"tag" not in raw and KEY not in raw


def test_rejected_upserts_write_nothing(spark, store, rows):
    index = store.create_index("strict", KEY, IVFFlat(4))
    for bad in ([[1.0] * 3], [[]], [[1.0, 2.0, 3.0, float("nan")]], [[1.0] * 4, [1.0] * 5]):
        with pytest.raises(ValueError, match="rejected item"):
            index.upsert(rows(bad))
    with pytest.raises(ValueError, match="more than once"):
        index.upsert(rows([[1.0] * 4]).union(rows([[2.0] * 4])))
    with pytest.raises(ValueError, match="unknown item field"):
        index.upsert(rows([[1.0] * 4]).withColumn("colour", F.lit(1)))
    assert index.count() == 0
    both = rows([[1.0] * 4]).withColumn("at", F.lit(1)).union(rows([[2.0] * 4]).withColumn("at", F.lit(2)))
    index.upsert(both, order_col="at")
    assert index.get(["0"]).first()["vector"] == [2.0] * 4


def test_concurrent_upserts_all_land(spark, store, rows):
    index = store.create_index("shared", KEY, IVFFlat(4))

    def write(n):
        index.upsert(rows([[float(n)] * 4]).withColumn("id", F.lit(f"writer-{n}")), auto_train=False)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(20)))
    assert id_prefix_count(index.items(), "writer-").first()["n_items"] == 20


def test_one_of_two_creates_wins_and_first_writes_keep_each_other(spark, store, rows):
    def create(_):
        try:
            return store.create_index("raced", KEY)
        except ValueError:
            return None

    with ThreadPoolExecutor(4) as pool:
        made = [index for index in pool.map(create, range(4)) if index]
    assert len(made) == 1
    parts = [rows([[float(n)] * 4]).withColumn("id", F.lit(f"first-{n}")) for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda part: made[0].upsert(part, auto_train=False), parts))
    assert made[0].count() == 4 and made[0].describe().first()["dimension"] == 4


def test_unknown_embedding_models_are_refused(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"), embedders={"mine": hash_embedder(8)})
    store.create_index("known", KEY, embedding_model="mine")
    with pytest.raises(ValueError):
        store.create_index("unknown", KEY, embedding_model="other")
    other = VectorStore(spark, str(tmp_path / "store")).load_index("known", KEY)
    with pytest.raises(ValueError):
        other.query(query_contents="x")


def test_vacuum_removes_old_trainings(spark, store, rows):
    index = store.create_index("cleaned", KEY)
    index.upsert(rows(np.random.default_rng(1).normal(size=(20, 4)).tolist()), auto_train=False)
    for _ in range(2):
        index.train(n_lists=2, max_iters=1)
    index.vacuum()
    assert len(store.store.folder.names(f"{store.store.index_path(index._entry())}/lists")) == 1
    assert index.query(query_vector=[0.0] * 4, top_k=3).count() == 3


def test_contents_are_embedded_on_ingest(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"), embedder=hash_embedder(16))
    index = store.create_index("texts", KEY, metric="cosine")
    index.upsert(spark.createDataFrame([("a", "red apples"), ("b", "blue sky")], "id string, contents string"))
    assert index.describe().first()["dimension"] == 16
    assert index.query(query_contents="apples", top_k=1).first()["id"] == "a"


# Search


def test_untrained_search_is_exact(store, rows):
    matrix = np.random.default_rng(2).normal(size=(50, 6)).astype(np.float32)
    index = store.create_index("exact", KEY)
    index.upsert(rows(matrix))
    hits = index.query(query_vectors=matrix[:3].tolist(), top_k=5, n_probes=1, include=[])
    assert [(r["query_id"], r["rank"]) for r in hits.collect()] == [(q, k) for q in range(3) for k in range(1, 6)]
    rounded = hits.withColumn("distance", F.round("distance", 6))
    assert as_answer(rounded) == brute_force(matrix, matrix[:3], 5)
    assert not index.is_trained


def test_query_arguments(store, rows):
    index = store.create_index("picky", KEY)
    empty = index.query(query_vector=[1.0, 2.0], top_k=3)
    assert empty.columns == ["query_id", "rank", "id", "distance", "metadata"] and empty.collect() == []
    index.upsert(rows([[1.0, 2.0], [3.0, 4.0]]))
    for bad in (
        dict(), dict(query_vector=[1.0, 2.0], query_contents="x"), dict(query_vector=[1.0]), dict(query_vector=[]),
        dict(query_vectors=[[1.0, 2.0], [1.0]]), dict(query_vector=[1.0, 2.0], top_k=0),
        dict(query_vector=[1.0, 2.0], top_k=-5), dict(query_vector=[1.0, 2.0], n_probes=0),
        dict(query_vector=[1.0, 2.0], include=["colour"]), dict(query_vector=[1.0, 2.0], filters={"a": {"$near": 1}}),
    ):
        with pytest.raises(ValueError):
            index.query(**bad)
    assert index.query(query_vector=[1.0, 2.0]).count() == 2
    assert index.query(query_vectors=[]).count() == 0


@pytest.mark.parametrize("config", [IVF(8), IVFFlat(8), IVFPQ(8, 4, 4)], ids=["ivf", "ivfflat", "ivfpq"])
def test_trained_index_follows_later_changes(store, rows, config):
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(120, 8)).astype(np.float32)
    index = store.create_index("trained", KEY, config)
    index.upsert(rows(matrix[:100]))
    index.train(n_lists=6, max_iters=5, top_k=10)
    row = index.describe().first()
    assert row["is_trained"] and row["n_lists"] == 6 and row["trained_count"] == 100 and 1 <= row["auto_n_probes"] <= 6
    index.upsert(rows(matrix[100:], start=100))
    index.delete(["0", "5"])
    matrix[7] = matrix[7] + 1
    index.upsert(rows(matrix[7:8], start=7))
    queries = matrix[[0, 7, 110]].astype(float)
    options = dict(query_vectors=queries.tolist(), top_k=8, include=["distance"], rerank=20)

    def answer(**more):
        return as_answer(index.query(**options, **more).withColumn("distance", F.round("distance", 6)))

    assert answer(n_probes=6) == brute_force(matrix, queries, 8, keep=lambda n: n not in (0, 5))
    filtered = brute_force(matrix, queries, 8, keep=lambda n: n not in (0, 5) and n % 3 == 1)
    assert answer(n_probes=6, filters={"group": 1}) == filtered
    auto = answer()
    assert auto[1][0] == ("7", 0.0) and all(len(hits) <= 8 for hits in auto.values())
    if isinstance(config, IVFFlat):
        assert answer(greedy=True)[2][0] == ("110", 0.0)
        index.compact()
        index.vacuum()
        assert answer(n_probes=6, filters={"group": 1}) == filtered


def test_training_is_triggered_by_growth(spark, tmp_path, rows):
    store = VectorStore(spark, str(tmp_path / "store"), train_threshold=30, retrain_multiplier=2.0)
    matrix = np.random.default_rng(6).normal(size=(70, 4)).astype(np.float32)
    index = store.create_index("grows", KEY)
    assert not index.upsert(rows(matrix[:20]))["training_triggered"]
    assert not index.status().first()["needs_training"]
    assert index.upsert(rows(matrix[20:35], start=20), auto_train=False) == {"training_triggered": False}
    assert index.status().first()["needs_training"]
    assert index.upsert(rows(matrix[:1])) == {"training_triggered": True}
    assert index.describe().first()["trained_count"] == 35
    # Replaced rows do not count as growth.
    assert not index.upsert(rows(matrix[:35] * 2))["training_triggered"]
    assert index.upsert(rows(matrix[35:], start=35))["training_triggered"]
    assert index.status().first()["trained_count"] == 70


def test_training_options(store, rows):
    index = store.create_index("options", KEY)
    with pytest.raises(ValueError):
        index.train()
    index.upsert(rows(np.eye(6)))
    with pytest.raises(ValueError):
        index.train(batch_size=0)
    index.train(n_lists=0, batch_size=2, max_iters=1, tolerance=0.1, max_memory=1)
    assert index.describe().first()["n_lists"] == 2
