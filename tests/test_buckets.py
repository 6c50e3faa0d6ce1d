"""Reads by id of a snapshot laid out by buckets, and compactions that write touched buckets alone."""

import re

import numpy as np
import pytest
from conftest import as_answer, brute_force

from vicinal import IVF, IVFPQ, IVFFlat, VectorStore

KEY = bytes(range(32))


@pytest.fixture
def index(spark, tmp_path, random_items):
    def make(config=None, count=300, width=8, encrypt=("vector", "contents", "metadata")):
        matrix = np.random.default_rng(4).normal(size=(count, width))
        store = VectorStore(spark, str(tmp_path / "store"), bucket_bytes=1 << 11)
        made = store.create_index("a", KEY, config or IVFFlat(width), encrypt=encrypt)
        made.upsert(random_items(matrix), auto_train=False)
        return made, matrix

    return make


def item_scans(df):
    """The scans of vectors, contents or metadata of the snapshot, each with its partition filters."""
    text = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.split("\n") if "FileScan" in line and re.search(r"gen#\d+", line)]
    wide = [s for s in scans if re.search(r"(vector|contents|metadata)#\d+", s.split("]")[0])]
    return [bool(re.search(r"PartitionFilters: \[[^]]*(dynamicpruning|bucket#\d+ (IN|=|INSET))", s)) for s in wide]


def test_reads_by_id_prune_buckets(spark, index, as_queries):
    made, matrix = index()
    made.compact()
    entry = made._entry()
    assert entry["buckets"] > 4 and sorted(entry["parts"][0]["buckets"]) == list(range(entry["buckets"]))
    ids = spark.createDataFrame([(0, "7"), (1, "99"), (2, "none"), (3, "7")], "ordinal bigint, id string")
    for asked in (["7", "99", "none", "7"], ids):
        got = made.get(asked, ["vector", "contents"])
        assert item_scans(got) == [True] and [(r["ordinal"], r["id"]) for r in got.collect()] == [(0, "7"), (1, "99"), (3, "7")]
    assert np.allclose(made.get(["5"], ["vector"]).first()["vector"], matrix[5].astype(np.float32))
    queries = as_queries(matrix[:3])
    hits = made.query(query_vectors=queries, top_k=4, include=["distance", "metadata", "contents"])
    # The search itself reads all vectors; what the hits carry is fetched from their buckets.
    assert item_scans(hits).count(False) <= item_scans(hits).count(True) + 1
    assert as_answer(hits) == {q: [(i, pytest.approx(d, abs=1e-6)) for i, d in row] for q, row in brute_force(matrix, matrix[:3], 4).items()}


@pytest.mark.parametrize("config", [IVF(8), IVFFlat(8), IVFPQ(8, 4, 3)])
def test_trained_searches_prune_buckets(index, as_queries, config):
    made, matrix = index(config)
    made.train(n_lists=6, max_iters=3)
    queries = as_queries(matrix[:3])
    expected = brute_force(matrix, matrix[:3], 4)
    for _ in range(2):
        hits = made.query(query_vectors=queries, top_k=4, n_probes=6, rerank=1000, include=["distance", "vector", "metadata"])
        assert item_scans(hits) and all(item_scans(hits))
        got = {q: [(i, round(d, 6)) for i, d in row] for q, row in as_answer(hits).items()}
        assert got == {q: [(i, pytest.approx(d, abs=2e-6)) for i, d in row] for q, row in expected.items()}
        made.delete(["250"])
        expected = brute_force(matrix, matrix[:3], 4, keep=lambda n: n != 250)


def files(made):
    folder = made.store.folder
    base = made.store.items_path(made._entry())
    return {f"{gen}/{bucket}" for gen in folder.names(base) for bucket in folder.names(f"{base}/{gen}") if bucket.startswith("bucket=")}


def test_compaction_writes_touched_buckets(spark, index, random_items):
    made, matrix = index()
    made.compact()
    before, entry = files(made), made._entry()
    made.upsert(random_items(matrix[:1] + 1.0), auto_train=False)
    made.delete(["17", "absent"])
    made.compact()
    fresh = files(made) - before
    after = made._entry()
    assert 1 <= len(fresh) <= 3 and after["buckets"] == entry["buckets"] and after["snapshot_count"] == 299
    held = [b for part in after["parts"] for b in part["buckets"]]
    assert sorted(held) == list(range(after["buckets"]))
    items = {r["id"]: r["vector"] for r in made.items().collect()}
    assert len(items) == 299 and "17" not in items and np.allclose(items["0"], (matrix[0] + 1.0).astype(np.float32))
    made.vacuum()
    assert len(files(made)) <= len(before) and made.items().count() == 299 and made.get(["17", "18"], []).count() == 1


def test_buckets_double_with_the_items(index, random_items):
    made, matrix = index(count=60)
    made.compact()
    first = made._entry()["buckets"]
    made.upsert(random_items(np.random.default_rng(1).normal(size=(900, 8)), prefix="more-"), auto_train=False)
    made.compact()
    entry = made._entry()
    assert entry["buckets"] >= 2 * first and len(entry["parts"]) == 1 and made.count() == entry["snapshot_count"] == 960
    made.delete([str(n) for n in range(60)] + [f"more-{n}" for n in range(900)])
    made.compact()
    assert made.count() == 0 and made.get(["1"]).collect() == [] and made._entry()["snapshot_count"] == 0
    made.compact()
    made.vacuum()
    assert made.count() == 0
