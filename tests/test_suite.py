"""Every registered query against its SQL, and the shape of the plans."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from vicinal.operators.ivf import probe
from vicinal.operators.clustering import Centroids
from vicinal.plans import suite
from vicinal.plans.suite_sql import SQL
from vicinal.sources.sample_tables import label_queries, vector_items

import numpy as np


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    frame = entry.queries()[name](spark, sf_dir)
    answer = duck.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, answer.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(suite.QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all('"lang":"en"' in row["metadata"] for row in rows)


def _plan(frame):
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["knn_batch_euclidean", "knn_filter_and", "ivf_probe", "pq_search_rerank", "content_query"])
def test_no_cross_join_and_no_row_at_a_time_python(spark, sf_dir, name):
    plan = _plan(suite.QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert "WindowGroupLimit" in plan


def test_search_reads_only_ids_and_vectors(spark, sf_dir, tmp_path):
    path = str(tmp_path / "items")
    vector_items(spark, sf_dir).write.parquet(path)
    hits = suite.knn_exact(spark.read.parquet(path), label_queries(spark, sf_dir), 5)
    # Spark shortens long paths in plans: the scan is told by the columns that it reads.
    scans = [line for line in _plan(hits).splitlines() if "FileScan" in line and "vector:array" in line]
    assert scans and all("contents" not in line and "metadata" not in line for line in scans)


def test_probed_lists_prune_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "cells")
    cells = suite.ivf_assign(spark, sf_dir).join(vector_items(spark, sf_dir).select("id", "vector"), "id")
    cells.write.partitionBy("cell").parquet(path)
    known = Centroids(np.arange(10), np.eye(10, 64), np.zeros(10, np.int64))
    one = label_queries(spark, sf_dir).filter("query_id = 3")
    plan = _plan(probe(spark.read.parquet(path), known, one, 5, n_probes=2))
    assert "PartitionFilters: [" in plan and "cell#" in plan[plan.index("PartitionFilters: [") :].split("]")[0]
