import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vicinal.session import local_session, ship_package  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=3)
    # Hundreds of tiny plans: compiling each costs more than running it. check.py and
    # bench.py run the same queries with code generation.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def random_items(spark):
    """A maker of item tables from a matrix, with group numbers as metadata."""

    def make(matrix, prefix=""):
        rows = [
            (f"{prefix}{n}", [float(x) for x in row], f"text {n}", f'{{"group": {n % 3}, "n": {n}}}')
            for n, row in enumerate(matrix)
        ]
        frame = spark.createDataFrame(rows, "id string, vector array<float>, contents string, metadata string")
        return frame.selectExpr("id", "vector", "contents", "parse_json(metadata) AS metadata").repartition(5)

    return make


@pytest.fixture
def as_queries(spark):
    def make(matrix):
        rows = [(n, [float(x) for x in row]) for n, row in enumerate(matrix)]
        return spark.createDataFrame(rows, "query_id bigint, query_vector array<double>")

    return make


def brute_force(items, queries, k, metric="euclidean", digits=6, keep=lambda n: True):
    """Expected ``{query: [(id, distance), ...]}`` computed pair by pair."""
    items = np.asarray(items, np.float32).astype(np.float64)
    queries = np.asarray(queries, np.float64)
    answer = {}
    for q, query in enumerate(queries):
        scored = []
        for n, item in enumerate(items):
            if not keep(n):
                continue
            if metric == "euclidean":
                d = float(np.sqrt(np.sum((query - item) ** 2)))
            elif metric == "dot_product":
                d = -float(query @ item)
            else:
                lengths = np.linalg.norm(query) * np.linalg.norm(item)
                d = 1.0 - float(query @ item) / lengths if lengths else 1.0
            scored.append((round(d, digits) + 0.0, str(n)))
        answer[q] = [(i, d) for d, i in sorted(scored)[:k]]
    return answer


def as_answer(hits):
    answer = {}
    for row in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        answer.setdefault(row["query_id"], []).append((row["id"], row["distance"]))
    return answer
