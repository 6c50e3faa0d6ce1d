import hashlib

import numpy as np
import pandas as pd
import pytest
from conftest import as_answer

from vicinal.functions.embedding import embed_missing, embed_text, hash_embedder
from vicinal.operators.knn import knn_exact


def _expected(text, dimension=64):
    counts = np.zeros(dimension)
    word = ""
    for letter in text.lower() + " ":
        if "a" <= letter <= "z":
            word += letter
        elif word:
            counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimension] += 1
            word = ""
    length = np.linalg.norm(counts)
    return counts / length if length else counts


def test_hash_embedding(spark):
    texts = ["Hello, hello world!", "", "123", "naïve café"]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(9, None)], "n int, text string")
    rows = {r["n"]: r["vector"] for r in embed_text(frame, "text").collect()}
    for n, text in enumerate(texts):
        np.testing.assert_allclose(rows[n], _expected(text), atol=1e-7)
    assert rows[9] is None
    assert len(hash_embedder(8)(pd.Series(["a b"]))[0]) == 8


def test_a_caller_may_plug_in_an_embedder(spark):
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [float(len(t)), 1.0])

    frame = spark.createDataFrame([("a", "xyz")], "id string, text string")
    assert embed_text(frame, "text", embedder=lengths).first()["vector"] == [3.0, 1.0]


def test_only_missing_vectors_are_embedded(spark):
    rows = [("kept", [1.0, 0.0], "text"), ("made", None, "text"), ("none", None, None)]
    frame = spark.createDataFrame(rows, "id string, vector array<float>, contents string")
    made = {r["id"]: r["vector"] for r in embed_missing(frame, hash_embedder(2)).collect()}
    assert made["kept"] == [1.0, 0.0] and len(made["made"]) == 2 and made["none"] is None


def test_search_by_text(spark):
    texts = ["red apples and pears", "blue skies over the sea", "green apples"]
    items = embed_text(spark.createDataFrame(list(enumerate(texts)), "n int, text string"), "text").selectExpr("cast(n AS string) AS id", "vector")
    queries = embed_text(spark.createDataFrame([(0, "apples")], "query_id bigint, text string"), "text", "query_vector")
    assert {i for i, _ in as_answer(knn_exact(items, queries, 2, "cosine"))[0]} == {"0", "2"}


@pytest.mark.parametrize("text", ["x" * 1000, "word " * 20_000])
def test_long_texts_are_read_whole(spark, text):
    frame = spark.createDataFrame([(text + " zebra",)], "text string")
    np.testing.assert_allclose(embed_text(frame, "text").first()["vector"], _expected(text + " zebra"), atol=1e-6)
