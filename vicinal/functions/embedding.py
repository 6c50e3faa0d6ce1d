"""Text to vector: a pluggable embedder and a small deterministic default."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[pd.Series], pd.Series]

_TOKEN = re.compile(r"[a-z]+")
_REMEMBERED_TOKENS = 1 << 20
_CHUNK_TEXTS = 256


class _Buckets(dict):
    """Token to bucket, remembered per worker up to a bound."""

    def __init__(self, dimension: int):
        super().__init__()
        self.dimension = dimension

    def __missing__(self, token: str) -> int:
        if len(self) >= _REMEMBERED_TOKENS:
            self.clear()
        bucket = self[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dimension
        return bucket


def hash_embedder(dimension: int = 64) -> Embedder:
    """Token counts hashed to ``dimension`` buckets and scaled to unit length.

    Needs no model file and gives the same vector everywhere. Text without a token
    becomes the zero vector, a null text stays null.
    """

    def embed(texts: pd.Series) -> pd.Series:
        buckets = _Buckets(dimension)
        vectors: list = []
        for start in range(0, len(texts), _CHUNK_TEXTS):
            vectors.extend(_embed_chunk(texts.iloc[start : start + _CHUNK_TEXTS], buckets))
        return pd.Series(vectors, index=texts.index, dtype=object)

    return embed


def _embed_chunk(texts: pd.Series, buckets: _Buckets) -> list:
    tokens = [[] if text is None else _TOKEN.findall(text.lower()) for text in texts]
    rows = np.repeat(np.arange(len(tokens)), [len(row) for row in tokens])
    found = np.fromiter(map(buckets.__getitem__, chain.from_iterable(tokens)), np.int64, len(rows))
    width = buckets.dimension
    counts = np.bincount(rows * width + found, minlength=len(tokens) * width).reshape(-1, width).astype(np.float64)
    lengths = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    unit = (counts / np.where(lengths > 0, lengths, 1.0)[:, None]).astype(np.float32)
    return [None if text is None else vector for text, vector in zip(texts, unit)]


def embedding(text: Column | str, embedder: Embedder | None = None) -> Column:
    """The embedder as an ``array<float>`` column expression over Arrow batches."""
    embed = embedder or hash_embedder()

    def run(texts: pd.Series) -> pd.Series:
        return embed(texts)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    udf = F.pandas_udf(run, "array<float>")
    return udf(F.col(text) if isinstance(text, str) else text)


def embed_text(df: DataFrame, col: str, output: str = "vector", embedder: Embedder | None = None) -> DataFrame:
    """Add ``output`` computed from a text column."""
    return df.withColumn(output, embedding(col, embedder))


def embed_missing(items: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Embed items that carry contents but no vector; other rows keep their vector."""
    needed = F.col("vector").isNull() & F.col("contents").isNotNull()
    # The text is blanked where it is not needed, so only the needy rows are embedded.
    made = embedding(F.when(needed, F.col("contents")), embedder)
    return items.withColumn("vector", F.coalesce(F.col("vector"), made))
