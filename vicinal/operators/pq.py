"""Product quantisation: codebooks, codes, and search over codes with exact re-ranking.

A vector is cut into ``pq_dim`` equal slices; each slice is stored as the number of its
nearest codeword. The codebook table is ``(sub, code, centroid)``: at most 256 codewords
per slice, small whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.functions.blocks import CodeMetric, ResidualMetric, nearest_rows
from vicinal.functions.distance import distance
from vicinal.functions.vectors import to_lists, to_matrix
from vicinal.operators.buckets import fetch
from vicinal.operators.clustering import (
    Centroids,
    block_rows,
    first_vectors,
    load_centroids,
    mean_vectors,
    measure,
    partial_sums,
    training_vector,
)
from vicinal.operators.ivf import _routed
from vicinal.operators.knn import filter_items, finish_hits
from vicinal.operators.projection import hit_fields, project_hits
from vicinal.operators.search import SearchLimits, collect_bounded, few, merge_top_k, search
from vicinal.options import (
    DEFAULT_MAX_ITERS,
    DEFAULT_TOLERANCE,
    RERANK_FACTOR,
    check_metric,
    check_pq,
    check_top_k,
)

_MAX_CODEWORDS = 1 << 20


def load_books(books: DataFrame) -> np.ndarray:
    """Codebooks as (sub, code, width); a code that does not exist is NaN."""
    table = collect_bounded(books.select("sub", "code", "centroid"), _MAX_CODEWORDS)
    if table is None or not table.num_rows:
        raise ValueError("codebooks are empty or too many to ship")
    subs, codes = table["sub"].to_numpy(), table["code"].to_numpy()
    words = to_matrix(table["centroid"])
    array = np.full((subs.max() + 1, codes.max() + 1, words.shape[1]), np.nan)
    array[subs, codes] = words
    return array


def _as_pairs(books: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    known = [np.flatnonzero(~np.isnan(book[:, 0])) for book in books]
    return [(codes, book[codes]) for codes, book in zip(known, books)]


def _as_rows(spark: SparkSession, books: np.ndarray) -> DataFrame:
    pairs = _as_pairs(books)
    table = pa.table(
        {
            "sub": pa.array(np.repeat(np.arange(len(pairs)), [len(codes) for codes, _ in pairs]), pa.int32()),
            "code": pa.array(np.concatenate([codes for codes, _ in pairs]), pa.int32()),
            "centroid": to_lists(np.concatenate([words for _, words in pairs]), pa.float64()),
        }
    )
    return spark.createDataFrame(table)


def pq_step(items: DataFrame, books: DataFrame, metric: str | None = None, digits: int | None = None) -> DataFrame:
    """One k-means round for every slice at once: ``(sub, code, centroid, n)``.

    A codeword that attracts nothing stays where it was, with ``n`` 0.
    """
    vectors = items.filter(F.col("vector").isNotNull())
    vectors = vectors.select(training_vector("vector", check_metric(metric)).alias("vector"))
    known = load_books(books)
    means = mean_vectors(partial_sums(vectors, _as_pairs(known), digits), known.size).withColumnRenamed("cell", "code")
    before = _as_rows(items.sparkSession, known).withColumnRenamed("centroid", "before")
    return before.join(means, ["sub", "code"], "left").select(
        "sub", "code", F.coalesce("centroid", "before").alias("centroid"), F.coalesce("n", F.lit(0)).alias("n")
    )


def train_pq(
    items: DataFrame,
    pq_dim: int,
    pq_bits: int,
    metric: str | None = None,
    max_iters: int | None = None,
    tolerance: float | None = None,
    seed: int = 42,
    shape: tuple[int, int] | None = None,
    batch_size: int | None = None,
    max_memory: int | None = None,
) -> DataFrame:
    """Codebooks ``(sub, code, centroid)`` with up to ``2**pq_bits`` codewords per slice.

    K-means over all items, from the first distinct slices in an order drawn from their values: fewer
    distinct slices than codewords simply give fewer codewords. Each round is one job; only the codebooks come
    back to the driver.
    """
    metric = check_metric(metric)
    items = items.filter(F.col("vector").isNotNull()).select("vector")
    n_items, width = shape or measure(items)
    check_pq(width, pq_dim, pq_bits)
    words, part = 1 << pq_bits, width // pq_dim
    rows = block_rows(batch_size, max_memory, words)
    vectors = items.select(training_vector("vector", metric).alias("vector")).persist()
    try:
        cut = F.transform(F.sequence(F.lit(0), F.lit(pq_dim - 1)), lambda sub: F.slice("vector", sub * part + 1, F.lit(part)))
        seeds = first_vectors(vectors.select(F.posexplode(cut).alias("grp", "vector")), pq_dim, words, seed)
        books = _seed_books(seeds, pq_dim, words)
        for _ in range(DEFAULT_MAX_ITERS if max_iters is None else max_iters):
            moved = books.copy()
            for row in mean_vectors(partial_sums(vectors, _as_pairs(books), None, rows), books.size).collect():
                moved[row["sub"], row["cell"]] = row["centroid"]
            shift = np.nanmax(np.square(moved - books).sum(axis=2))
            books = moved
            if shift <= (DEFAULT_TOLERANCE if tolerance is None else tolerance) ** 2:
                break
    finally:
        vectors.unpersist()
    return _as_rows(items.sparkSession, books)


def _seed_books(seeds: pa.Table, subs: int, words: int) -> np.ndarray:
    """The seeds as (sub, code, width); a codeword that does not exist is NaN."""
    rows, sub = to_matrix(seeds["vector"]), seeds["grp"].to_numpy()
    books = np.full((subs, words, rows.shape[1]), np.nan)
    books[sub, np.arange(len(sub)) - np.searchsorted(sub, sub, side="left")] = rows
    return books


def encode_pq(
    items: DataFrame, books: DataFrame | np.ndarray, metric: str | None = None, digits: int | None = None
) -> DataFrame:
    """Add ``codes``: the nearest codeword of every slice, ties to the smaller code."""
    array = books if isinstance(books, np.ndarray) else load_books(books)
    codes = _nearest_codes(items.sparkSession, training_vector("vector", check_metric(metric)), array, digits)
    return items.withColumn("codes", codes)


def _nearest_codes(spark: SparkSession, vector: Column, books: np.ndarray, digits: int | None) -> Column:
    sent = spark.sparkContext.broadcast(_as_pairs(books))

    def encode(vectors: pa.Array) -> pa.Array:
        pairs = sent.value
        present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        result: list = [None] * len(vectors)
        if len(present):
            rows = to_matrix(vectors.take(pa.array(present)))
            width = rows.shape[1] // len(pairs)
            coded = np.zeros((len(rows), len(pairs)), np.int16)
            for sub, (codes, words) in enumerate(pairs):
                part = np.ascontiguousarray(rows[:, sub * width : (sub + 1) * width])
                at, _, found = nearest_rows(part, words, codes, "euclidean", 1, digits)
                coded[at, sub] = found
            for place, row in zip(present, coded):
                result[place] = row
        return pa.array(result, pa.list_(pa.int16()))

    encode.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(encode, T.ArrayType(T.ShortType()))(vector)


def residuals(placed: DataFrame, centroids: Centroids, metric: str | None = None) -> DataFrame:
    """``placed`` with each vector less the centroid of its ``cell``; unit vectors under cosine."""
    sent = placed.sparkSession.sparkContext.broadcast(centroids)

    def less(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        known = sent.value
        there = pc.and_(vectors.is_valid(), cells.is_valid()).to_numpy(zero_copy_only=False)
        result: list = [None] * len(vectors)
        at = np.flatnonzero(there)
        if len(at):
            rows = to_matrix(vectors.take(pa.array(at)))
            rows = rows - known.matrix[np.searchsorted(known.cells, cells.take(pa.array(at)).to_numpy())]
            for place, row in zip(at.tolist(), rows):
                result[place] = row
        return pa.array(result, pa.list_(pa.float64()))

    less.__annotations__ = {"vectors": pa.Array, "cells": pa.Array, "return": pa.Array}
    made = F.arrow_udf(less, T.ArrayType(T.DoubleType()))(training_vector("vector", check_metric(metric)), F.col("cell"))
    return placed.withColumn("vector", made)


def decode_pq(coded: DataFrame, books: DataFrame | np.ndarray, centroids: Centroids | None = None) -> DataFrame:
    """Add ``decoded``, the vector that the codes stand for; with centroids, of residuals, added to that of the ``cell``."""
    array = books if isinstance(books, np.ndarray) else load_books(books)
    sent = coded.sparkSession.sparkContext.broadcast((array, centroids))

    def decode(codes: pa.Array, cells: pa.Array) -> pa.Array:
        words, known = sent.value
        if not len(codes):
            return pa.array([], pa.list_(pa.float64()))
        rows = to_matrix(codes, np.int64)
        made = words[np.arange(words.shape[0])[None], rows].reshape(len(rows), -1)
        if known is not None:
            made = made + known.matrix[np.searchsorted(known.cells, cells.to_numpy(zero_copy_only=False))]
        return pa.array(list(made), pa.list_(pa.float64()))

    decode.__annotations__ = {"codes": pa.Array, "cells": pa.Array, "return": pa.Array}
    cell = F.col("cell") if "cell" in coded.columns else F.lit(0)
    return coded.withColumn("decoded", F.arrow_udf(decode, T.ArrayType(T.DoubleType()))("codes", cell))


def search_pq(
    codes: DataFrame,
    books: DataFrame | np.ndarray,
    items: DataFrame,
    queries: DataFrame,
    top_k: int | None = None,
    rerank: int = RERANK_FACTOR,
    metric: str | None = None,
    centroids: DataFrame | Centroids | None = None,
    n_probes: int | None = None,
    greedy: bool = False,
    filters: dict | None = None,
    include: Iterable[str] | None = (),
    digits: int | None = None,
    limits: SearchLimits | None = None,
    prune: bool = True,
    matching: Centroids | None = None,
    residual: bool = False,
) -> DataFrame:
    """Search the codes, then order the best ``rerank * top_k`` by exact distance.

    ``codes`` is ``(id, codes)`` and, when ``centroids`` are given, ``cell``. With
    ``rerank=0`` the approximate distances are returned as they are. ``matching`` is as for ``probe``.
    ``residual`` says that the codes are of ``residuals``; that needs centroids.
    """
    top_k, metric = check_top_k(top_k), check_metric(metric)
    fields = hit_fields(include)
    array = books if isinstance(books, np.ndarray) else load_books(books)
    if filters:
        codes = codes.join(filter_items(items, filters).select("id"), "id", "left_semi")
    asked, scored = queries, CodeMetric(metric, array)
    if residual and centroids is None:
        raise ValueError("codes of residuals need the centroids")
    if centroids is not None:
        known = centroids if isinstance(centroids, Centroids) else load_centroids(centroids)
        asked = _routed(queries, known, metric, top_k, n_probes, greedy, matching, digits)
        if residual:
            scored = ResidualMetric(metric, array, known.cells, known.matrix)
    wanted = top_k * max(1, rerank)
    hits, n_queries = search(codes, asked, scored, wanted, "codes", digits, limits, prune)
    if rerank > 0:
        small = n_queries is not None and few(n_queries * wanted)
        rough = hits.select("query_id", "id")
        # Few rows are fetched once, with all that hits carry; of many only those of the final hits.
        carried = [name for name in fields if name != "distance"] if small else []
        exact = fetch(items, rough, list(dict.fromkeys(["vector", *carried])), small)
        asked = queries.select("query_id", "query_vector")
        # The query set passed the broadcast bound when it was counted.
        exact = exact.join(F.broadcast(asked) if n_queries is not None else asked, "query_id")
        value = distance("query_vector", "vector", metric)
        exact = exact.select("query_id", "id", *carried, (value if digits is None else F.round(value, digits)).alias("distance"))
        hits = merge_top_k(exact, top_k, carried=carried)
        if carried:
            return project_hits(hits, fields)
    return finish_hits(hits, items, fields, n_queries, top_k)
