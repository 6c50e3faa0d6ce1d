"""Exact k-nearest-neighbour search, with or without a metadata filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.functions.blocks import VectorMetric
from vicinal.functions.filters import compile_filter
from vicinal.operators.projection import hit_fields, project_hits
from vicinal.operators.search import SearchLimits, attach, search
from vicinal.options import check_metric, check_top_k


def filter_items(items: DataFrame, filters: dict | None) -> DataFrame:
    """Items that satisfy the filter; no filter leaves the plan untouched.

    ``metadata`` is a VARIANT, or JSON text that is parsed for the test.
    """
    if not filters:
        return items
    is_text = dict(items.dtypes)["metadata"] == "string"
    return items.filter(compile_filter(filters, F.parse_json("metadata") if is_text else F.col("metadata")))


def filter_matches(items: DataFrame, filters: dict | None) -> DataFrame:
    return filter_items(items, filters).select("id")


def knn_exact(
    items: DataFrame,
    queries: DataFrame,
    top_k: int | None = None,
    metric: str | None = None,
    filters: dict | None = None,
    include: Iterable[str] | None = (),
    digits: int | None = None,
    limits: SearchLimits | None = None,
) -> DataFrame:
    """The ``top_k`` closest items of each query, closest first, ties by id.

    ``items`` is ``(id, vector, ...)`` and ``queries`` is ``(query_id, query_vector)``.
    The filter is applied below the search, so hits always satisfy it and fewer than
    ``top_k`` of them is a legal answer.
    """
    top_k = check_top_k(top_k)
    fields = hit_fields(include)
    hits, n_queries = search(
        filter_items(items, filters), queries, VectorMetric(check_metric(metric)), top_k, digits=digits, limits=limits
    )
    return finish_hits(hits, items, fields, n_queries, top_k)


def finish_hits(hits: DataFrame, items: DataFrame, fields: list[str], n_queries: int | None, top_k: int) -> DataFrame:
    extra = [name for name in fields if name != "distance"]
    bound = None if n_queries is None else n_queries * top_k
    return project_hits(attach(hits, items, extra, bound), fields)
