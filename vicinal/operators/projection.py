"""Include lists: which fields a hit or a fetched item carries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from vicinal.options import (
    DEFAULT_GET_INCLUDE,
    DEFAULT_QUERY_INCLUDE,
    ITEM_FIELDS,
    QUERY_FIELDS,
    check_include,
)


def hit_fields(include: Iterable[str] | None) -> list[str]:
    """Fields of a hit; an empty list means id and distance."""
    return check_include(include, DEFAULT_QUERY_INCLUDE, QUERY_FIELDS) or ["distance"]


def project_hits(hits: DataFrame, include: Iterable[str] | None = None) -> DataFrame:
    return hits.select("query_id", "rank", "id", *hit_fields(include))


def project_items(items: DataFrame, include: Iterable[str] | None = None, lead: Iterable[str] = ()) -> DataFrame:
    fields = check_include(include, DEFAULT_GET_INCLUDE, ITEM_FIELDS)
    return items.select(*lead, "id", *fields)
