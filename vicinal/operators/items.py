"""The item table: validation, upsert, delete, ordered get, listing, compaction."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.operators.buckets import as_bucketed, bucket_count, bucket_of, fetch, fetch_now
from vicinal.operators.projection import project_items
from vicinal.operators.search import collect_bounded
from vicinal.options import BROADCAST_ROWS, DEFAULT_GET_INCLUDE, ITEM_FIELDS, check_dimension, check_include

ITEM_SCHEMA = "id string, vector array<float>, contents string, metadata variant"
ITEM_COLUMNS = ("id", "vector", "contents", "metadata")


def as_items(df: DataFrame) -> DataFrame:
    """Bring a DataFrame to the item schema.

    Missing optional columns become null, vectors become float arrays, and metadata may
    be JSON text, a struct, a map or a VARIANT. An unknown column is an error.
    """
    unknown = [name for name in df.columns if name not in ITEM_COLUMNS]
    if unknown:
        raise ValueError(f"unknown item field(s) {unknown}")
    if "id" not in df.columns:
        raise ValueError("items need an id column")
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.select(
        F.col("id").cast("string").alias("id"),
        _optional(kinds, "vector").cast("array<float>").alias("vector"),
        _optional(kinds, "contents").cast("string").alias("contents"),
        _metadata(kinds).alias("metadata"),
    )


def _optional(kinds: dict, name: str) -> Column:
    return F.col(name) if name in kinds else F.lit(None)


def _metadata(kinds: dict) -> Column:
    kind = kinds.get("metadata")
    if kind is None or isinstance(kind, T.NullType):
        return F.lit(None).cast("variant")
    if isinstance(kind, T.VariantType):
        return F.col("metadata")
    if isinstance(kind, T.StringType):
        return F.parse_json("metadata")
    return F.parse_json(F.to_json("metadata"))


def rejection(dimension: int | None = None) -> Column:
    """Why an item is not acceptable, or null when it is."""
    vector = F.col("vector")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    reason = (
        F.when(F.col("id").isNull() | (F.col("id") == ""), "missing id")
        .when(vector.isNull(), "missing vector")
        .when(F.size(vector) == 0, "empty vector")
    )
    if dimension is not None:
        reason = reason.when(F.size(vector) != dimension, "wrong dimension")
    return reason.when(odd, "vector component is not finite")


def validate_items(items: DataFrame, dimension: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into acceptable items and rejected ones with a ``reason``."""
    reason = rejection(check_dimension(dimension))
    return items.filter(reason.isNull()), items.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def require_valid(items: DataFrame, dimension: int | None = None) -> DataFrame:
    """Items unchanged; the job fails on the first one that is not acceptable.

    The check rides along with the write, so no second pass over the input is needed,
    and a failed job commits nothing.
    """
    reason = rejection(check_dimension(dimension))
    fault = F.raise_error(F.concat(F.lit("rejected item "), F.coalesce("id", F.lit("(null)")), F.lit(": "), reason))
    return items.withColumn("id", F.when(reason.isNull(), F.col("id")).otherwise(fault.cast("string")))


def duplicate_ids(items: DataFrame) -> DataFrame:
    return items.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def latest(rows: DataFrame, order: Sequence[str], key: str = "id") -> DataFrame:
    """The row with the greatest ``order`` per key, combined on the map side."""
    names = [name for name in rows.columns if name != key]
    best = F.max_by(F.struct(*names), F.struct(*order))
    return rows.groupBy(key).agg(best.alias("row")).select(key, "row.*")


def upsert_state(items: DataFrame, changes: DataFrame, order_col: str | None = None) -> DataFrame:
    """Whole-row insert or replace by id.

    Ids must be unique in ``changes`` unless ``order_col`` says which one wins. Only
    the ids of the changes meet the table, so a small change set is broadcast and the
    table is not shuffled.
    """
    if order_col is not None:
        changes = latest(changes, [order_col]).select(*[c for c in changes.columns if c in items.columns])
    kept = items.join(changes.select("id"), "id", "left_anti")
    return kept.unionByName(changes.select(*items.columns))


def delete_state(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop the given ids; unknown ids are ignored."""
    return items.join(ids.select("id"), "id", "left_anti")


def current_state(log: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """Items after replaying the change log over a snapshot.

    ``log`` is ``(id, vector, contents, metadata, op, seq, uid)``, with ``op`` 'U' or
    'D'; the greatest ``(seq, uid)`` of an id wins. A snapshot laid out by ``bucket`` keeps the column.
    """
    changes = latest(log, ["seq", "uid"])
    written = changes.filter(F.col("op") == "U").select(*ITEM_COLUMNS)
    if snapshot is None:
        return written
    buckets, columns = bucket_count(snapshot), list(ITEM_COLUMNS)
    if buckets:
        written, columns = written.withColumn("bucket", bucket_of("id", buckets)), [*columns, "bucket"]
    state = snapshot.select(*columns).join(changes.select("id"), "id", "left_anti").unionByName(written)
    return as_bucketed(state, buckets) if buckets else state


def compact(log: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """The new snapshot; the caller writes it to a fresh directory."""
    return current_state(log, snapshot)


def get_items(
    items: DataFrame, ids: DataFrame | Sequence[str], include: Iterable[str] | None = None
) -> DataFrame:
    """Items in request order with an ``ordinal``; unknown ids are left out.

    ``ids`` is a list, or a DataFrame ``(ordinal, id)``. An id that is asked for twice
    comes back once per position. Of items laid out by ``bucket`` only the partitions of the ids are read; a
    DataFrame of ids is measured first.
    """
    fields = check_include(include, DEFAULT_GET_INCLUDE, ITEM_FIELDS)
    spark, small = items.sparkSession, True
    if isinstance(ids, DataFrame):
        asked = ids.select("ordinal", "id")
        if bucket_count(items):
            known = collect_bounded(asked, BROADCAST_ROWS)
            small = known is not None
            asked = spark.createDataFrame(known, asked.schema) if small else asked
        else:
            small = False
    else:
        # The caller holds this list in memory, which bounds what is broadcast.
        asked = spark.createDataFrame(list(enumerate(ids)), "ordinal bigint, id string")
    found = fetch_now(items, asked, fields) if small else fetch(items, asked, fields, False)
    return project_items(found, include, lead=["ordinal"]).orderBy("ordinal")


def list_ids(items: DataFrame) -> DataFrame:
    return items.select("id")


def count_items(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("n_items"))
