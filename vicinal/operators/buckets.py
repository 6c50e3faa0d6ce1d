"""Items laid out by a hash of their id, so that a read by ids opens the partitions of those ids alone.

A table that is laid out so carries the partition column ``bucket``; how many buckets there are stands in the
column's metadata. Readers by id join on the bucket and the id: the planner then prunes partitions by the
buckets of a broadcast side, and otherwise both sides are shuffled on the same keys as without buckets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COUNT = "buckets"


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def in_buckets(numbers: Iterable[int]) -> Column:
    """Rows of the given buckets. As one expression: thousands of literals, each made by its own call, take seconds."""
    listed = ", ".join(str(int(n)) for n in sorted(numbers))
    return F.expr(f"bucket IN ({listed})") if listed else F.lit(False)


def as_bucketed(items: DataFrame, buckets: int) -> DataFrame:
    """Mark the ``bucket`` column with the number of buckets it counts."""
    return items.withMetadata("bucket", {_COUNT: buckets})


def bucket_count(items: DataFrame) -> int | None:
    """The number of buckets of a table laid out by id, else None."""
    return items.schema["bucket"].metadata.get(_COUNT) if "bucket" in items.columns else None


def fetch(items: DataFrame, wanted: DataFrame, fields: list[str], small: bool) -> DataFrame:
    """``wanted``, a table with an ``id``, joined with the fields of its items.

    ``small`` says that the size of ``wanted`` was proven; only then it is broadcast.
    """
    buckets, keys = bucket_count(items), ["id"]
    if buckets:
        wanted, keys = wanted.withColumn("bucket", bucket_of("id", buckets)), ["bucket", "id"]
    return items.select(*keys, *fields).join(F.broadcast(wanted) if small else wanted, keys).drop("bucket")


def fetch_now(items: DataFrame, wanted: DataFrame, fields: list[str]) -> DataFrame:
    """The same for a small ``wanted``: its buckets are looked up first and stand in the plan as a filter.

    For fetches below another one: a plan that prunes by the rows of a join does not nest.
    """
    buckets = bucket_count(items)
    if buckets:
        held = [row[0] for row in wanted.select(bucket_of("id", buckets)).distinct().collect()]
        items = items.filter(in_buckets(held))
    return items.select("id", *fields).join(F.broadcast(wanted), "id")
