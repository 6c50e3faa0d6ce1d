"""Top-k search over a table of vectors or codes.

Three plans, chosen by measured sizes:

* The query set fits the broadcast bound: it is shipped and every task streams its own
  split of the base table past it. The base is scanned where it lies; only ``k`` rows
  per query and task are shuffled. Over many tasks a part of them goes first: what lies
  beyond the ``k`` best of that part is then never emitted, so that the rows that are
  shuffled grow with the root of the number of tasks, and all queries take one pass.
* The base fits instead: it is shipped, every task streams its split of the queries, and
  the answer of a query is complete in its task. Nothing is shuffled.
* Neither fits: base and queries are cut into blocks of a bounded number of rows
  and co-grouped block by block, again emitting ``k`` rows per query and block. A cell
  that holds a large share of the rows, or is probed by a large share of the queries,
  becomes many blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinal.functions.blocks import TextIds, TopK, plain_ids
from vicinal.functions.vectors import to_matrix
from vicinal.operators.buckets import fetch
from vicinal.options import BLOCK_ROWS, BROADCAST_BYTES, BROADCAST_ROWS

_SPLIT_BYTES = 128 << 20
_MERGE_ROWS = 1_000_000
_EMIT_ROWS = 5_000_000
_UNKNOWN_BYTES = 1 << 50
_ATTACH_ROWS = 500_000
_PRUNE_CELLS = 10_000
_HELD_ROWS = 1_000_000
_MAX_PASSES = 16
_OUTPUT_ROWS = 1 << 16


@dataclass(frozen=True)
class SearchLimits:
    """Sizes at which the plan changes; lowered in tests to force each plan."""

    broadcast_rows: int = BROADCAST_ROWS
    broadcast_bytes: int = BROADCAST_BYTES
    pass_rows: int = BROADCAST_ROWS
    block_rows: int = BLOCK_ROWS
    merge_rows: int = _MERGE_ROWS
    emit_rows: int = _EMIT_ROWS


def collect_bounded(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> pa.Table | None:
    """The rows on the driver, or None when there are more than the bound allows.

    Where Catalyst's estimate alone does not rule out a large result, the rows are
    counted first: a limit over many partitions would gather a full limit from each.
    """
    if plan_bytes(df) > max_bytes and df.count() > max_rows:
        return None
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows and table.nbytes <= max_bytes else None


def settle(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A small table computed once, for use in several searches; a large one as it is."""
    table = collect_bounded(df, max_rows)
    return df if table is None else df.sparkSession.createDataFrame(table, df.schema)


def search(
    base: DataFrame,
    queries: DataFrame,
    metric,
    top_k: int,
    value: str = "vector",
    digits: int | None = None,
    limits: SearchLimits | None = None,
    prune: bool = True,
    shipped: pa.Table | None = None,
) -> tuple[DataFrame, int | None]:
    """Best ``top_k`` base rows per query as ``(query_id, rank, id, distance)``.

    ``base`` has ``id``, the ``value`` column and, when ``queries`` carries a ``cells``
    array, the ``cell`` it lies in. Query ids are unique. ``prune`` filters the base on
    the probed cells; it pays where cells are stored, not where they are computed in the
    same plan. Also returns the number of queries when it was measured. ``shipped`` is what
    ``ship`` returned for the same queries, where the caller asked for it.

    Rows without a value are skipped inside the tasks: a null filter in the plan would
    make Spark evaluate a value that comes from a Python function twice.
    """
    limits = limits or SearchLimits()
    probing = "cells" in queries.columns
    queries = _asked(queries)
    base = base.select("id", F.col(value).alias("value"), *(["cell"] if probing else []))
    shards = _shards(base, top_k, limits)

    per_pass = min(limits.pass_rows, _queries_per_task(metric, top_k))
    if shipped is None:
        shipped = ship(queries, metric, top_k, limits)
    _require_unique(queries, shipped)
    if shipped is None:
        small = None if probing else collect_bounded(base, limits.broadcast_rows, limits.broadcast_bytes)
        if small is not None:
            return _by_small_base(small, queries, metric, top_k, digits), None
        found = _by_blocks(base, queries, metric, top_k, digits, limits, shards)
        return merge_top_k(found, top_k, shards), None
    if probing and prune:
        base = prune_cells(base, shipped)
    found = candidates(base, queries, shipped, metric, top_k, digits, limits, shards)
    return merge_top_k(found, top_k, shards), shipped.num_rows


def candidates(base, queries, shipped, metric, top_k, digits, limits, shards: int = 1) -> DataFrame:
    """What the tasks emit for a shipped query set.

    Where ``k`` rows from each task would be many, every n-th task goes first, n about the root of their number.
    The ``k``-th distance that a query has there bounds its true one, so the others emit what lies within. The
    result is the same whatever those tasks hold; rows in an order that keeps near ones together only loosen the bound.
    """
    per_pass = min(limits.pass_rows, _queries_per_task(metric, top_k))

    def scan(size: int, stride: int, most: np.ndarray | None) -> DataFrame:
        parts = range(0, max(1, shipped.num_rows), size)
        found = [
            _by_broadcast(base, queries, shipped.slice(n, size), metric, top_k, digits, shards, stride, None if most is None else most[n : n + size])
            for n in parts
        ]
        return reduce(DataFrame.unionByName, found)

    tasks = _tasks(base)
    if tasks * top_k * shipped.num_rows <= limits.emit_rows or tasks < 4:
        # Where a task cannot hold the winners of all queries, the base is scanned again for the next ones.
        return scan(per_pass, 1, None)
    # An estimate of no known size says nothing about the number of tasks.
    stride = max(2, round(math.sqrt(tasks if scanned_bytes(base) < _UNKNOWN_BYTES else _shuffle_tasks(base))))
    first = merge_top_k(scan(per_pass, stride, None), top_k, shards).filter(F.col("rank") == top_k).select("query_id", "distance").toArrow()
    most = np.full(shipped.num_rows, np.inf)
    at = pc.index_in(first["query_id"], shipped["query_id"].combine_chunks()).to_numpy(zero_copy_only=False)
    most[at.astype(np.int64)] = first["distance"].to_numpy()
    # A query with a bound emits few rows: all of them go in one pass, but for the size of their lookup tables.
    bounded = np.isfinite(most).all()
    return scan(min(limits.pass_rows, metric.max_queries) if bounded else per_pass, 1, most)


def _asked(queries: DataFrame) -> DataFrame:
    """The columns that a search reads, ids as 64-bit integers or strings."""
    kind = dict(queries.dtypes)["query_id"]
    if kind not in ("string", "bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"query ids must be integers or strings, not {kind}")
    name = F.col("query_id") if kind == "string" else F.col("query_id").cast("bigint").alias("query_id")
    return queries.select(name, "query_vector", *(["cells"] if "cells" in queries.columns else []))


def ship(queries: DataFrame, metric, top_k: int, limits: SearchLimits) -> pa.Table | None:
    """The query set on the driver if it fits the broadcast bound."""
    per_pass = min(limits.pass_rows, _queries_per_task(metric, top_k))
    return collect_bounded(_asked(queries), min(limits.broadcast_rows, _MAX_PASSES * per_pass), limits.broadcast_bytes)


def _require_unique(queries: DataFrame, shipped: pa.Table | None) -> None:
    """The same rule under every plan: one row per query id."""
    if shipped is not None:
        repeated = len(shipped) > 0 and pc.count_distinct(shipped["query_id"], mode="all").as_py() < len(shipped)
    else:
        repeated = bool(queries.groupBy("query_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect())
    if repeated:
        raise ValueError("query ids must be unique")


def merge_top_k(found: DataFrame, top_k: int, shards: int = 1, carried: list[str] = []) -> DataFrame:  # noqa: B006
    """Reduce per-task winners to the best ``top_k`` of each query.

    With several shards a first round reduces the rows of one query in many tasks, so
    that a single query over a huge table does not end in one long sort.
    """
    order = ["distance", "id"]
    if shards > 1:
        partial = Window.partitionBy("query_id", "shard").orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(partial)).filter(F.col("rank") <= top_k).drop("rank")
    final = Window.partitionBy("query_id").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= top_k)
    return ranked.select("query_id", "rank", "id", "distance", *carried)


def attach(hits: DataFrame, items: DataFrame, fields: list[str], max_hits: int | None) -> DataFrame:
    """Fetch item fields for the hits only, after the search."""
    if not fields:
        return hits
    # The bound on the hits is proven by the measured query count times top_k.
    return fetch(items, hits, fields, few(max_hits))


def few(max_rows: int | None) -> bool:
    """Whether a proven number of hits may be broadcast."""
    return max_rows is not None and max_rows <= _ATTACH_ROWS


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; nothing is executed."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _queries_per_task(metric, top_k: int) -> int:
    """As many as keep a task's running winners, and its lookup tables, in memory."""
    return min(metric.max_queries, max(1, _HELD_ROWS // top_k))


def scanned_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of what the plan's leaves read."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(n).stats().sizeInBytes()) for n in range(leaves.size()))


def _tasks(base: DataFrame) -> int:
    """About how many tasks read the base: input splits, or shuffle partitions after a join."""
    splits = math.ceil(min(scanned_bytes(base), _UNKNOWN_BYTES) / _SPLIT_BYTES)
    return max(splits, _shuffle_tasks(base))


def _shuffle_tasks(base: DataFrame) -> int:
    return int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _shards(base: DataFrame, top_k: int, limits: SearchLimits) -> int:
    """How many first-round groups the winners of one query need."""
    tasks = _tasks(base)
    return 1 if tasks * top_k <= limits.merge_rows else math.ceil(math.sqrt(tasks))


def _hit_schema(queries: DataFrame) -> str:
    kind = dict(queries.dtypes)["query_id"]
    return f"query_id {kind}, id string, distance double, place int, shard int"


def _by_broadcast(base, queries, shipped, metric, top_k, digits, shards, stride: int = 1, most: np.ndarray | None = None) -> DataFrame:
    """The best rows of every task, or of every ``stride``-th; the others do not read their split."""
    spark = base.sparkSession
    probing = "cells" in shipped.column_names
    load = spark.sparkContext.broadcast(
        {
            "ids": shipped["query_id"].combine_chunks(),
            "vectors": to_matrix(shipped["query_vector"]),
            "cells": shipped["cells"].to_pylist() if probing else None,
            "most": most,
        }
    )

    def scan(batches):
        sent = load.value
        ids = sent["ids"]
        if not len(ids) or TaskContext.get().partitionId() % stride:
            return
        best = TopK(metric.bind(sent["vectors"]), len(ids), top_k, digits)
        if sent["most"] is not None:
            best.within(sent["most"])
        everyone = np.arange(len(ids))
        probers = None if sent["cells"] is None else _probers(sent["cells"])
        for batch in batches:
            batch = _with_value(batch)
            if not batch.num_rows:
                continue
            rows = best.scorer.read(batch.column("value"))
            names = batch.column("id")
            if probers is None:
                best.offer(everyone, rows, TextIds(names))
                continue
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            order = np.argsort(cells, kind="stable")
            found, starts = np.unique(cells[order], return_index=True)
            for cell, part in zip(found, np.split(order, starts[1:])):
                picked = probers.get(int(cell))
                if picked is not None:
                    if hasattr(best.scorer, "enter"):
                        best.scorer.enter(int(cell), picked)
                    best.offer(picked, rows[part], TextIds(names.take(pa.array(part))))
        shard = TaskContext.get().partitionId() % shards
        yield from _hit_batches(best, ids, shard)

    return base.mapInArrow(scan, _hit_schema(queries))


def _by_small_base(small: pa.Table, queries: DataFrame, metric, top_k: int, digits: int | None) -> DataFrame:
    small = _with_value(small)
    sent = queries.sparkSession.sparkContext.broadcast(
        (small["id"].combine_chunks(), small["value"].combine_chunks())
    )
    step = _queries_per_task(metric, top_k)

    def answer(batches):
        names, values = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows if len(names) else 0, step):
                asked = batch.slice(start, step)
                scorer = metric.bind(to_matrix(asked.column("query_vector")))
                best = TopK(scorer, asked.num_rows, top_k, digits)
                best.offer(np.arange(asked.num_rows), scorer.read(values), TextIds(names))
                yield from _hit_batches(best, asked.column("query_id"), 0)

    found = queries.mapInArrow(answer, _hit_schema(queries))
    return found.select("query_id", F.col("place").alias("rank"), "id", "distance")


def broadcast_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after the rows were counted against a bound."""
    table = collect_bounded(df, max_rows)
    return df if table is None else F.broadcast(df.sparkSession.createDataFrame(table, df.schema))


def prune_cells(base: DataFrame, shipped: pa.Table) -> DataFrame:
    """Keep the probed cells only: a partition filter on a table laid out by cell.

    A short list is part of the plan; a longer one is joined, which prunes partitions as well.
    """
    cells = shipped["cells"].combine_chunks().flatten().unique()
    if len(cells) <= _PRUNE_CELLS:
        return base.filter(F.col("cell").isin(cells.to_pylist()))
    # The cells come from query sets within the broadcast bound.
    wanted = base.sparkSession.createDataFrame(pa.table({"cell": cells.cast(pa.int32())}))
    return base.join(F.broadcast(wanted), "cell", "left_semi")


def _probers(cells: list[list[int]]) -> dict[int, np.ndarray]:
    """Which queries probe each cell."""
    positions = np.repeat(np.arange(len(cells)), [len(row) for row in cells])
    flat = np.asarray([cell for row in cells for cell in row], np.int64)
    order = np.argsort(flat, kind="stable")
    found, starts = np.unique(flat[order], return_index=True)
    return {int(c): positions[part] for c, part in zip(found, np.split(order, starts[1:]))} if len(flat) else {}


def _by_blocks(base, queries, metric, top_k, digits, limits, shards) -> DataFrame:
    if "cells" in queries.columns:
        routed = queries.select("query_id", "query_vector", F.explode("cells").alias("cell"))
    else:
        base = base.withColumn("cell", F.lit(0))
        routed = queries.withColumn("cell", F.lit(0))
    query_rows = min(limits.block_rows, _queries_per_task(metric, top_k))
    # One row per cell; the number of cells is bounded where centroids are shipped.
    grid = F.broadcast(
        _parts(base, "base_parts", limits.block_rows).join(_parts(routed, "query_parts", query_rows), "cell")
    )
    left = (
        base.join(grid, "cell")
        .withColumn("base_part", _slot("id", "base_parts"))
        .withColumn("query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)))
        .select("cell", "base_part", "query_part", "id", "value")
    )
    right = (
        routed.join(grid, "cell")
        .withColumn("query_part", _slot("query_id", "query_parts"))
        .withColumn("base_part", F.explode(F.sequence(F.lit(0), F.col("base_parts") - 1)))
        .select("cell", "base_part", "query_part", "query_id", "query_vector")
    )
    keys = ["cell", "base_part", "query_part"]
    schema = _hit_schema(queries)
    kinds = pa.schema([("query_id", _arrow_kind(queries)), ("id", pa.string()), ("distance", pa.float64()), ("place", pa.int32()), ("shard", pa.int32())])

    def compare(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = _with_value(rows)
        if not rows.num_rows or not asked.num_rows:
            return kinds.empty_table()
        scorer = metric.bind(to_matrix(asked["query_vector"]))
        best = TopK(scorer, asked.num_rows, top_k, digits)
        if hasattr(scorer, "enter"):
            scorer.enter(key[0].as_py(), np.arange(asked.num_rows))
        best.offer(np.arange(asked.num_rows), scorer.read(rows["value"]), TextIds(rows["id"].combine_chunks()))
        shard = int(key[1].as_py()) % shards
        batches = list(_hit_batches(best, asked["query_id"].combine_chunks(), shard))
        return pa.Table.from_batches(batches).cast(kinds) if batches else kinds.empty_table()

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def _with_value(rows):
    values = rows.column("value")
    return rows.filter(pc.is_valid(values)) if values.null_count else rows


def _parts(df: DataFrame, name: str, rows: int) -> DataFrame:
    return df.groupBy("cell").agg(F.ceil(F.count("*") / rows).cast("int").alias(name))


def _slot(key: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(parts)).cast("int")


def _arrow_kind(queries: DataFrame) -> pa.DataType:
    return pa.string() if dict(queries.dtypes)["query_id"] == "string" else pa.int64()


def _hit_batches(best: TopK, query_ids: pa.Array, shard: int):
    positions, distances, ids = best.result()
    places = np.arange(len(positions)) - np.searchsorted(positions, positions, side="left") + 1
    for start in range(0, len(positions), _OUTPUT_ROWS):
        part = slice(start, start + _OUTPUT_ROWS)
        yield pa.RecordBatch.from_arrays(
            [
                query_ids.take(pa.array(positions[part], pa.int64())),
                pa.array(plain_ids(ids[part]), pa.binary()).cast(pa.string()),
                pa.array(distances[part], pa.float64()),
                pa.array(places[part], pa.int32()),
                pa.array(np.full(len(positions[part]), shard), pa.int32()),
            ],
            names=["query_id", "id", "distance", "place", "shard"],
        )
