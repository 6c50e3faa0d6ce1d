"""Search over coarse lists: probing, greedy visits and probe calibration."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.functions.blocks import VectorMetric, nearest_rows
from vicinal.functions.vectors import to_matrix
from vicinal.operators.buckets import bucket_count, fetch, fetch_now
from vicinal.operators.clustering import Centroids, load_centroids
from vicinal.operators.knn import filter_items, finish_hits
from vicinal.operators.projection import hit_fields
from vicinal.operators.search import SearchLimits, few, prune_cells, search, ship
from vicinal.options import TARGET_RECALL, check_metric, check_probes, check_top_k


# Distances that are ranked at once while lists are visited in order.
_RANKED = 1 << 22
_FIRST_LISTS = 32


def visited_lists(rows: np.ndarray, known: Centroids, metric: str, enough: int, least: int, digits: int | None) -> list[np.ndarray]:
    """Per query the nearest lists until those before hold ``enough`` rows, ``least`` lists at any rate.

    Few nearest lists are looked up first, four times as many for the queries that these do not suffice. Queries
    go in slices, so that the memory does not grow with the number of lists.
    """
    places, total = np.arange(len(known.cells)), len(known.cells)
    visits: list = [[]] * len(rows)
    if not total:
        return visits
    todo, width = np.arange(len(rows)), min(total, max(least, _FIRST_LISTS))
    while len(todo):
        short = []
        step = max(1, _RANKED // width)
        for part in (todo[at : at + step] for at in range(0, len(todo), step)):
            # Places ascend with the cell number, so ties go to the smaller cell.
            _, _, found = nearest_rows(rows[part], known.matrix, places, metric, width, digits)
            ranked = found.reshape(len(part), width)
            held = np.cumsum(known.counts[ranked], axis=1)
            whole = (held[:, -1] >= enough) | (width == total)
            taken = (held - known.counts[ranked] < enough) | (np.arange(width) < least)
            for at in np.flatnonzero(whole).tolist():
                visits[part[at]] = known.cells[ranked[at][taken[at]]]
            short.append(part[~whole])
        todo, width = np.concatenate(short), min(total, 4 * width)
    return visits


def route(
    queries: DataFrame,
    centroids: Centroids,
    metric: str,
    n_probes: int | None = None,
    greedy_rows: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Add ``cells``, the lists each query visits, nearest first.

    With ``greedy_rows`` a query visits lists until those before hold that many rows, and ``n_probes`` lists
    at any rate if both are given; otherwise it visits the ``n_probes`` nearest.
    """
    limit = len(centroids.cells) if n_probes is None else min(n_probes, len(centroids.cells))
    sent = queries.sparkSession.sparkContext.broadcast(centroids)

    def visit(vectors: pa.Array) -> pa.Array:
        known = sent.value
        rows = to_matrix(vectors)
        enough, least = (0, limit) if greedy_rows is None else (greedy_rows, n_probes or 0)
        return pa.array(visited_lists(rows, known, metric, enough, min(least, len(known.cells)), digits), pa.list_(pa.int32()))

    visit.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    visits = F.arrow_udf(visit, T.ArrayType(T.IntegerType()))
    return queries.select("query_id", "query_vector", visits("query_vector").alias("cells"))


def probe(
    cells: DataFrame,
    centroids: DataFrame | Centroids,
    queries: DataFrame,
    top_k: int | None = None,
    n_probes: int | None = None,
    greedy: bool = False,
    metric: str | None = None,
    filters: dict | None = None,
    include: Iterable[str] | None = (),
    items: DataFrame | None = None,
    digits: int | None = None,
    limits: SearchLimits | None = None,
    prune: bool = True,
    matching: Centroids | None = None,
) -> DataFrame:
    """The ``top_k`` closest items among the probed lists.

    ``cells`` is ``(id, cell)``, or also carries ``vector`` and ``metadata``; what it
    lacks is read from ``items``. Greedy takes the place of ``n_probes``: lists are
    visited in centroid order until they hold ``top_k`` rows. ``prune=False`` suits cells
    that are computed in the same plan rather than stored. Probing every list, which
    is also what ``n_probes=None`` does, gives the exact answer. Where ``items`` are laid out by
    ``bucket``, the entries of the probed lists are counted, and few of them open their buckets alone.
    ``matching`` are the lists with the rows that satisfy the filter, of ``matching_lists``: ``n_probes`` of them are
    visited, and further ones until they hold as many matching rows as ``n_probes`` lists hold rows.
    """
    top_k, metric = check_top_k(top_k), check_metric(metric)
    fields = hit_fields(include)
    known = centroids if isinstance(centroids, Centroids) else load_centroids(centroids)
    needed = ["vector"] + (["metadata"] if filters else [])
    asked, shipped, limits = queries, None, limits or SearchLimits()
    if len(known.cells):
        asked = _routed(queries, known, metric, top_k, n_probes, greedy, matching, digits)
    base = cells
    if any(name not in cells.columns for name in needed):
        postings, small = cells.select("id", "cell"), False
        if bucket_count(items) and len(known.cells):
            shipped = ship(asked, VectorMetric(metric), top_k, limits)
            if shipped is not None:
                postings = prune_cells(postings, shipped)
                small = few(postings.count())
        known_items = filter_items(items, filters)
        base = fetch_now(known_items, postings, ["vector"]) if small else fetch(known_items, postings, ["vector"], False)
    elif filters:
        base = filter_items(cells, filters)
    hits, n_queries = search(base, asked, VectorMetric(metric), top_k, digits=digits, limits=limits, prune=prune, shipped=shipped)
    return finish_hits(hits, cells if items is None else items, fields, n_queries, top_k)


def _routed(queries, known: Centroids, metric: str, top_k: int, n_probes, greedy: bool, matching: Centroids | None, digits) -> DataFrame:
    if greedy:
        return route(queries, known if matching is None else matching, metric, None, top_k, digits)
    if matching is None or n_probes is None:
        return route(queries, known, metric, check_probes(n_probes), None, digits)
    return route(queries, matching, metric, check_probes(n_probes), rows_of_probes(known, n_probes), digits)


def rows_of_probes(known: Centroids, n_probes: int) -> int:
    """The rows that so many lists hold on average."""
    return int(np.ceil(known.counts.sum() * min(1.0, n_probes / max(1, len(known.cells)))))


def matching_lists(cells: DataFrame, known: Centroids, filters: dict, items: DataFrame | None = None) -> Centroids:
    """The lists that hold items which satisfy the filter, with how many of them.

    One aggregation under the filter; a row per list comes back, and there are no more lists than are shipped.
    """
    if "metadata" in cells.columns:
        chosen = filter_items(cells, filters).select("cell")
    else:
        chosen = cells.select("id", "cell").join(filter_items(items, filters).select("id"), "id", "left_semi")
    counts = dict(chosen.groupBy("cell").count().collect())
    number = np.array([counts.get(int(cell), 0) for cell in known.cells], np.int64)
    return Centroids(known.cells[number > 0], known.matrix[number > 0], number[number > 0])


def calibrate_probes(
    cells: DataFrame,
    centroids: DataFrame | Centroids,
    sample: DataFrame,
    top_k: int = 100,
    metric: str | None = None,
    target: float = TARGET_RECALL,
    items: DataFrame | None = None,
) -> int:
    """Smallest number of probes whose mean recall on ``sample`` reaches ``target``.

    A true neighbour is found with ``n`` probes exactly when its list is among the
    query's ``n`` nearest, so one exact search and one histogram of list ranks answer
    every ``n`` at once. ``cells`` is ``(id, cell)`` with the vectors in ``items``, or
    ``(id, vector, cell)``.
    """
    metric = check_metric(metric)
    known = centroids if isinstance(centroids, Centroids) else load_centroids(centroids)
    truth, n_queries = search(cells if items is None else items, sample, VectorMetric(metric), top_k)
    truth = truth.select("query_id", "id")
    small = n_queries is not None and few(n_queries * top_k)
    placed = cells.select("id", "cell").join(F.broadcast(truth) if small else truth, "id")
    found = placed.groupBy("query_id").agg(F.collect_list("cell").alias("truth_cells"))
    asked = sample.join(found, "query_id")
    ranks = asked.select("query_id", F.explode(_list_ranks(known, metric, sample)).alias("list_rank"))
    per_rank = ranks.groupBy("list_rank").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(len(known.cells), np.int64)
    for row in per_rank:
        counts[row["list_rank"]] = row["n"]
    if not counts.sum():
        return 1
    recall = np.cumsum(counts) / counts.sum()
    return int(np.argmax(recall >= target - 1e-12)) + 1


def _list_ranks(known: Centroids, metric: str, sample: DataFrame):
    sent = sample.sparkSession.sparkContext.broadcast(known)

    def ranks(vectors: pa.Array, truth: pa.Array) -> pa.Array:
        known = sent.value
        rows, size = to_matrix(vectors), len(known.cells)
        _, _, order = nearest_rows(rows, known.matrix, np.arange(size), metric, size, None)
        place = np.argsort(order.reshape(len(rows), size), axis=1)
        found = [p[np.searchsorted(known.cells, t)] for p, t in zip(place, truth.to_pylist())]
        return pa.array(found, pa.list_(pa.int32()))

    ranks.__annotations__ = {"vectors": pa.Array, "truth": pa.Array, "return": pa.Array}
    return F.arrow_udf(ranks, T.ArrayType(T.IntegerType()))("query_vector", "truth_cells")
