"""Numpy kernels that run inside tasks: one block of queries against one block of rows.

A block product gives a lower bound of every key. The bound only selects candidates;
their distances are then computed directly, pair by pair, so that results do not depend
on how rows fell into batches. Nothing but the best ``k`` rows of each
query leaves a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from vicinal.functions.vectors import to_matrix

# One product covers this many queries and rows, so that its temporaries stay in cache.
_BLOCK_QUERIES = 512
_BLOCK_ROWS = 256
_PAIR_ROWS = 1 << 12
# Candidates that are held before the first trim at most.
_HELD = 1 << 22
_UNIT = np.finfo(np.float64).eps


@dataclass(frozen=True)
class VectorMetric:
    """Distance between full vectors."""

    metric: str

    @property
    def max_queries(self) -> int:
        return 1 << 30

    def bind(self, queries: np.ndarray) -> "VectorScorer":
        return VectorScorer(self.metric, queries)


@dataclass(frozen=True)
class CodeMetric:
    """Distance between a full query vector and product-quantiser codes.

    ``books`` has shape (sub, code, width); a code that no sub-vector was given is NaN.
    """

    metric: str
    books: np.ndarray

    @property
    def max_queries(self) -> int:
        return max(1, (1 << 25) // (self.books.shape[0] * self.books.shape[1]))

    def bind(self, queries: np.ndarray) -> "CodeScorer":
        return CodeScorer(self.metric, self.books, queries)


class VectorScorer:
    """Keys that order rows as the distance does: its square under euclidean.

    A lower bound of every key comes out of one product. Its rounding error is at most
    ``scale`` times a sum (euclidean) or product (dot product) of the two lengths, which
    is linear in per-row and per-query terms and so rides along as extra columns.
    """

    def __init__(self, metric: str, queries: np.ndarray):
        self.metric = metric
        self.queries = queries
        self.scale = (2 * queries.shape[1] + 16) * _UNIT
        self.squares = np.einsum("ij,ij->i", queries, queries)
        self.norms = np.sqrt(self.squares)
        ones = np.ones((len(queries), 1))
        if metric == "euclidean":
            self.columns = np.hstack([-2.0 * queries, (1.0 - self.scale) * self.squares[:, None], ones])
        elif metric == "dot_product":
            self.columns = np.hstack([-queries, -self.scale * self.norms[:, None]])
        else:
            self.columns = np.hstack([-_unit(queries, self.norms), (1.0 - self.scale) * ones])

    def read(self, column: pa.Array) -> np.ndarray:
        rows = to_matrix(column)
        if len(rows) and rows.shape[1] != self.queries.shape[1]:
            raise ValueError(f"query dimension {self.queries.shape[1]} differs from {rows.shape[1]}")
        return rows

    def prepare(self, rows: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", rows, rows)
        ones = np.ones((len(rows), 1))
        if self.metric == "euclidean":
            return np.hstack([rows, ones, (1.0 - self.scale) * squares[:, None]])
        if self.metric == "dot_product":
            return np.hstack([rows, np.sqrt(squares)[:, None]])
        return np.hstack([_unit(rows, np.sqrt(squares)), ones])

    def lowest(self, picked: np.ndarray, prepared: np.ndarray) -> np.ndarray:
        """A lower bound of each key, (queries, rows)."""
        return self.columns[picked] @ prepared.T

    def spread(self, picked: np.ndarray, prepared: np.ndarray) -> np.ndarray:
        """How far a key may lie above its lower bound, per query."""
        if self.metric == "euclidean":
            return 2.0 * self.scale * (self.squares[picked] + 2.0 * prepared[:, -1].max())
        if self.metric == "dot_product":
            return 2.0 * self.scale * self.norms[picked] * prepared[:, -1].max()
        return np.full(len(picked), 2.0 * self.scale)

    def to_key(self, distances: np.ndarray) -> np.ndarray:
        return np.square(np.maximum(distances, 0.0)) if self.metric == "euclidean" else distances

    def from_key(self, keys: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(keys, 0.0)) if self.metric == "euclidean" else keys

    def pairs(self, picked: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distance of query ``picked[i]`` to row ``at[i]``."""
        result = np.empty(len(picked))
        for start in range(0, len(picked), _PAIR_ROWS):
            part = slice(start, start + _PAIR_ROWS)
            result[part] = self._pairs(picked[part], rows[at[part]])
        return result

    def _pairs(self, picked: np.ndarray, rows: np.ndarray) -> np.ndarray:
        queries = self.queries[picked]
        if self.metric == "euclidean":
            gaps = queries - rows
            return np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
        inner = np.einsum("ij,ij->i", queries, rows)
        if self.metric == "dot_product":
            return -inner
        lengths = self.norms[picked] * np.sqrt(np.einsum("ij,ij->i", rows, rows))
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(lengths > 0.0, 1.0 - inner / lengths, 1.0)


class CodeScorer:
    def __init__(self, metric: str, books: np.ndarray, queries: np.ndarray):
        subs, _, width = books.shape
        if queries.shape[1] != subs * width:
            raise ValueError(f"query dimension {queries.shape[1]} differs from {subs * width}")
        self.metric = metric
        if metric == "cosine":
            queries = _unit(queries, np.sqrt(np.einsum("ij,ij->i", queries, queries)))
        parts = queries.reshape(len(queries), subs, 1, width)
        if metric == "euclidean":
            table = np.square(parts - books[None]).sum(axis=3)
        else:
            table = -(parts * books[None]).sum(axis=3)
        self.table = np.where(np.isnan(table), np.inf, table)

    def read(self, column: pa.Array) -> np.ndarray:
        return to_matrix(column, np.int64)

    def prepare(self, rows: np.ndarray) -> np.ndarray:
        return rows

    def lowest(self, picked: np.ndarray, prepared: np.ndarray) -> np.ndarray:
        keys = np.zeros((len(picked), len(prepared)))
        for sub in range(prepared.shape[1]):
            keys += self.table[picked, sub][:, prepared[:, sub]]
        return keys

    def spread(self, picked: np.ndarray, prepared: np.ndarray) -> np.ndarray:
        return np.zeros(len(picked))

    def to_key(self, distances: np.ndarray) -> np.ndarray:
        if self.metric == "euclidean":
            return np.square(np.maximum(distances, 0.0))
        return distances - 1.0 if self.metric == "cosine" else distances

    def from_key(self, keys: np.ndarray) -> np.ndarray:
        if self.metric == "euclidean":
            return np.sqrt(np.maximum(keys, 0.0))
        return keys + 1.0 if self.metric == "cosine" else keys

    def pairs(self, picked: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(picked))
        for sub in range(rows.shape[1]):
            keys += self.table[picked, sub, rows[at, sub]]
        return self.from_key(keys)


@dataclass(frozen=True)
class ResidualMetric:
    """The same for codes of what a vector differs by from the centroid of its list.

    ``cells`` ascend; ``matrix`` has their centroids.
    """

    metric: str
    books: np.ndarray
    cells: np.ndarray
    matrix: np.ndarray

    @property
    def max_queries(self) -> int:
        return CodeMetric(self.metric, self.books).max_queries

    def bind(self, queries: np.ndarray) -> "ResidualScorer":
        return ResidualScorer(self, queries)


class ResidualScorer(CodeScorer):
    """Lookup tables for one list at a time: of the queries less its centroid, or of the queries and a sum for the list."""

    def __init__(self, known: ResidualMetric, queries: np.ndarray):
        subs, _, width = known.books.shape
        if queries.shape[1] != subs * width:
            raise ValueError(f"query dimension {queries.shape[1]} differs from {subs * width}")
        self.metric, self.known = known.metric, known
        self.queries = _unit(queries, np.sqrt(np.einsum("ij,ij->i", queries, queries))) if known.metric == "cosine" else queries
        self.at = np.zeros(len(queries), np.int64)
        self.entered: tuple | None = None

    def enter(self, cell: int, picked: np.ndarray) -> None:
        if self.entered is not None and self.entered[0] == cell and np.array_equal(self.entered[1], picked):
            return
        self.entered = (cell, picked)
        centroid = self.known.matrix[np.searchsorted(self.known.cells, cell)]
        own, books = self.queries[picked], self.known.books
        if self.metric == "euclidean":
            self.table, self.sums = CodeScorer("euclidean", books, own - centroid).table, np.zeros(len(own))
        else:
            self.table, self.sums = CodeScorer("dot_product", books, own).table, -(own @ centroid)
        self.at[picked] = np.arange(len(picked))

    def lowest(self, picked: np.ndarray, prepared: np.ndarray) -> np.ndarray:
        return super().lowest(self.at[picked], prepared) + self.sums[self.at[picked]][:, None]

    def pairs(self, picked: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        places = self.at[picked]
        keys = np.zeros(len(picked))
        for sub in range(rows.shape[1]):
            keys += self.table[places, sub, rows[at, sub]]
        return self.from_key(keys + self.sums[places])


def _unit(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.divide(rows, lengths[:, None], out=np.zeros_like(rows), where=lengths[:, None] > 0.0)


class TopK:
    """Running best ``k`` rows per query, ordered by (distance, id).

    With ``digits`` the distance is rounded before it is compared, so that distances
    equal to that many decimals tie and the id decides.
    """

    def __init__(self, scorer, n_queries: int, k: int, digits: int | None = None):
        self.scorer = scorer
        self.k = k
        self.digits = digits
        self.margin = 0.0 if digits is None else 10.0**-digits
        self.bound = np.full(n_queries, np.inf)
        self.most = None
        self.room = max(min(2 * n_queries * k, _HELD), 1 << 12)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_held = 0

    def within(self, most: np.ndarray) -> "TopK":
        """Keep rows up to a distance per query alone, of which at least ``k`` rows are known."""
        self.most = most
        self.bound = np.minimum(self.bound, most)
        return self

    def offer(self, picked: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        """Compare the picked queries with every row."""
        height = max(_BLOCK_ROWS, _BLOCK_QUERIES * _BLOCK_ROWS // max(1, len(picked)))
        for start in range(0, len(rows), height):
            part = slice(start, start + height)
            block, names = rows[part], ids[part]
            prepared = self.scorer.prepare(block)
            for first in range(0, len(picked), _BLOCK_QUERIES):
                self._offer(picked[first : first + _BLOCK_QUERIES], block, prepared, names)

    def _offer(self, picked: np.ndarray, rows: np.ndarray, prepared: np.ndarray, ids: np.ndarray) -> None:
        lowest = self.scorer.lowest(picked, prepared)
        cut = self._widened(self.bound[picked])
        close = lowest <= cut[:, None]
        if rows.shape[0] > self.k and np.count_nonzero(close) > 4 * self.k * len(picked):
            # At least k rows of this block lie no further away than this.
            kth = np.partition(lowest, self.k - 1, axis=1)[:, self.k - 1] + self.scorer.spread(picked, prepared)
            close = lowest <= np.minimum(cut, self._widened(self.scorer.from_key(kth)))[:, None]
        query_at, row_at = np.nonzero(close)
        if not len(query_at):
            return
        queries = picked[query_at]
        distances = self.scorer.pairs(queries, rows, row_at)
        if self.digits is not None:
            distances = np.round(distances, self.digits) + 0.0
        if self.most is not None:
            kept = distances <= self.most[queries]
            queries, distances, row_at = queries[kept], distances[kept], row_at[kept]
        self.held.append((queries, distances, ids[row_at]))
        self.n_held += len(queries)
        if self.n_held > self.room:
            self._trim()
            # Where the winners alone need more room, they get it.
            self.room = max(self.room, 2 * self.n_held)

    def _widened(self, distances: np.ndarray) -> np.ndarray:
        return self.scorer.to_key(distances + np.abs(distances) * 8 * _UNIT + self.margin)

    def _trim(self) -> None:
        queries, distances, ids = (np.concatenate(column) for column in zip(*self.held))
        order = np.lexsort((ids, distances, queries))
        queries, distances, ids = queries[order], distances[order], ids[order]
        place = np.arange(len(queries)) - np.searchsorted(queries, queries, side="left")
        kept = place < self.k
        full = place == self.k - 1
        self.bound[queries[full]] = np.minimum(self.bound[queries[full]], distances[full])
        self.held = [(queries[kept], distances[kept], ids[kept])]
        self.n_held = int(kept.sum())

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, distance, id) sorted by query, distance, id."""
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self._trim()
        return self.held[0]


class TextIds:
    """Ids left in Arrow until a row is a candidate, then UTF-8 bytes.

    Bytes sort as Spark sorts strings. Fixed-width bytes drop zeros at their end, so the bytes 0 and 1 are
    written as two bytes each, which keeps the order.
    """

    def __init__(self, column: pa.Array):
        self.column = column

    def __getitem__(self, at):
        if isinstance(at, slice):
            start, stop, _ = at.indices(len(self.column))
            return TextIds(self.column.slice(start, stop - start))
        chosen = self.column.take(pa.array(at, pa.int64())).cast(pa.binary())
        return np.asarray([_escaped(x) if b"\0" in x or b"\1" in x else x for x in chosen.to_pylist()], dtype=np.bytes_)


def _escaped(name: bytes) -> bytes:
    return name.replace(b"\1", b"\1\2").replace(b"\0", b"\1\1")


def plain_ids(names: np.ndarray) -> list[bytes]:
    """The ids as they came."""
    return [x.replace(b"\1\1", b"\0").replace(b"\1\2", b"\1") if b"\1" in x else x for x in names.tolist()]


def nearest_rows(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, metric: str, k: int, digits: int | None):
    """Best ``k`` of ``rows`` for every query vector."""
    scorer = VectorMetric(metric).bind(queries)
    best = TopK(scorer, len(queries), k, digits)
    best.offer(np.arange(len(queries)), rows, ids)
    return best.result()
