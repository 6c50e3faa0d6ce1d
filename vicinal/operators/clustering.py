"""Coarse lists: centroids, assignment, the Lloyd step and training.

A centroid table is ``(cell, centroid, n)``. It is the one table that every task needs
whole, so its size is checked before it is shipped.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinal.functions.blocks import nearest_rows
from vicinal.functions.centroid_tree import CentroidTree, nearest_place, plant
from vicinal.functions.distance import normalise
from vicinal.functions.vectors import to_lists, to_matrix
from vicinal.operators.search import collect_bounded
from vicinal.options import (
    DEFAULT_BATCH_SIZE,
    DEFAULT_MAX_ITERS,
    DEFAULT_MAX_MEMORY,
    DEFAULT_TOLERANCE,
    check_metric,
)

MAX_LISTS = 1 << 18
_CENTROID_BYTES = 512 << 20
_DENSE_CELLS = 1 << 22
# Centroids that one task adds up.
_REDUCED_BYTES = 32 << 20
_SEED_SLOTS = 1 << 40
# Distinct vectors per list among which seeds are drawn, and how often.
SEED_ROWS, SEED_ROUNDS = 64, 3
_APART_STEPS = 2048


@dataclass(frozen=True)
class Centroids:
    """A centroid table held in memory, sorted by cell."""

    cells: np.ndarray
    matrix: np.ndarray
    counts: np.ndarray


def load_centroids(centroids: DataFrame) -> Centroids:
    sized = "n" in centroids.columns
    table = collect_bounded(centroids.select("cell", "centroid", *(["n"] if sized else [])), MAX_LISTS, _CENTROID_BYTES)
    if table is None:
        raise ValueError(f"more than {MAX_LISTS} centroids, or more than {_CENTROID_BYTES} bytes of them")
    table = table.sort_by("cell")
    counts = table["n"].to_numpy() if sized else np.zeros(table.num_rows, np.int64)
    return Centroids(table["cell"].to_numpy().astype(np.int64), to_matrix(table["centroid"]), counts)


def centroid_frame(spark: SparkSession, known: Centroids) -> DataFrame:
    table = pa.table(
        {
            "cell": pa.array(known.cells, pa.int32()),
            "centroid": to_lists(known.matrix, pa.float64()),
            "n": pa.array(known.counts, pa.int64()),
        }
    )
    return spark.createDataFrame(table)


def training_vector(vector: Column | str, metric: str) -> Column:
    """What is clustered: unit vectors under cosine, the vectors themselves otherwise."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return normalise(vector) if metric == "cosine" else vector


def nearest_cell(spark, vector: Column, centroids: Centroids, digits: int | None = None) -> Column:
    """The closest centroid's cell as a column expression, ties to the smaller cell."""
    sent = spark.sparkContext.broadcast((centroids, plant(centroids.matrix)))

    def assign(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.int32())
        known, tree = sent.value
        present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        cells = np.full(len(vectors), -1, np.int64)
        if len(present):
            rows = to_matrix(vectors.take(pa.array(present)))
            cells[present] = known.cells[_places(rows, known.matrix, tree, digits)]
        return pa.array(cells, pa.int32(), mask=cells < 0)

    assign.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(assign, T.IntegerType())(vector)


def _places(rows: np.ndarray, matrix: np.ndarray, tree: CentroidTree | None, digits: int | None) -> np.ndarray:
    """The place of the nearest centroid of every row; places ascend with the cell, so ties go to the smaller one."""
    if tree is not None:
        return nearest_place(rows, tree, digits)[0]
    at, _, found = nearest_rows(rows, matrix, np.arange(len(matrix)), "euclidean", 1, digits)
    places = np.zeros(len(rows), np.int64)
    places[at] = found
    return places


def assign_cells(
    items: DataFrame, centroids: DataFrame | Centroids, metric: str | None = None, digits: int | None = None
) -> DataFrame:
    """Add ``cell``, the nearest centroid of each vector. No shuffle; many centroids are searched through a tree."""
    known = centroids if isinstance(centroids, Centroids) else load_centroids(centroids)
    vector = training_vector("vector", check_metric(metric))
    return items.withColumn("cell", nearest_cell(items.sparkSession, vector, known, digits))


def partial_sums(
    vectors: DataFrame, books: list[tuple[np.ndarray, np.ndarray]], digits: int | None, block_rows: int | None = None
) -> DataFrame:
    """Per task ``(sub, cell, n, total)``: the sums that new centroids are made from.

    At most ``block_rows`` vectors are compared with the centroids at once. ``books`` has one ``(cells, matrix)`` pair per slice of the vector, the slices
    lying side by side: one pair for coarse lists, several for product quantisation.
    """
    sent = vectors.sparkSession.sparkContext.broadcast([(cells, matrix, plant(matrix)) for cells, matrix in books])
    dense = sum(matrix.size for _, matrix in books) <= _DENSE_CELLS

    def add(batches):
        books = sent.value
        held: list | None = None
        step = block_rows or 1 << 31
        for batch in (part.slice(at, step) for part in batches for at in range(0, part.num_rows, step)):
            rows = to_matrix(batch.column(0))
            sums, start = [], 0
            for cells, matrix, tree in books:
                part = np.ascontiguousarray(rows[:, start : start + matrix.shape[1]])
                start += matrix.shape[1]
                sums.append(_group_sums(part, _places(part, matrix, tree, digits), len(cells) if dense else None))
            if held is None:
                held = sums
            elif dense:
                held = [(p, n + m, t + u) for (p, n, t), (_, m, u) in zip(held, sums)]
            else:
                held = [_added(one, two) for one, two in zip(held, sums)]
        if held is not None:
            yield from _sum_batches(books, held)

    return vectors.mapInArrow(add, "sub int, cell int, n bigint, total array<double>")


def _group_sums(rows: np.ndarray, places: np.ndarray, size: int | None):
    if size is None:
        present, places = np.unique(places, return_inverse=True)
    else:
        present = np.arange(size)
    totals = np.zeros((len(present), rows.shape[1]))
    np.add.at(totals, places, rows)
    return present, np.bincount(places, minlength=len(present)), totals


def _added(one, two):
    """Sums over the cells that either side has."""
    present, places = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    counts, totals = np.zeros(len(present), np.int64), np.zeros((len(present), one[2].shape[1]))
    np.add.at(counts, places, np.concatenate([one[1], two[1]]))
    np.add.at(totals, places, np.concatenate([one[2], two[2]]))
    return present, counts, totals


def _sum_batches(books, sums):
    for sub, ((cells, _, _), (present, counts, totals)) in enumerate(zip(books, sums)):
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), sub), pa.int32()),
                    pa.array(cells[present[used]], pa.int32()),
                    pa.array(counts[used], pa.int64()),
                    to_lists(totals[used], pa.float64()),
                ],
                names=["sub", "cell", "n", "total"],
            )


def mean_vectors(sums: DataFrame, size: int) -> DataFrame:
    """Add up the per-task sums: ``(sub, cell, centroid, n)``. ``size`` is the number of values of all centroids.

    The sums of a cell meet in one task, which holds a running total of its cells alone, whatever the number of tasks
    that they come from.
    """

    def add(batches):
        held = None
        for batch in batches:
            keys = (batch.column("sub").to_numpy().astype(np.int64) << 32) | batch.column("cell").to_numpy()
            totals = to_matrix(batch.column("total"))
            first = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, totals.shape[1]))) if held is None else held
            held = _added(first, (keys, batch.column("n").to_numpy(), totals))
        if held is not None:
            keys, counts, totals = held
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys >> 32, pa.int32()),
                    pa.array(keys & 0xFFFFFFFF, pa.int32()),
                    to_lists(totals / counts[:, None], pa.float64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["sub", "cell", "centroid", "n"],
            )

    dealt = sums.repartition(max(1, math.ceil(8 * size / _REDUCED_BYTES)), "sub", "cell")
    return dealt.mapInArrow(add, "sub int, cell int, centroid array<double>, n bigint")


def _means(items: DataFrame, known: Centroids, metric: str | None, digits: int | None, block_rows: int | None = None) -> DataFrame:
    vectors = items.filter(F.col("vector").isNotNull())
    vectors = vectors.select(training_vector("vector", check_metric(metric)).alias("vector"))
    return mean_vectors(partial_sums(vectors, [(known.cells, known.matrix)], digits, block_rows), known.matrix.size).select("cell", "centroid", "n")


def lloyd_step(
    items: DataFrame, centroids: DataFrame | Centroids, metric: str | None = None, digits: int | None = None
) -> DataFrame:
    """One round of k-means: the mean of the vectors nearest to each centroid.

    Sums are built inside each task, so the shuffle carries centroids, not items. A
    cell that attracts nothing keeps its centroid with ``n`` 0.
    """
    known = centroids if isinstance(centroids, Centroids) else load_centroids(centroids)
    before = centroid_frame(items.sparkSession, known).select("cell", F.col("centroid").alias("before"))
    return before.join(_means(items, known, metric, digits), "cell", "left").select(
        "cell", F.coalesce("centroid", "before").alias("centroid"), F.coalesce("n", F.lit(0)).alias("n")
    )


def lloyd_round(
    items: DataFrame, known: Centroids, metric: str | None = None, digits: int | None = None, block_rows: int | None = None
) -> Centroids:
    """The same round for a caller that iterates; as many rows come back as went out."""
    means = _means(items, known, metric, digits, block_rows).toArrow()
    matrix, counts = known.matrix.copy(), np.zeros(len(known.cells), np.int64)
    if means.num_rows:
        place = np.searchsorted(known.cells, means["cell"].to_numpy())
        matrix[place] = to_matrix(means["centroid"])
        counts[place] = means["n"].to_numpy()
    return Centroids(known.cells, matrix, counts)


def mini_batch_round(
    vectors: DataFrame, known: Centroids, turn: int, slices: int, metric: str | None = None, block_rows: int | None = None
) -> Centroids:
    """A round over one hash slice of the vectors; ``counts`` says how many rows have moved each centroid so far.

    A centroid moves towards the mean of its rows in the slice by their share of all rows that it has seen, so
    it is at any time the mean of those rows under the centroids of their rounds.
    """
    own = vectors.filter(F.pmod(F.xxhash64("vector"), F.lit(slices)) == turn % slices)
    found = lloyd_round(own, known, metric, block_rows=block_rows)
    seen = known.counts + found.counts
    share = found.counts / np.maximum(seen, 1)
    return Centroids(known.cells, known.matrix + share[:, None] * (found.matrix - known.matrix), seen)


def most_lists(width: int) -> int:
    """Lists whose centroids every task can hold."""
    return max(1, min(MAX_LISTS, _CENTROID_BYTES // (8 * width)))


def auto_lists(n_items: int, width: int = 1) -> int:
    return min(most_lists(width), max(1, round(math.sqrt(n_items))))


def block_rows(batch_size: int | None, max_memory: int | None, n_lists: int) -> int:
    """Vectors compared at once: ``batch_size`` of them, fewer if their distances exceed ``max_memory`` MB."""
    rows = DEFAULT_BATCH_SIZE if batch_size is None else batch_size
    memory = DEFAULT_MAX_MEMORY if max_memory is None else max_memory
    if rows < 1 or memory < 0:
        raise ValueError("batch_size must be positive and max_memory not negative")
    return min(rows, max(1, (memory << 20) // (8 * n_lists))) if memory else rows


def measure(items: DataFrame) -> tuple[int, int]:
    """Number of items and their dimension; none is an error."""
    row = items.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not row["n"]:
        raise ValueError("an empty index cannot be trained")
    return row["n"], row["width"]


def first_vectors(vectors: DataFrame, groups: int, wanted: int, seed: int) -> pa.Table:
    """The first ``wanted`` distinct vectors of each group in an order drawn from their values.

    ``vectors`` has ``grp`` (0 up to ``groups``) and ``vector``. Equal vectors have equal draws, so copies
    never crowd out others. Draws above a threshold are left out before anything is shuffled; where that
    leaves a group short, a pass with a higher threshold follows. Returns ``(grp, draw, vector)`` in order.
    """
    # The two zeros are equal and must not be drawn apart.
    plain = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))
    drawn = vectors.select("grp", plain.alias("vector")).withColumn("draw", F.xxhash64(F.lit(seed), "vector").bitwiseAND(_SEED_SLOTS - 1))
    distinct = drawn.groupBy("grp").agg(F.approx_count_distinct("draw").alias("n"))
    least = distinct.agg(F.min("n")).first()[0] or 1
    share = min(1.0, 4.0 * wanted / least)
    while True:
        some = drawn.filter(F.col("draw") < math.ceil(share * _SEED_SLOTS)).dropDuplicates(["grp", "draw"])
        order = Window.partitionBy("grp").orderBy("draw")
        ranked = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
        found = ranked.select("grp", "draw", "vector").toArrow().sort_by([("grp", "ascending"), ("draw", "ascending")])
        if share >= 1.0 or found.num_rows == groups * wanted:
            return found
        share = min(1.0, 8 * share)


def spread_seeds(vectors: DataFrame, wanted: int, n_items: int, seed: int, rounds: int = SEED_ROUNDS) -> np.ndarray:
    """Up to ``wanted`` distinct vectors that lie apart, for k-means to start from.

    Oversampling in parallel: a quarter of them are the first in an order drawn from the values; each round then
    draws about ``wanted`` more, each with a chance in proportion to its squared distance from those drawn. At the end
    every candidate is weighted by the vectors nearest to it, and ``wanted`` of them are drawn one after another by
    weight and squared distance. Draws are made among ``SEED_ROWS * wanted`` distinct vectors, taken by a hash of
    their values; copies count once. The rounds of k-means that follow read all items.
    """
    spark = vectors.sparkSession
    plain = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))
    drawn = vectors.select(plain.alias("vector")).withColumn("draw", F.xxhash64(F.lit(seed), "vector").bitwiseAND(_SEED_SLOTS - 1))
    share = min(1.0, SEED_ROWS * wanted / max(1, n_items))
    sample = drawn.filter(F.col("draw") < math.ceil(share * _SEED_SLOTS)).dropDuplicates(["draw"]).persist()
    try:
        first = to_matrix(sample.orderBy("draw").limit(wanted).select("vector").toArrow()["vector"])
        if len(first) < wanted:
            # Few distinct vectors: where the hash left some out, all are asked for.
            rest = first_vectors(vectors.select(F.lit(0).alias("grp"), "vector"), 1, wanted, seed) if share < 1.0 else None
            return first if rest is None else to_matrix(rest["vector"])
        picked, cost = first[: max(1, wanted // 4)], None
        for turn in range(rounds + 1):
            far = _far_vectors(sample, picked, cost, wanted, seed + turn)
            told = far.groupBy("draw").agg(F.sum("cost").alias("cost"), F.first("vector").alias("vector")).toArrow()
            cost = float(np.nansum(told["cost"].to_numpy()))
            chosen = told.filter(pc.is_valid(told["vector"]))
            if chosen.num_rows:
                picked = np.concatenate([picked, to_matrix(chosen["vector"])])
            if not cost:
                break
        if len(picked) <= wanted:
            extra = first[max(1, wanted // 4):]
            return np.unique(np.concatenate([picked, extra[: wanted - len(picked)]]), axis=0)
        books = [(np.arange(len(picked)), picked)]
        counts = partial_sums(sample.select("vector"), books, None).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        weights = np.zeros(len(picked))
        weights[counts["cell"].to_numpy()] = counts["n"].to_numpy()
        return _apart(picked, weights, wanted, seed)
    finally:
        sample.unpersist()


def _far_vectors(sample: DataFrame, picked: np.ndarray, cost: float | None, wanted: int, seed: int) -> DataFrame:
    """Per task its sum of squared distances to the nearest picked vector (draw -1), and the vectors drawn by them."""
    sent = sample.sparkSession.sparkContext.broadcast(picked)

    def draw(batches):
        for batch in batches:
            rows = to_matrix(batch.column("vector"))
            if not len(rows):
                continue
            _, distances, _ = nearest_rows(rows, sent.value, np.arange(len(sent.value)), "euclidean", 1, None)
            squares = np.square(distances)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int64()), pa.array([float(squares.sum())]), pa.array([None], pa.list_(pa.float64()))], ["draw", "cost", "vector"]
            )
            if not cost:
                continue
            chosen = np.flatnonzero(_luck(batch.column("draw").to_numpy(), seed) < wanted * squares / cost)
            if len(chosen):
                names = pa.array(chosen)
                none = pa.nulls(len(chosen), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("draw").take(names), none, batch.column("vector").take(names)], ["draw", "cost", "vector"])

    return sample.select("draw", "vector").mapInArrow(draw, "draw bigint, cost double, vector array<double>")


def _luck(draws: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for every draw, another one for every seed."""
    mixed = draws.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _apart(candidates: np.ndarray, weights: np.ndarray, wanted: int, seed: int) -> np.ndarray:
    """``wanted`` of the candidates, drawn by weight times squared distance to the nearest one drawn before.

    Of a few that are drawn each time, the one that lowers the weighted sum of squares most is taken. Where many are
    wanted they are taken some at a time, so that the number of steps is bounded.
    """
    rng = np.random.default_rng(seed)
    step = max(1, wanted // _APART_STEPS)
    squares = np.square(candidates).sum(axis=1)
    nearest = np.full(len(candidates), np.inf)
    taken = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    new = np.array(taken)
    while len(taken) < wanted:
        nearest = np.minimum(nearest, _squares(candidates, squares, new).min(axis=1))
        nearest[taken] = 0.0
        chance = nearest * np.maximum(weights, 1e-3)
        size = min(step, wanted - len(taken), int(np.count_nonzero(chance)))
        if not size:
            break
        tries = min(int(np.count_nonzero(chance)), size if step > 1 else 2 + int(np.log(wanted)))
        new = rng.choice(len(candidates), size=tries, replace=False, p=chance / chance.sum())
        if step == 1:
            left = np.minimum(nearest[:, None], _squares(candidates, squares, new))
            new = new[[int(np.argmin(weights @ left))]]
        taken += new.tolist()
    return candidates[np.sort(taken)]


def _squares(rows: np.ndarray, squares: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return np.maximum(squares[:, None] + squares[chosen][None] - 2.0 * rows @ rows[chosen].T, 0.0)


def train_centroids(
    items: DataFrame,
    n_lists: int | None = None,
    max_iters: int | None = None,
    tolerance: float | None = None,
    max_memory: int | None = None,
    metric: str | None = None,
    seed: int = 42,
    shape: tuple[int, int] | None = None,
    batch_size: int | None = None,
    mini_batch: int | None = None,
) -> Centroids:
    """K-means over all item vectors; ``counts`` are those of the last round.

    Rounds start from distinct vectors that lie apart, see ``spread_seeds``; each is one job that shuffles
    sums of centroids. Fewer distinct vectors than lists give fewer lists. Training ends when no centroid moves
    by more than ``tolerance``, or after ``max_iters`` rounds. With ``mini_batch`` a round takes a hash slice of about so
    many rows, one slice after another, and training ends when a whole turn over the slices moves no centroid further.
    """
    metric = check_metric(metric)
    if mini_batch is not None and mini_batch < 1:
        raise ValueError("mini_batch must be positive")
    items = items.filter(F.col("vector").isNotNull())
    n_items, width = shape or measure(items)
    n_lists = min(n_lists or auto_lists(n_items, width), n_items)
    if n_lists > most_lists(width):
        raise ValueError(f"n_lists must not exceed {most_lists(width)} at dimension {width}")
    rows = block_rows(batch_size, max_memory, n_lists)
    # Decrypted and scaled once for all rounds; a lost part is computed again.
    vectors = items.select(training_vector("vector", metric).alias("vector")).persist()
    try:
        matrix = spread_seeds(vectors, n_lists, n_items, seed)
        known = Centroids(np.arange(len(matrix)), matrix, np.zeros(len(matrix), np.int64))
        slices = math.ceil(n_items / mini_batch) if mini_batch else 1
        before = known
        for turn in range(max(1, DEFAULT_MAX_ITERS if max_iters is None else max_iters)):
            known = lloyd_round(vectors, known, block_rows=rows) if slices == 1 else mini_batch_round(vectors, known, turn, slices, block_rows=rows)
            if turn % slices == slices - 1:
                shift = np.square(known.matrix - before.matrix).sum(axis=1).max()
                before = known
                if shift <= (DEFAULT_TOLERANCE if tolerance is None else tolerance) ** 2:
                    break
    finally:
        vectors.unpersist()
    if slices > 1 and known.counts.sum():
        # About the rows of each list, from all slices that were seen.
        known = Centroids(known.cells, known.matrix, np.round(known.counts * (n_items / known.counts.sum())).astype(np.int64))
    return known


def train_ivf(
    items: DataFrame,
    n_lists: int | None = None,
    max_iters: int | None = None,
    tolerance: float | None = None,
    max_memory: int | None = None,
    metric: str | None = None,
    seed: int = 42,
    shape: tuple[int, int] | None = None,
    batch_size: int | None = None,
    mini_batch: int | None = None,
) -> DataFrame:
    """Centroids ``(cell, centroid, n)`` by k-means over all item vectors, with the size of every list.

    ``batch_size`` and ``max_memory`` (MB) bound the vectors that a task compares at once, never the rows
    that are read. A caller that knows the number of items and their dimension passes them as ``shape``.
    ``mini_batch`` rows make up a round where given.
    """
    known = train_centroids(items, n_lists, max_iters, tolerance, max_memory, metric, seed, shape, batch_size, mini_batch)
    vectors = items.filter(F.col("vector").isNotNull()).select("vector")
    return with_counts(centroid_frame(items.sparkSession, known), assign_cells(vectors, known, metric))


def with_counts(centroids: DataFrame, assigned: DataFrame) -> DataFrame:
    sizes = assigned.groupBy("cell").agg(F.count("*").alias("n"))
    joined = centroids.select("cell", "centroid").join(sizes, "cell", "left")
    return joined.select("cell", "centroid", F.coalesce("n", F.lit(0)).alias("n"))
