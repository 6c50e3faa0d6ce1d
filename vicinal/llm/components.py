"""Connected components of a graph of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vicinal.llm.common import stored

#: Edges that one task joins or writes.
TASK_EDGES = 500_000


def _contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one task as stars: every node with the least node that it reaches through them."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = np.array([(x, find(x)) for x in root if find(x) != x], np.int64).reshape(-1, 2)
    yield pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})


def _with_state(edges: DataFrame, tasks: int) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, stored, with their number and a hash of all of them."""
    seen = Observation()
    counted = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash"))
    table = stored(counted.coalesce(tasks), "edges")
    return table, (seen.get["n"], seen.get["hash"])


def connected_components(edges: DataFrame, native: bool = False) -> DataFrame:
    """``(node, component)`` for every node of ``(a, b)`` edges; a component is named by its least node.

    Tasks first join the edges that they hold (not if ``native``, which uses DataFrame operations alone).
    Large-star and small-star steps then alternate until nothing changes: every node is linked to the least
    node it knows, which halves distances, and edges never grow in number. Each round is written to the
    shared folder. Loops are ignored; without edges the result is empty.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    now, state = _with_state(now.distinct(), 1 << 16)
    tasks = 1 + state[0] // TASK_EDGES
    if not native:
        now, state = _with_state(now.coalesce(tasks).mapInPandas(_contracted, "u bigint, v bigint"), tasks)
    while native or tasks > 1:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = state
        now, state = _with_state(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), tasks)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
