"""A manifest of a table as a tree of hashes, with a proof for every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vicinal.llm.common import stored

#: Children of one node.
FANOUT = 16
#: The tree over the subtrees' roots; the keys of groups begin with another letter.
TOP = "top"
#: Levels of the upper tree are counted from here.
ABOVE = 1000
STEP = "array<struct<left:string,right:string>>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 bytes, ``:`` and the value, one after another."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The digest that a leaf and the siblings on its way give at the way's end."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]).cast("binary"), 256))


def _group_key(group: Column) -> Column:
    """Null first, then by UTF-8 bytes."""
    return F.when(group.isNull(), "g").otherwise(F.concat(F.lit("g:"), group.cast("string")))


def _node_id(level: Column | int, pos: Column, group: Column) -> Column:
    return F.concat_ws("#", level if isinstance(level, Column) else F.lit(level), pos, group)


def _placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, gapless from 0 in the group in the given order (null first), and the group's ``total``.

    Rows are dealt by ranges of group and order, so that a large group is many tasks; each range is counted
    and numbered alone. Rows that are equal are told apart by where they stand, which keeps their ranges small.
    """
    ranged = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_salt")
    cut = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_size"))
    every = Window.partitionBy(group)
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"), F.sum("_size").over(every).alias("total"))
    within = Window.partitionBy("_range", group).orderBy(*order, "_salt")
    numbered = cut.withColumn("_rank", F.row_number().over(within) - 1).join(starts, ["_range", group])
    return numbered.withColumn("pos", F.col("_start") + F.col("_rank")).drop("_start", "_rank", "_range", "_salt")


def _tree(nodes: DataFrame, fanout: int, first_level: int, label: str) -> tuple[DataFrame, DataFrame, int]:
    """``(runs, roots, height)`` of the trees over ``nodes(g, pos, total, id, digest)``.

    ``runs`` has a row per inner node: ``id, level`` and its ``children`` in order, with their ids and digests;
    ``roots`` has ``g, id, digest``. One group-by a level, each on a ``fanout``-th of the rows.
    """
    most = nodes.agg(F.max("total")).first()[0] or 0
    runs, roots, level = [], [nodes.filter("total = 1").select("g", "id", "digest")], first_level
    while most > 1:
        level += 1
        many = nodes.filter("total > 1").withColumn("up", F.floor(F.col("pos") / fanout))
        run = F.sort_array(F.collect_list(F.struct("pos", "id", "digest")))
        up = many.groupBy("g", "up").agg(run.alias("children"), F.first("total").alias("total"))
        digest = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), "").cast("binary"), 256)
        up = stored(up.select(
            "g", F.col("up").alias("pos"), F.ceil(F.col("total") / fanout).alias("total"), _node_id(level, F.col("up"), F.col("g")).alias("id"),
            digest.alias("digest"), F.lit(level).alias("level"), "children"), f"{label}-{level}")
        runs.append(up.select("id", "level", "children"))
        nodes = up.select("g", "pos", "total", "id", "digest")
        roots.append(nodes.filter("total = 1").select("g", "id", "digest"))
        most = -(-most // fanout)
    empty = nodes.limit(0).select("id", F.lit(0).alias("level"), F.array(F.struct("pos", "id", "digest")).alias("children"))
    return reduce(DataFrame.unionByName, runs, empty), reduce(DataFrame.unionByName, roots), len(runs)


def _steps(children: Column, at: Column) -> Column:
    """The siblings of the child at an index, to its left and right."""
    digests = F.transform(children, lambda c: c["digest"])
    left = F.array_join(F.slice(digests, F.lit(1), at), "")
    right = F.array_join(F.slice(digests, at + 2, F.size(digests)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _jumped(runs: DataFrame, roots: DataFrame, root_id: str, farthest: int) -> DataFrame:
    """``(id, path, subroot)`` of all inner nodes below the root, by pointer jumping.

    A node first holds its siblings and points to its parent. In each round it takes over the segment and the
    pointer of the node that it points to, which doubles its distance, until the pointer reaches the root. The
    subroot is met on the way.
    """
    down = runs.filter("level > 1").select(F.col("id").alias("up"), "children", F.posexplode("children").alias("at", "child"))
    edges = down.select(F.col("child.id").alias("id"), F.nullif("up", F.lit(root_id)).alias("up"), F.array(_steps(F.col("children"), F.col("at"))).alias("path"))
    subroots = roots.select("id", F.col("digest").alias("subroot"))
    hops = stored(edges.join(subroots, "id", "left"), "hops")
    for _ in range(max(0, farthest - 1).bit_length()):
        ahead = hops.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.col("subroot").alias("_subroot"))
        moved = hops.filter("up IS NOT NULL").join(ahead, "up").select(
            "id", F.col("_up").alias("up"), F.concat("path", "_path").alias("path"), F.coalesce("subroot", "_subroot").alias("subroot"))
        hops = stored(moved.unionByName(hops.filter("up IS NULL")), "hops")
    return hops.select("id", "path", "subroot")


def merkle_manifest(rows: DataFrame, group: str, order: list[str], leaf: str, keep: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """``(group, *order, leaf, *keep, subroot, root, path)`` for every row of ``rows``.

    The leaves of a group stand in the given order (null first), rows of one order by their leaf; every ``fanout``
    consecutive nodes become their parent, the last ones perhaps fewer, until one is left, the subroot (a lone leaf
    is its own). The subroots, by group (null first, then by UTF-8 bytes), give the root the same way. ``path`` has
    for each level the digests left and right of the row's node, as text; ``folded(leaf, path)`` is the root.

    Repeated rows are leaves of their own next to each other. An empty table gives an empty result. Columns that are
    not named are dropped. ``rows`` is read once. No task holds more than a range of the leaves or the children of
    one node; the driver learns the height and the root alone.
    """
    wanted = list(dict.fromkeys([group, *order, leaf, *keep]))
    table = stored(rows.select(_group_key(F.col(group)).alias("_g"), F.struct(*wanted).alias("_row")), "leaves")
    keys = table.select("_g", "_row", *[F.col(f"_row.{c}").alias(f"_o{n}") for n, c in enumerate([*order, leaf])])
    names = [c for c in keys.columns if c.startswith("_o")]
    placed = stored(_placed(keys, "_g", names).select(F.col("_g").alias("g"), "pos", "total", "_row"), "placed")
    first = F.when(F.col("total") == 1, _node_id(0, F.col("pos"), F.col("g")))
    runs, roots, low = _tree(placed.select("g", "pos", "total", first.alias("id"), F.col(f"_row.{leaf}").alias("digest")), fanout, 0, "level")

    roots = stored(roots, "subroots")
    tops = _placed(roots.select(F.lit(TOP).alias("t"), "g", "id", "digest"), "t", ["g"])
    above, ends, high = _tree(tops.select(F.col("t").alias("g"), "pos", "total", "id", "digest"), fanout, ABOVE, "top")
    end = ends.first()
    if end is None:
        shape = rows.select(*wanted).limit(0)
        return shape.select("*", F.lit("").alias("subroot"), F.lit("").alias("root"), F.lit(None).cast(STEP).alias("path"))
    ways = _jumped(runs.unionByName(above), roots, end["id"], max(high, low + high - 1))

    own = runs.filter("level = 1").select("id", "children")
    lone = placed.filter("total = 1").select(_node_id(0, F.col("pos"), F.col("g")).alias("id"), F.lit(None).cast(own.schema["children"].dataType).alias("children"))
    parents = own.unionByName(lone).join(ways, "id", "left")
    parent = F.when(F.col("total") == 1, _node_id(0, F.col("pos"), F.col("g"))).otherwise(_node_id(1, F.floor(F.col("pos") / fanout), F.col("g")))
    met = placed.withColumn("id", parent).join(parents, "id")
    step = F.array(_steps(F.col("children"), (F.col("pos") % fanout).cast("int")))
    path = F.concat(F.when(F.col("children").isNull(), F.array().cast(STEP)).otherwise(step), F.coalesce("path", F.array().cast(STEP)))
    root = F.lit(end["digest"])
    return met.select(*[F.col(f"_row.{c}").alias(c) for c in wanted], F.coalesce("subroot", root).alias("subroot"), root.alias("root"), path.alias("path"))
