"""Similarity join on word shingles: subsets for small sets, inverted lists for large ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import BITMAP_BITS, stored, text_slices
from vicinal.llm.components import connected_components
from vicinal.llm.word_hashes import set_hash, shingle_sets

#: A shingle that more sets than this have in their prefix is frequent and comes last in the common order.
FREQUENT = 50
#: At most so many frequent shingles are known to every task, the most frequent first.
MAX_FREQUENT = 1 << 20
#: A list of at most so many sets is compared pair by pair; a longer one around a pivot.
SHORT_LIST = 64
#: Entries of a list that are looked at in the time one row is shuffled.
ROW_COST = 8
#: Sets of one block; a long list is compared block by block.
BLOCK = 256
_TOP = np.uint64(1 << 63)


def _linked(common: Column, a: Column, b: Column, num: int, den: int) -> Column:
    return common * den >= (a + b - common) * num


def _in_order(members: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The set in the common order: frequent shingles, marked by the top bit, behind all others."""
    if not len(frequent) or not len(members):
        return members
    at = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
    marked = members | np.where(frequent[at] == members, _TOP, np.uint64(0))
    return np.sort(marked)


def _sketches(docs: DataFrame, size: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """``(_id, _text_hash, n, cid, prefix)``: set size, hash of the set, and the first shingles in the common order.

    The prefix has ``n - need(n) + 2`` shingles: two similar sets share at least two of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                n, cid, prefix = [], [], []
                for members in shingle_sets(part.column("_text"), size):
                    m = len(members)
                    n.append(m)
                    cid.append(set_hash(members) if m else None)
                    kept = min(m, m - (m * num + den - 1) // den + 2)
                    prefix.append(_in_order(members, shared.value)[:kept].view(np.int64))
                ends = np.cumsum([0] + [len(p) for p in prefix])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefix), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_text_hash"), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), lists],
                    ["_id", "_text_hash", "n", "cid", "prefix"],
                )

    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(run, f"_id {kind}, _text_hash bigint, n bigint, cid bigint, prefix array<bigint>")


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set: ``(cid, n, prefix, rep)`` with the least id that has it."""
    some = sketches.filter("n > 0").groupBy("cid").agg(F.min("_id").alias("rep"), F.first(F.struct("n", "prefix")).alias("s"))
    return some.select("cid", "s.n", "s.prefix", "rep")


def frequent_shingles(sketches: DataFrame) -> tuple[np.ndarray, float]:
    """The shingles in many prefixes, sorted, and the mean length of the list that a rarer one has."""
    classes = sketches.filter("n > 0").select("cid", "prefix").groupBy("cid").agg(F.first("prefix").alias("prefix"))
    counts = stored(classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c")), "shingles")
    rows = counts.filter(F.col("c") > FREQUENT).orderBy(F.desc("c"), "token").limit(MAX_FREQUENT).select("token").toPandas()
    rare = counts.filter(F.col("c") <= FREQUENT).agg(F.sum(F.col("c") * F.col("c")).alias("s"), F.sum("c").alias("n")).first()
    return np.sort(rows["token"].to_numpy(np.int64).view(np.uint64)), float(rare["s"] or 0) / max(1, rare["n"] or 1)


def size_boundary(list_length: float, num: int, den: int) -> int:
    """The set size from which scanning lists is cheaper than enumerating subsets.

    A set with a prefix of p shingles has p (p - 1) / 2 subsets of two, each a row of its own; scanning takes
    p - 1 rows and a look at the other sets of each list.
    """
    n = 1
    while True:
        p = n - (n * num + den - 1) // den + 2
        if ROW_COST * p * (p - 1) / 2 > (p - 1) * (ROW_COST + list_length):
            return n
        n += 1


def _postings(classes: DataFrame, boundary: int, num: int, den: int) -> DataFrame:
    """``(key, cid, n, hot)``: sets with the same key may be similar.

    Small sets give every subset of two shingles of their prefix; large ones, and small ones that a large
    one may resemble, every shingle but the last. A set without similar sets of other content gives none.
    """
    n = F.col("n")
    partners = classes.filter(F.floor(n * den / num) > n)
    lists = partners.filter(n * den >= boundary * num).select(
        F.explode(F.slice("prefix", F.lit(1), F.size("prefix") - 1)).alias("key"), "cid", "n"
    ).withColumn("hot", F.col("key") < 0)
    firsts = F.sequence(F.lit(1), F.size("prefix") - 1)
    both = F.flatten(F.transform(firsts, lambda i: F.transform(
        F.slice("prefix", i + 1, F.size("prefix")),
        lambda y: F.struct(F.xxhash64(F.get("prefix", i - 1), y).alias("key"), ((F.get("prefix", i - 1) < 0) & (y < 0)).alias("hot")),
    )))
    subsets = partners.filter((n < boundary) & (F.size("prefix") >= 2)).select(F.explode(both).alias("s"), "cid", "n")
    small = subsets.select(F.col("s.key").alias("key"), "cid", "n", F.col("s.hot").alias("hot"))
    return lists.select("key", "cid", "n", "hot").unionByName(small)


def _scan(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of every list, from rows sorted by key and drawn order; a long list gives pairs with its first set."""

    def pairs(run: list[np.ndarray]) -> np.ndarray:
        cid, n = run
        a, b = np.triu_indices(len(cid), 1)
        near = np.minimum(n[a], n[b]) * den >= np.maximum(n[a], n[b]) * num
        a, b = cid[a[near]], cid[b[near]]
        return np.stack([np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), np.int64)])

    def star(pivot: int, others: np.ndarray) -> np.ndarray:
        return np.stack([np.full(len(others), pivot), others, np.ones(len(others), np.int64)])

    def out(parts: list[np.ndarray]) -> pa.RecordBatch:
        a, b, kind = np.concatenate(parts, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(kind == 1)], ["a", "b", "long"])

    key, held, pivot, parts = None, [np.zeros(0, np.int64)] * 2, None, []
    for batch in batches:
        keys, cids, sizes = (batch.column(c).to_numpy() for c in ("key", "cid", "n"))
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)]):
            if end == start:
                continue
            if keys[start] != key:
                if pivot is None and len(held[0]) > 1:
                    parts.append(pairs(held))
                key, held, pivot = keys[start], [np.zeros(0, np.int64)] * 2, None
            if pivot is None:
                held = [np.concatenate([h, x[start:end]]) for h, x in zip(held, (cids, sizes))]
                if len(held[0]) > SHORT_LIST:
                    pivot = held[0][0]
                    parts.append(star(pivot, held[0]))
                    held = [np.zeros(0, np.int64)] * 2
            else:
                parts.append(star(pivot, cids[start:end]))
        if parts:
            yield out(parts)
            parts = []
    if pivot is None and len(held[0]) > 1:
        parts.append(pairs(held))
    if parts:
        yield out(parts)


def _bits(ids: DataFrame, key: str) -> np.ndarray:
    """A bit array of fixed size with a bit set for every key."""
    place = F.pmod(F.col(key), F.lit(BITMAP_BITS))
    words = (
        ids.select((place / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod({key}, {BITMAP_BITS}) & 63 AS int))").alias("word"))
        .groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    )
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    bits[words["at"].to_numpy()] = words["word"].to_numpy(np.int64).view(np.uint64)
    return bits


def _sets_of(docs: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """``(cid, members)`` of the sets that the bit array lets through, and a few more."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                cids, sets = [], []
                for members in shingle_sets(part.column("_text"), size):
                    if not len(members):
                        continue
                    cid = set_hash(members)
                    at = cid % BITMAP_BITS
                    if int(shared.value[at // 64]) >> (at & 63) & 1:
                        cids.append(cid)
                        sets.append(members.view(np.int64))
                if cids:
                    ends = np.cumsum([0] + [len(s) for s in sets])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), lists], ["cid", "members"])

    return docs.mapInArrow(run, "cid bigint, members array<bigint>").groupBy("cid").agg(F.first("members").alias("members"))


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share."""
    sizes = [len(s) for s in sets]
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[inverse] > 1
    matrix = np.zeros((len(sets), int((counts > 1).sum()) or 1), np.float32)
    matrix[row[shared], column[inverse[shared]]] = 1.0
    return np.rint(matrix @ matrix.T).astype(np.int64)


def _blocks(members: DataFrame) -> DataFrame:
    """Members of every group dealt over pairs of blocks: ``first <= second`` and the member's own ``block``."""
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("_size"))
    cut = members.join(sizes, "g").withColumn("_blocks", F.ceil(F.col("_size") / BLOCK).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return cut.select("*", other).select(
        "*", F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second")
    ).drop("_size", "_blocks", "_other")


def _compared(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the pairs that belong to this task, and what the pairs share."""
    common = _common([np.asarray(x, np.int64) for x in pdf["payload"]])
    block, first, second = pdf["block"].to_numpy(), pdf["first"].iloc[0], pdf["second"].iloc[0]
    a, b = np.triu_indices(len(pdf), 1)
    own = (np.minimum(block[a], block[b]) == first) & (np.maximum(block[a], block[b]) == second)
    return a[own], b[own], common[a[own], b[own]]


def _alive(members: DataFrame, num: int, den: int) -> DataFrame:
    """The members of long lists whose prefix leaves a similar member possible."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, common = _compared(pdf)
        n, p = pdf["n"].to_numpy(), pdf["payload"].map(len).to_numpy()
        most = common + np.maximum(n[a] - p[a], n[b] - p[b])
        most = np.minimum(most, np.minimum(n[a], n[b]))
        possible = most * den >= (n[a] + n[b] - most) * num
        some = np.unique(np.concatenate([a[possible], b[possible]]))
        return pdf.iloc[some][["g", "cid"]]

    found = _blocks(members).groupBy("g", "first", "second").applyInPandas(run, "g bigint, cid bigint")
    return found.distinct()


def _block_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of different components: enough of them to join all that are similar."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, common = _compared(pdf)
        n, component, cid = (pdf[c].to_numpy() for c in ("n", "component", "cid"))
        similar = (common * den >= (n[a] + n[b] - common) * num) & (component[a] != component[b])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for i, j in zip(a[similar], b[similar]):
            x, y = find(component[i]), find(component[j])
            if x != y:
                root[y] = x
                links.append((cid[i], cid[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return _blocks(members).groupBy("g", "first", "second").applyInPandas(run, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, id_col: str, text_col: str, size: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """``(id, n_shingles, component_id, text_hash, class_component)`` of every row.

    Two texts link if their sets of word shingles have ``den * intersection >= num * union``; a component is
    named by the least id in it. Equal sets are one class and are never paired. Lists of shingles that few
    sets share are compared in full; a long list links its members to a pivot, and only members that are
    still apart are compared, block by block, inside tasks. Every link between different components is
    found; only links that join no further components are left out.

    Words are runs without blanks, ``A-Z`` in lower case. Texts without words, null ones included, have no
    shingles and are their own component. Sets are compared by 63-bit hashes of their shingles. A row
    without id takes part, but names a component only if all of it has none. Repeated rows are equal sets.
    ``class_component`` tells components apart where ids do not (null or repeated): the least set hash of the component,
    null without shingles. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_text_hash"))
    frequent, list_length = frequent_shingles(stored(_sketches(rows, size, num, den, np.zeros(0, np.uint64)), "sketches"))
    sketches = stored(_sketches(rows, size, num, den, frequent), "sketches")
    classes = stored(_classes(sketches), "classes")
    postings = _postings(classes, size_boundary(list_length, num, den), num, den)

    drawn = F.xxhash64("cid")
    dealt = postings.filter("NOT hot").withColumn("_drawn", drawn).repartition("key").sortWithinPartitions("key", "_drawn")
    scanned = stored(
        dealt.select("key", "cid", "n").mapInArrow(lambda b: _scan(b, num, den), "a bigint, b bigint, long boolean").distinct(), "pairs"
    )
    hot = postings.filter("hot").select("key", "cid")
    pivots = hot.groupBy("key").agg(F.min(F.struct(drawn.alias("d"), F.col("cid"))).alias("p")).select("key", F.col("p.cid").alias("a"))
    stars = hot.join(pivots, "key").select("a", F.col("cid").alias("b"))
    stars = stored(stars.unionByName(scanned.filter("long").select("a", "b")).distinct(), "stars")

    # Pairs that their prefixes leave possible.
    pairs = scanned.filter("NOT long").select("a", "b").unionByName(
        stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    ).filter("a <> b").distinct()
    left = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    right = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
    most = F.least(
        F.size(F.array_intersect("pa", "pb")) + F.greatest(F.col("na") - F.size("pa"), F.col("nb") - F.size("pb")), "na", "nb"
    )
    possible = pairs.join(left, "a").join(right, "b").filter(_linked(most, F.col("na"), F.col("nb"), num, den))
    pairs = stored(possible.select("a", "b", "na", "nb"), "pairs")

    # Members of long lists that may have a partner there.
    members = stars.select(F.col("a").alias("g"), F.col("b").alias("cid")).join(
        classes.select("cid", "n", F.col("prefix").alias("payload")), "cid"
    )
    alive = stored(_alive(members.select("g", "cid", "n", "payload"), num, den), "alive")

    # The whole sets of all that is left.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).unionByName(alive.select("cid"))
    sets = stored(_sets_of(rows, size, _bits(wanted, "cid")), "sets")
    of_a, of_b = sets.select(F.col("cid").alias("a"), F.col("members").alias("ma")), sets.select(F.col("cid").alias("b"), F.col("members").alias("mb"))
    common = F.size(F.array_intersect("ma", "mb"))
    verified = pairs.join(of_a, "a").join(of_b, "b").filter(_linked(common, F.col("na"), F.col("nb"), num, den))
    links = stored(verified.select("a", "b"), "links")
    found = stored(connected_components(links), "components")

    apart = alive.join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    mixed_groups = apart.groupBy("g").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("g")
    rest = stored(apart.join(mixed_groups, "g"), "apart").join(classes.select("cid", "n"), "cid").join(
        sets.withColumnRenamed("members", "payload"), "cid"
    )
    more = _block_links(rest.select("g", "cid", "n", "component", "payload"), num, den)
    # A link between members joins their components.
    joined = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    final = connected_components(joined)

    named = classes.select("cid", "rep").join(final.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    names = named.join(least, "component").select("cid", "component_id", F.col("component").alias("class_component"))
    return sketches.join(names, "cid", "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"), F.col("_text_hash").alias("text_hash"),
        "class_component",
    )
