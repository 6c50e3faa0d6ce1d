"""Proofs of the manifest beside a tree built in one place."""

import hashlib
import random

from pyspark.sql import functions as F

from vicinal.llm.merkle import folded, leaf_digest, merkle_manifest

ROWS = "doc_id bigint, source string, text string, root string, _g int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes, fanout):
    """The root of the nodes and, for each, the digests beside it level by level."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[n : n + fanout] for n in range(0, len(nodes), fanout)]
        for i, place in enumerate(at):
            run, own = runs[place // fanout], place % fanout
            sides[i].append(("".join(run[:own]), "".join(run[own + 1 :])))
        at = [place // fanout for place in at]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], sides


def brute_manifest(rows, fanout):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    groups = {}
    for doc_id, source, text, *_ in rows:
        groups.setdefault(source, []).append((doc_id, sha(field(doc_id) + field(source) + field(text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for s in order}
    tops = {s: climb([leaf for _, leaf in trees[s]], fanout) for s in order}
    root, above = climb([tops[s][0] for s in order], fanout)
    out = []
    for n, s in enumerate(order):
        for (doc_id, leaf), own in zip(trees[s], tops[s][1]):
            out.append((doc_id, s, leaf, tops[s][0], root, own + above[n]))
    return sorted(out, key=repr)


def manifest(spark, rows, fanout=16, parts=3):
    frame = spark.createDataFrame(rows, ROWS).repartition(parts)
    named = frame.withColumn("leaf", leaf_digest([F.col("doc_id"), F.col("source"), F.col("text")]))
    got = merkle_manifest(named, "source", ["doc_id"], "leaf", keep=["text"], fanout=fanout).withColumn("again", folded(F.col("leaf"), F.col("path"))).collect()
    assert all(r["again"] == r["root"] for r in got)
    return sorted([(r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in got], key=repr)


def row(doc_id, source, text="x"):
    return (doc_id, source, text, "clash", 1)


def test_manifest_matches_brute_force(spark):
    rng = random.Random(2)
    rows = [row(n, rng.choice(["a", "a", "a", "b", "é", None, ""]), rng.choice([None, "", "T é", "y" * 9])) for n in rng.sample(range(10**6), 400)]
    rows += [row(None, "a", f"t{n}") for n in range(20)] + [row(5, "lone"), row(None, "alone", None), *rows[:3], *rows[:2]]
    for fanout in (16, 2, 3):
        assert manifest(spark, rows, fanout) == brute_manifest(rows, fanout)


def test_small_and_odd_manifests(spark):
    cases = [[row(1, "a")], [row(1, None)], [row(n, "a") for n in range(16)], [row(n, "a") for n in range(17)], [row(1, c) for c in "abc"], [row(7, "a")] * 40, [row(n, f"s{n}") for n in range(40)]]
    for rows in cases:
        assert manifest(spark, rows) == brute_manifest(rows, 16)
    assert manifest(spark, []) == []


def test_wrong_leaf_misses_the_root(spark):
    rows = [row(n, "ab"[n % 2], f"Text {n}") for n in range(50)]
    named = spark.createDataFrame(rows, ROWS).withColumn("leaf", leaf_digest([F.col("doc_id"), F.col("text")]))
    given = leaf_digest([F.col("doc_id"), F.when(F.col("doc_id") == 7, "text 7").otherwise(F.col("text"))])
    proofs = merkle_manifest(named.withColumn("given", given), "source", ["doc_id"], "leaf", keep=["given"])
    bad = proofs.filter(folded(F.col("given"), F.col("path")) != F.col("root")).collect()
    assert [r["doc_id"] for r in bad] == [7]
