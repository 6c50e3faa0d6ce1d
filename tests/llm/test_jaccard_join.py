"""Similarity join against a comparison of all pairs."""

import random

import numpy as np
import pytest

from vicinal.llm.components import connected_components
from vicinal.llm.jaccard_join import jaccard_components, size_boundary

WORDS = [f"w{n}" for n in range(400)]


def shingles(text, size):
    if text is None:
        return set()
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_force(rows, size, num, den):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        r = find(n)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(
        ((i, len(s), (least.get(find(n)) if s else i)) for n, ((i, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def answer(spark, rows, size, num, den):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = jaccard_components(docs, "doc_id", "text", size, num, den)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
def test_components_match_all_pairs(spark, size, num):
    rng = random.Random(size)
    rows, shared = [], " ".join(rng.choices(WORDS, k=25))
    for _ in range(25):
        base = rng.choices(WORDS, k=rng.randint(3, 120))
        for _ in range(rng.randint(1, 4)):
            rows.append(edited(rng, base, rng.randint(0, 3)))
    rows += [shared + " " + " ".join(rng.choices(WORDS, k=rng.randint(1, 60))) for _ in range(30)]
    rows += [None, "", " \n\t ", "one", "One", "two words", "TWO  words", "É a b c", "é a b c", "x y z", "x y z q"]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    assert answer(spark, rows, size, num, 100) == brute_force(rows, size, num, 100)


def test_a_large_group_of_near_copies_is_compared_in_full(spark):
    rng = random.Random(7)
    base = rng.choices(WORDS, k=150)
    rows = [edited(rng, base, rng.randint(0, 9)) for _ in range(320)]
    # Edits near the border of 90 %: many members link to some others alone.
    rows += [" ".join(base)] * 60
    rows = list(enumerate(rows))
    assert answer(spark, rows, 3, 90, 100) == brute_force(rows, 3, 90, 100)


def test_missing_and_repeated_ids_and_other_columns(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "q r s t"), (3, "q r s t"), (None, "only here now")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, n bigint, cid string")
    found = jaccard_components(docs, "doc_id", "text", 3, 90, 100)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)
    assert got == sorted([(None, 4, 3), (3, 4, 3), (3, 2, 3), (3, 2, 3), (None, 1, None)], key=repr)


def test_empty_table(spark):
    assert answer(spark, [], 3, 90, 100) == []


def test_size_boundary_weighs_rows_against_list_entries():
    assert size_boundary(0, 90, 100) < size_boundary(20, 90, 100) < size_boundary(50, 90, 100)


def test_connected_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(n, n + 1) for n in range(1000, 1080)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert found == {x: find(x) for a, b in edges if a != b for x in (a, b)}
