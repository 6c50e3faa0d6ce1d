"""The plan of the packing against best-fit-decreasing, piece by piece."""

import time

import numpy as np
import public_tokenizers
import pytest

from vicinal.llm.packing import best_filling, best_fit, fillings_around, least_sequences, pack, plan_sequences


def piece_by_piece(counts, capacity):
    rooms = []
    for n in sorted((n for n, k in enumerate(counts) for _ in range(k)), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - n)
    return len(rooms)


def planned(counts, capacity):
    """The number of sequences, after all pieces have been found in them once."""
    plan = plan_sequences(counts, capacity)
    filled = {}
    for n, first, last, sequence, _, k in plan.tolist():
        for at in range((last - first) // k):
            filled[sequence + at] = filled.get(sequence + at, 0) + n * k
    pieces = np.zeros(len(counts), np.int64)
    np.add.at(pieces, plan[:, 0], plan[:, 2] - plan[:, 1])
    assert (pieces == counts).all() and max(filled.values()) <= capacity
    return len(filled)


def as_counts(sizes, capacity=2048):
    counts = np.zeros(capacity + 1, np.int64)
    for n, k in sizes.items():
        counts[n] += k
    return counts


@pytest.mark.parametrize("sizes, best_fit_uses", [({709: 392, 879: 19, 188: 201, 209: 114, 214: 214, 162: 70}, 206), ({167: 144, 185: 155, 684: 172}, None)])
def test_few_lengths_in_large_groups(sizes, best_fit_uses):
    counts = as_counts(sizes)
    fit = piece_by_piece(counts.tolist(), 2048)
    assert best_fit_uses in (None, fit) and sum(c for _, c in best_fit(counts, 2048)) == fit
    assert least_sequences(counts, 2048) <= planned(counts, 2048) <= fit


def test_no_plan_is_longer_than_best_fit():
    rng = np.random.default_rng(8)
    for _ in range(60):
        sizes = {int(n): int(rng.integers(1, 60)) for n in rng.integers(20, 256, rng.integers(3, 7))}
        counts = as_counts(sizes, 256)
        fit = piece_by_piece(counts.tolist(), 256)
        assert sum(c for _, c in best_fit(counts, 256)) == fit and planned(counts, 256) <= fit


@pytest.mark.parametrize("sizes", [{1: 5000}, {2: 1500}, {1: 100, 2: 1500}, {1: 3, 2048: 2}, {}, {2048: 5}])
def test_fillings_of_a_thousand_pieces(sizes):
    counts = as_counts(sizes)
    assert planned(counts, 2048) == least_sequences(counts, 2048) if sizes else not len(plan_sequences(counts, 2048))


def test_filling_leaves_the_least():
    rng = np.random.default_rng(3)
    for _ in range(200):
        counts = np.zeros(61, np.int64)
        np.add.at(counts, rng.integers(3, 50, 6), rng.integers(1, 3, 6))
        gap = int(rng.integers(0, 60))
        pieces = [n for n, k in enumerate(counts) for _ in range(k)]
        sums = {0}
        for n in pieces:
            sums |= {s + n for s in sums if s + n <= gap}
        filling = best_filling(gap, counts)
        assert sum(filling) == max(sums) and all(filling.count(n) <= counts[n] for n in filling)


def test_alternatives_are_not_dominated():
    """No left piece fits in place of some pieces of a filling without being shorter than them."""
    counts = as_counts({60: 2, 25: 2, 20: 3, 15: 2, 7: 3}, 100)
    fillings, _ = fillings_around(60, counts, 100, 100)
    assert fillings and all(f[0] == 60 and sum(f) <= 100 for f in fillings)
    for filling in fillings:
        rest, beside = 100 - sum(filling), filling[1:]
        for x in np.flatnonzero(counts).tolist():
            if (counts[x] - (x == 60)) > beside.count(x):
                for n in range(1 << len(beside)):
                    some = [p for i, p in enumerate(beside) if n >> i & 1]
                    assert not (some != [x] and x - rest <= sum(some) <= x)


def test_bound_against_all_plans():
    """Small cases, every plan tried."""
    def fewest(pieces, capacity):
        best = len(pieces)

        def put(n, rooms):
            nonlocal best
            if len(rooms) >= best and n < len(pieces):
                return
            if n == len(pieces):
                best = min(best, len(rooms))
                return
            for i in range(len(rooms)):
                if rooms[i] >= pieces[n]:
                    put(n + 1, [*rooms[:i], rooms[i] - pieces[n], *rooms[i + 1 :]])
            put(n + 1, [*rooms, capacity - pieces[n]])

        put(0, [])
        return best

    rng = np.random.default_rng(4)
    for _ in range(60):
        pieces = sorted(rng.integers(1, 21, 9).tolist(), reverse=True)
        counts = np.bincount(pieces, minlength=21)
        assert least_sequences(counts, 20) <= fewest(pieces, 20) <= planned(counts, 20)


def test_time_of_the_plan():
    rng = np.random.default_rng(1)
    lengths = rng.choice(np.arange(300, 2049), 598, replace=False)
    for counts in (np.bincount(rng.choice(lengths, 3000), minlength=2049), np.bincount(rng.integers(700, 2049, 20_000), minlength=2049)):
        start = time.process_time()
        uses = planned(counts, 2048)
        assert time.process_time() - start < 10 and uses <= sum(c for _, c in best_fit(counts, 2048))


def test_empty_texts(spark):
    rows = spark.createDataFrame([(n, "" if n % 2 else None) for n in range(5000)], "doc_id bigint, text string")
    got = pack(rows, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r["sequence_id"], r["offset"]) for r in got) == [(n // 2048, n % 2048) for n in range(5000)]
