"""What a task holds while it computes the distances of candidates."""

import tracemalloc

import numpy as np
import pytest

from vicinal.functions.blocks import VectorMetric


@pytest.mark.parametrize("metric", ["euclidean", "cosine", "dot_product"])
def test_pairs_are_computed_in_small_slices(metric):
    rng = np.random.default_rng(5)
    queries, rows = rng.normal(size=(256, 64)), rng.normal(size=(5000, 64))
    picked, at = rng.integers(0, 256, 150_000), rng.integers(0, 5000, 150_000)
    scorer = VectorMetric(metric).bind(queries)
    tracemalloc.start()
    try:
        got = scorer.pairs(picked, rows, at)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The result takes 1.2 MB; slices of 65,536 pairs took about 100 MB beside it.
    assert peak < 16 << 20
    # A distance does not depend on where its pair fell into a slice.
    one = [scorer.pairs(picked[n : n + 1], rows, at[n : n + 1])[0] for n in range(0, 150_000, 997)]
    assert got[::997].tolist() == one
