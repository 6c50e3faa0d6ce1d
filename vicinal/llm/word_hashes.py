"""Hashes of words and of word windows, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from vicinal.llm.common import text_bytes

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: A random number for every byte, and those with ``A-Z`` like ``a-z``.
_EXACT = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(which: int, size: int) -> np.ndarray:
    known = _POWERS[which]
    while len(known) < size:
        step = pow((_BASE, _INVERSE)[which], len(known), 1 << 64)
        known = np.concatenate([known, known * np.uint64(step)])
    _POWERS[which] = known
    return known[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def blanks(data: np.ndarray) -> np.ndarray:
    """True at blanks and the bytes 9 to 13."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_places(inside: np.ndarray, rows: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the first word of each row (one more entry than rows).

    ``inside`` is true at the bytes of words; ``rows`` is where each row begins and the last one ends.
    No word goes across a place in ``cuts``.
    """
    first = np.zeros(len(inside) + 1, bool)
    first[rows] = True
    if cuts is not None:
        first[cuts] = True
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, exact_case: bool = False) -> np.ndarray:
    """A 64-bit hash of every word, the same wherever it stands; ``A-Z`` count as ``a-z`` unless told otherwise."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_EXACT if exact_case else _FOLDED)[data] * _powers(0, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers(1, len(data) + 1)[starts])


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = (found ^ words[k : k + count]) * _STEP
        found ^= found >> np.uint64(29)
    return mixed(found)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For every text the sorted distinct 63-bit hashes of its word shingles.

    A text with fewer words than ``size`` has its whole word sequence as one shingle; without words, none.
    """
    data, rows = text_bytes(texts)
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in range(len(texts)))
        return
    starts, ends, first = word_places(~blanks(data), rows)
    words = word_hashes(data, starts, ends)
    every = windows(words, size) >> np.uint64(1)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        elif b > a:
            yield windows(words[a:b], int(b - a)) >> np.uint64(1)
        else:
            yield np.zeros(0, np.uint64)


def set_hash(members: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = (int(mixed(members).sum(dtype=np.uint64)) + len(members) * _BASE) & _MASK
    value = int(mixed(np.array([total], np.uint64))[0])
    return value - (1 << 64) if value >> 63 else value
