"""Nearest centroid by two levels: root vectors over groups of centroids, with an exact check.

A vector is compared with all roots, then with the centroids of the nearest root. By the triangle inequality no
centroid of another group is nearer than the distance to that root less the group's radius; only groups for which
that could still win are compared as well. So the answer is that of comparing with every centroid, at about
the root of their number for vectors that lie in clusters, and never at much more than all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from vicinal.functions.blocks import nearest_rows

#: With fewer centroids one product over all of them is faster.
LEAST_CENTROIDS = 512
_ROUNDS = 4
_ROWS = 4096


@dataclass(frozen=True)
class CentroidTree:
    matrix: np.ndarray
    roots: np.ndarray
    radius: np.ndarray
    members: tuple[np.ndarray, ...]


def _gaps(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", points, points)[None] - 2.0 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0.0))


def _home(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.concatenate([_gaps(rows[at : at + _ROWS], points).argmin(axis=1) for at in range(0, len(rows), _ROWS)])


def plant(matrix: np.ndarray, least: int = LEAST_CENTROIDS) -> CentroidTree | None:
    """A tree over the centroids, by a few rounds of k-means among them; None where there are few."""
    if len(matrix) < max(2, least):
        return None
    wanted = round(np.sqrt(len(matrix)))
    roots = matrix[np.random.default_rng(0).choice(len(matrix), wanted, replace=False)].copy()
    for _ in range(_ROUNDS):
        home = _home(matrix, roots)
        sums, counts = np.zeros_like(roots), np.bincount(home, minlength=wanted)
        np.add.at(sums, home, matrix)
        roots[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    home = _home(matrix, roots)
    order = np.argsort(home, kind="stable")
    members = np.split(order, np.searchsorted(home[order], np.arange(1, wanted)))
    used = [n for n, own in enumerate(members) if len(own)]
    radius = np.array([np.sqrt(np.square(matrix[members[n]] - roots[n]).sum(axis=1)).max() for n in used])
    return CentroidTree(matrix, roots[used], radius, tuple(members[n] for n in used))


def nearest_place(rows: np.ndarray, tree: CentroidTree, digits: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Per row the place of its nearest centroid (of equal ones the first), the distance, and the pairs compared."""
    best, place, pairs = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), len(rows) * len(tree.roots)
    margin = 0.0 if digits is None else 10.0**-digits

    def compare(at: np.ndarray, group: int) -> None:
        nonlocal pairs
        own = tree.members[group]
        pairs += len(at) * len(own)
        _, distances, found = nearest_rows(rows[at], tree.matrix[own], own, "euclidean", 1, digits)
        wins = (distances < best[at]) | ((distances == best[at]) & (found < place[at]))
        best[at[wins]], place[at[wins]] = distances[wins], found[wins]

    for start in range(0, len(rows), _ROWS):
        part = rows[start : start + _ROWS]
        gaps = _gaps(part, tree.roots)
        # The product's rounding error must not rule a group out.
        size = np.sqrt(np.einsum("ij,ij->i", part, part))[:, None] + np.sqrt(np.einsum("ij,ij->i", tree.roots, tree.roots))[None]
        low = gaps - tree.radius[None] - 1e-6 * size - margin
        home = gaps.argmin(axis=1)
        for group in np.unique(home).tolist():
            compare(start + np.flatnonzero(home == group), group)
        low[np.arange(len(part)), home] = np.inf
        for group in np.argsort(low.min(axis=0), kind="stable").tolist():
            left = np.flatnonzero(low[:, group] <= best[start : start + len(part)])
            if len(left):
                compare(start + left, group)
    return place, best, pairs
