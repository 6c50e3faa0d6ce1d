"""Distance between two vector columns, as Spark expressions.

These are for pairs that already sit in one row: re-ranking, evaluation, checks.
Scans over many queries use the block kernels in :mod:`vicinal.functions.blocks`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vicinal.options import check_metric


def _sum_of(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_sum_of(F.transform(as_doubles(a), lambda x: x * x)))


def distance(a: Column | str, b: Column | str, metric: str = "euclidean") -> Column:
    """Smaller is closer under every metric.

    ``euclidean`` is the root of the squared sum, ``cosine`` is 1 - cos with 1.0 for
    a zero vector, and ``dot_product`` is the negated inner product.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    metric = check_metric(metric)
    if metric == "euclidean":
        gaps = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
        return F.sqrt(_sum_of(gaps))
    if metric == "dot_product":
        return -dot(a, b)
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0.0, F.lit(1.0)).otherwise(1.0 - dot(a, b) / lengths)


def normalise(vector: Column) -> Column:
    """Scale to unit length; a zero vector stays as it is."""
    length = norm(vector)
    scaled = F.transform(as_doubles(vector), lambda x: x / length)
    return F.when(length == 0.0, as_doubles(vector)).otherwise(scaled)
