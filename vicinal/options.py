"""Option values, their defaults and the checks every entry point shares."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

# The public contract's defaults and names.
METRICS = ("euclidean", "cosine", "dot_product")
QUERY_FIELDS = ("distance", "metadata", "vector", "contents")
ITEM_FIELDS = ("vector", "contents", "metadata")
DEFAULT_METRIC = "euclidean"
DEFAULT_TOP_K = 100
DEFAULT_QUERY_INCLUDE = ("distance", "metadata")
DEFAULT_GET_INCLUDE = ("vector", "contents", "metadata")
DEFAULT_BATCH_SIZE = 2048
DEFAULT_MAX_ITERS = 100
DEFAULT_TOLERANCE = 1e-6
DEFAULT_MAX_MEMORY = 0
KEY_BYTES = 32

# Our own choices where the contract leaves the value open.
TRAIN_THRESHOLD = 10_000
RETRAIN_MULTIPLIER = 2.0
TARGET_RECALL = 0.90
RERANK_FACTOR = 4
CALIBRATION_QUERIES = 256

# Sizes that decide between shipping one side to every task and shuffling both.
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 128 << 20
BLOCK_ROWS = 50_000
# Bytes of a partition of the compacted items, and how many partitions there are at most.
BUCKET_BYTES = 64 << 20
MAX_BUCKETS = 10_000

_NAME = re.compile(r"[A-Za-z0-9_-]+")


@dataclass(frozen=True)
class IVF:
    """Inverted lists that hold ids; vectors stay in the item table."""

    dimension: int | None = None
    index_type = "ivf"


@dataclass(frozen=True)
class IVFFlat:
    """Inverted lists that hold a copy of the exact vectors."""

    dimension: int | None = None
    index_type = "ivfflat"


@dataclass(frozen=True)
class IVFPQ:
    """Inverted lists that hold product-quantiser codes, of what vectors differ by from their list's centroid."""

    dimension: int | None
    pq_dim: int
    pq_bits: int
    residual: bool = True
    index_type = "ivfpq"


IndexConfig = IVF | IVFFlat | IVFPQ


def check_name(name: str) -> str:
    if not isinstance(name, str) or not _NAME.fullmatch(name):
        raise ValueError("index name needs letters, digits, '-' or '_'")
    return name


def check_key(key: bytes) -> bytes:
    if not isinstance(key, (bytes, bytearray)) or len(key) != KEY_BYTES:
        raise ValueError(f"index key must be exactly {KEY_BYTES} bytes")
    return bytes(key)


def check_metric(metric: str | None) -> str:
    metric = DEFAULT_METRIC if metric is None else metric
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    return metric


def check_top_k(top_k: int | None) -> int:
    top_k = DEFAULT_TOP_K if top_k is None else top_k
    return _positive("top_k", top_k)


def check_dimension(dimension: int | None) -> int | None:
    return None if dimension is None else _positive("dimension", dimension)


def check_probes(n_probes: int | None) -> int | None:
    return None if n_probes is None else _positive("n_probes", n_probes)


def check_pq(dimension: int | None, pq_dim: int, pq_bits: int) -> None:
    _positive("pq_dim", pq_dim)
    _positive("pq_bits", pq_bits)
    if pq_bits > 8:
        raise ValueError("pq_bits must lie between 1 and 8")
    if dimension is not None and dimension % pq_dim:
        raise ValueError(f"pq_dim {pq_dim} does not divide dimension {dimension}")


def check_config(config: IndexConfig | None) -> IndexConfig:
    config = IVFFlat() if config is None else config
    if not isinstance(config, (IVF, IVFFlat, IVFPQ)):
        raise ValueError(f"unknown index configuration {config!r}")
    check_dimension(config.dimension)
    if isinstance(config, IVFPQ):
        check_pq(config.dimension, config.pq_dim, config.pq_bits)
    return config


def check_include(include: Iterable[str] | None, default: tuple, allowed: tuple) -> list[str]:
    chosen = list(default if include is None else include)
    unknown = [name for name in chosen if name not in allowed]
    if unknown:
        raise ValueError(f"unknown include field(s) {unknown}; allowed: {list(allowed)}")
    return list(dict.fromkeys(chosen))


def _positive(label: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{label} must be a positive integer, got {value!r}")
    return value
