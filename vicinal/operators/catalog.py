"""The index catalogue as an append-only table: the latest version of a name wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.operators.items import latest


def latest_entries(catalog: DataFrame) -> DataFrame:
    """One row per living index; a ``dropped`` row ends the life of its name."""
    newest = latest(catalog, ["version", "uid"], key="index_name")
    return newest.filter(~F.col("dropped"))


def list_indexes(catalog: DataFrame) -> DataFrame:
    return latest_entries(catalog.select("index_name", "version", "uid", "dropped")).select("index_name")


def describe_index(catalog: DataFrame, name: str | None = None) -> DataFrame:
    """Name, type, trained flag and full configuration; all indexes without a name."""
    rows = catalog if name is None else catalog.filter(F.col("index_name") == name)
    chosen = ["index_name", "index_type", "is_trained", "dimension", "metric", "embedding_model"]
    chosen += ["pq_dim", "pq_bits", "n_lists", "auto_n_probes", "trained_count"]
    return latest_entries(rows).select(*chosen)
