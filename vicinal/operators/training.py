"""When an index is trained, and when it is due again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinal.options import RETRAIN_MULTIPLIER, TRAIN_THRESHOLD


def needs_training(
    n_items: Column,
    trained_count: Column,
    threshold: int = TRAIN_THRESHOLD,
    multiplier: float = RETRAIN_MULTIPLIER,
) -> Column:
    """First training at ``threshold`` items, then whenever they grew by ``multiplier``."""
    first = F.coalesce(trained_count, F.lit(0)) == 0
    return F.when(first, n_items >= threshold).otherwise(n_items >= trained_count * multiplier)


def training_status(
    catalog: DataFrame, counts: DataFrame, threshold: int = TRAIN_THRESHOLD, multiplier: float = RETRAIN_MULTIPLIER
) -> DataFrame:
    """One row per index: trained or not, at which size, and whether training is due.

    ``catalog`` is ``(index_name, is_trained, trained_count)``, ``counts`` is
    ``(index_name, n_items)``.
    """
    joined = catalog.join(counts, "index_name", "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)))
    due = needs_training(F.col("n_items"), F.col("trained_count"), threshold, multiplier)
    return joined.select(
        "index_name",
        "is_trained",
        "trained_count",
        "n_items",
        F.lit(float(multiplier)).alias("retrain_threshold"),
        due.alias("needs_training"),
    )
