"""Items in files: JSON lines as the contract has them, and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.operators.items import ITEM_COLUMNS, ITEM_SCHEMA, as_items


def read_items_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One item object per line; an unknown field or a broken line fails the job."""
    known = F.array(*[F.lit(name) for name in ITEM_COLUMNS])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    unknown = F.array_except(F.json_object_keys("value"), known)
    fault = (
        F.when(F.try_parse_json("value").isNull() | unknown.isNull(), F.raise_error(F.lit("malformed item line")))
        .when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown item field "), unknown[0])))
    )
    checked = lines.select(F.coalesce(fault.cast("string"), F.col("value")).alias("value"))
    return checked.select(F.from_json("value", ITEM_SCHEMA).alias("item")).select("item.*")


def write_items_json(items: DataFrame, path: str) -> None:
    items.select(*[name for name in ITEM_COLUMNS if name in items.columns]).write.json(path)


def read_items_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return as_items(spark.read.parquet(*paths))
