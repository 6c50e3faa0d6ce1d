"""Item and query tables derived from the sample tables' parquet files."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One sample table; its schema is read from the files once per session."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream; the pattern matches a single file and a directory."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parquet*")


def vector_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with their document as contents and its attributes as metadata.

    Documents and labels that do not exist leave their keys out.
    """
    vectors = table(spark, sf_dir, "embeddings")
    documents = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "vec_id")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "vec_id")
    joined = vectors.join(documents, "vec_id", "left").join(labels, "vec_id", "left")
    metadata = F.struct(
        "label",
        "lang",
        "source",
        "n_chars",
        (F.col("n_chars") / 1000).alias("score"),
        F.when(F.col("quality").isNotNull(), F.struct("quality", "toxic")).alias("doc"),
    )
    return joined.select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("vector"),
        F.col("text").alias("contents"),
        F.parse_json(F.to_json(metadata)).alias("metadata"),
    )


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label: ``(label, mean)``."""
    vectors = table(spark, sf_dir, "embeddings")
    return mean_by(vectors, "label")


def overall_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_by(table(spark, sf_dir, "embeddings").withColumn("label", F.lit(0)), "label")


def mean_by(vectors: DataFrame, key: str) -> DataFrame:
    parts = vectors.select(key, F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("parts"))
    return ordered.select(key, F.transform("parts", lambda p: p["x"]).alias("mean"))


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label, asking for what lies closest to the label's mean."""
    return label_means(spark, sf_dir).select(
        F.col("label").cast("bigint").alias("query_id"), F.col("mean").alias("query_vector")
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed centroids for coarse lists: the label means."""
    return label_means(spark, sf_dir).select(F.col("label").alias("cell"), F.col("mean").alias("centroid"))


def label_books(spark: SparkSession, sf_dir: str, pq_dim: int, width: int) -> DataFrame:
    """Seed codebooks: the slices of the label means."""
    means = label_means(spark, sf_dir)
    sub = F.explode(F.sequence(F.lit(0), F.lit(pq_dim - 1))).alias("sub")
    cut = means.select(F.col("label").alias("code"), "mean", sub)
    return cut.select("sub", "code", F.slice("mean", F.col("sub") * width + 1, F.lit(width)).alias("centroid"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change log over users: an 'error' deletes, anything else writes."""
    return event_changes(table(spark, sf_dir, "events"))


def event_changes(events: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.array(F.col("value").cast("float"), F.col("user_id").cast("float")).alias("vector"),
        F.col("event_type").alias("contents"),
        F.parse_json("props").alias("metadata"),
        op.alias("op"),
        F.col("event_id").alias("seq"),
        F.lit("").alias("uid"),
    )


def event_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as catalogue rows: one index per user, each event a new version of it."""
    events = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "click", "ivf").when(F.col("event_type") == "view", "ivfflat").otherwise("ivfpq")
    none = F.lit(None)
    return events.select(
        F.concat(F.lit("user-"), F.col("user_id")).alias("index_name"),
        F.col("event_id").alias("version"),
        F.lit("").alias("uid"),
        kind.alias("index_type"),
        (F.col("user_id") + 1).cast("int").alias("dimension"),
        F.when(F.col("value") > 20, "cosine").otherwise("euclidean").alias("metric"),
        none.cast("string").alias("embedding_model"),
        none.cast("int").alias("pq_dim"),
        none.cast("int").alias("pq_bits"),
        none.cast("int").alias("n_lists"),
        none.cast("int").alias("auto_n_probes"),
        (F.col("event_type") != "click").alias("is_trained"),
        F.floor("value").alias("trained_count"),
        (F.col("event_type") == "error").alias("dropped"),
    )
