"""Quality checks: recall, thresholds, leaks of deleted ids, round trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERED_CAP = 100


def recall_per_query(truth: DataFrame, hits: DataFrame) -> DataFrame:
    """``(query_id, recall)``: the share of true neighbours that were found."""
    found = hits.select("query_id", "id").distinct().withColumn("found", F.lit(1.0))
    joined = truth.select("query_id", "id").join(found, ["query_id", "id"], "left")
    return joined.groupBy("query_id").agg(F.avg(F.coalesce("found", F.lit(0.0))).alias("recall"))


def recall_at_k(truth: DataFrame, hits: DataFrame) -> DataFrame:
    """Mean recall over the queries of ``truth``: ``(n_queries, recall)``.

    The job fails when ``hits`` holds a query that ``truth`` does not, or lacks one.
    """
    # One pair of small rows per query; the join below never sees the hits themselves.
    asked = hits.select("query_id").distinct().withColumn("in_hits", F.lit(True))
    both = recall_per_query(truth, hits).withColumn("in_truth", F.lit(True)).join(asked, "query_id", "full")
    odd = F.sum(F.when(F.col("in_hits").isNull() | F.col("in_truth").isNull(), 1).otherwise(0))
    totals = both.agg(F.count("*").alias("n_queries"), F.avg("recall").alias("recall"), odd.alias("odd"))
    fault = F.raise_error(F.lit("truth and hits answer different queries")).cast("double")
    return totals.select("n_queries", F.when(F.col("odd") > 0, fault).otherwise(F.col("recall")).alias("recall"))


def recall_filtered(
    queries: DataFrame,
    truth: DataFrame,
    hits: DataFrame,
    cap: int = FILTERED_CAP,
    keys: Sequence[str] = ("query_id",),
) -> DataFrame:
    """Recall of filtered searches, averaged over ``query_id`` within the other keys.

    A null or '-1' id in ``truth`` stands for no neighbour. Nothing expected and nothing
    returned counts as 1; hits without an expectation count as 0; the expectation is
    capped at ``cap``, and more than ``cap`` hits for one query fail the job. Keys beside
    ``query_id``, such as ``filter_id``, stay as groups.
    """
    keys = list(keys)
    real = F.col("id").isNotNull() & (F.col("id") != "-1")
    wanted = truth.filter(real).select(*keys, "id").withColumn("wanted", F.lit(1))
    given = hits.select(*keys, "id").withColumn("given", F.lit(1))
    pairs = wanted.join(given, [*keys, "id"], "full")
    sums = pairs.groupBy(*keys).agg(
        F.count("wanted").alias("expected"),
        F.count("given").alias("returned"),
        F.sum(F.when(F.col("wanted").isNotNull() & F.col("given").isNotNull(), 1).otherwise(0)).alias("shared"),
    )
    zero = F.lit(0)
    per_query = queries.select(*keys).join(sums, keys, "left").select(
        *keys,
        F.coalesce("expected", zero).alias("expected"),
        F.coalesce("returned", zero).alias("returned"),
        F.coalesce("shared", zero).alias("shared"),
    )
    fault = F.raise_error(F.concat(F.lit(f"more than {cap} hits for one query: "), F.col("returned"))).cast("double")
    recall = (
        F.when(F.col("returned") > cap, fault)
        .when((F.col("expected") == 0) & (F.col("returned") == 0), F.lit(1.0))
        .when(F.col("expected") == 0, F.lit(0.0))
        .otherwise(F.col("shared") / F.least(F.col("expected"), F.lit(cap)))
    )
    groups = [key for key in keys if key != "query_id"]
    return per_query.withColumn("recall", recall).groupBy(*groups).agg(
        F.count("*").alias("n_queries"), F.avg("recall").alias("recall")
    )


def recall_failures(recalls: DataFrame, thresholds: DataFrame, factor: float = 1.0, key: str = "filter_id") -> DataFrame:
    """Rows whose recall, in percent, lies below ``threshold * factor``."""
    judged = recalls.join(thresholds, key).select(
        key, (F.col("recall") * 100).alias("recall_percent"), (F.col("threshold") * factor).alias("floor")
    )
    return judged.filter(F.col("recall_percent") < F.col("floor"))


def leak_check(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """How many rows of a listing, fetch or search carry a deleted id."""
    leaked = rows.select("id").join(deleted.select("id").distinct(), "id", "left_semi")
    return leaked.agg(F.count("*").alias("n_leaks"))


def roundtrip_diff(before: DataFrame, after: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Ids whose vector, contents or metadata did not survive, or that are missing.

    Vectors may differ by ``tolerance`` per component; metadata are compared as
    canonical JSON, whatever the order of their keys.
    """

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(
            "id",
            F.struct(
                F.col("vector").cast("array<double>").alias("vector"),
                F.col("contents"),
                F.to_json("metadata").alias("metadata"),
            ).alias(mark),
        )

    both = side(before, "a").join(side(after, "b"), "id", "full")
    a, b = F.col("a"), F.col("b")
    far = F.exists(F.zip_with(a["vector"], b["vector"], lambda x, y: F.abs(x - y) > tolerance), lambda t: t)
    same_vector = F.when(a["vector"].isNull() | b["vector"].isNull(), a["vector"].isNull() & b["vector"].isNull())
    same_vector = same_vector.otherwise((F.size(a["vector"]) == F.size(b["vector"])) & ~F.coalesce(far, F.lit(True)))
    reason = (
        F.when(a.isNull(), "added")
        .when(b.isNull(), "missing")
        .when(~same_vector, "vector")
        .when(~a["contents"].eqNullSafe(b["contents"]), "contents")
        .when(~a["metadata"].eqNullSafe(b["metadata"]), "metadata")
    )
    return both.select("id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def id_prefix_count(items: DataFrame, prefix: str) -> DataFrame:
    return items.agg(F.count_if(F.col("id").startswith(prefix)).alias("n_items"))
