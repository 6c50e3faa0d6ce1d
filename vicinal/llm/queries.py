"""The queries of the operators over the sample tables, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.llm.common import documents
from vicinal.llm.decontamination import contaminated
from vicinal.llm.fingerprints import fingerprint_neighbours
from vicinal.llm.jaccard_join import jaccard_components
from vicinal.llm.language_id import identify
from vicinal.llm.line_dedup import dedup_lines
from vicinal.llm.merkle import folded, leaf_digest, merkle_manifest
from vicinal.llm.packing import pack
from vicinal.llm.periodic_runs import find_runs
from vicinal.llm.secrets import scan_secrets
from vicinal.llm.sharding import shard
from vicinal.llm.token_counts import count_tokens
from vicinal.llm.url_filters import LOWER, UPPER, judge_urls
from vicinal.llm.warc import read_back, write_archives

SHARDS = 16
TOKEN_LIMIT = 512
#: The rules of the url query.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), "doc_id", "text", size=3, num=90, den=100).drop("text_hash", "class_component")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(documents(spark, sf_dir), "doc_id", "text")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    placed = shard(docs, "doc_id", [1.0] * SHARDS, grown_by=1.0, keep=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), "doc_id", "text")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(documents(spark, sf_dir, "pages"), "page_id", "url", "html", RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = identify(documents(spark, sf_dir).select("doc_id", "text", "lang"), "doc_id", "text", "lang")
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir), "doc_id", "text")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), "doc_id", "text", documents(spark, sf_dir, "benchmark"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where the id's hash says so, all words from some place on repeat the first ones there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    marked = docs.select("doc_id", "text", h.alias("h")).select("*", F.floor(F.col("h") / 10).alias("g"))

    def periodic(w):
        n = F.size(w)
        a = (F.col("g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
        repeated = F.concat(F.slice(w, 1, a), F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))))
        return F.when(n > 0, F.array_join(F.slice(repeated, F.lit(1), n), " ")).otherwise("")

    # The words are bound once: a column of one list, changed as a whole.
    changed = F.transform(F.array(words), periodic)[0]
    return marked.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted_periods(documents(spark, sf_dir)), "doc_id", "text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    listed = found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return listed.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_back(spark, write_archives(documents(spark, sf_dir, "pages"), "page_id", "url", "html"), "bigint")
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", UPPER, LOWER)
    docs = documents(spark, sf_dir).select("*", leaf_digest([*fields, F.col("text")]).alias("leaf"))
    docs = docs.withColumn("given", F.when(changed & (lowered != F.col("text")), leaf_digest([*fields, lowered])).otherwise(F.col("leaf")))
    proofs = merkle_manifest(docs, "source", ["doc_id"], "leaf", keep=["given"])
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded(F.col("given"), F.col("path")).alias("folded_root"),
    ).select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    f.__name__: f for f in (
        op1_jaccard_join, op2_best_fit_packing, op3_fingerprints, op4_sharding, op5_line_dedup, op6_url_filters,
        op7_language_id, op8_token_counts, op9_secret_scans, op10_decontamination, op11_periodic_runs, op12_warc,
        op13_merkle_manifest,
    )
}
