"""The registered queries: every operator over the whole sample tables.

Queries are asked with vectors that are themselves derived from the tables, such as the
mean vector of each label, so that work grows with the tables and not with their square.
Distances are rounded to six decimals before they are ranked; ids break ties.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.functions.crypto import decrypt_columns, encrypt_columns, key_frame, unseal
from vicinal.functions.distance import distance
from vicinal.functions.embedding import embed_missing, embed_text
from vicinal.functions.filters import compile_filter
from vicinal.operators import evaluation
from vicinal.operators.catalog import describe_index, list_indexes
from vicinal.operators.clustering import (
    Centroids,
    assign_cells,
    centroid_frame,
    lloyd_round,
    lloyd_step,
    load_centroids,
    train_ivf,
    with_counts,
)
from vicinal.operators.items import (
    compact,
    count_items,
    current_state,
    delete_state,
    get_items,
    upsert_state,
    validate_items,
)
from vicinal.operators.items import list_ids as list_item_ids
from vicinal.operators.ivf import calibrate_probes, probe
from vicinal.operators.knn import filter_matches as matching_ids
from vicinal.operators.knn import knn_exact
from vicinal.operators.pq import decode_pq, encode_pq, load_books, pq_step, residuals, search_pq, train_pq
from vicinal.operators.search import SearchLimits, broadcast_small, settle
from vicinal.operators.training import training_status
from vicinal.options import IVF, IVFPQ, IVFFlat
from vicinal.plans.index import VectorStore
from vicinal.session import shared_dir
from vicinal.sources.index_store import LeaseLost, log_schema
from vicinal.sources.item_files import read_items_json, write_items_json
from vicinal.sources.sample_tables import (
    change_log,
    event_catalog,
    event_changes,
    label_books,
    label_centroids,
    label_queries,
    overall_mean,
    table,
    table_stream,
    vector_items,
)
from vicinal.streaming.ingest import query_stream, upsert_stream

DIGITS = 6
TOP_K = 10
PQ_DIM = 8
PQ_WIDTH = 8
KEY = bytes(range(32))
SOURCES = ["src1", "src2", "src5"]
#: Recall in percent that each filter of ``recall_thresholds`` is asked for.
RECALL_FLOORS = ((1, 95.0), (2, 90.0), (3, 100.0))


def _meta(path: str, kind: str):
    return F.try_variant_get("metadata", f"$.{path}", kind)


# Exact search


def knn_single_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = overall_mean(spark, sf_dir).select(F.col("label").cast("bigint").alias("query_id"), F.col("mean").alias("query_vector"))
    return knn_exact(vector_items(spark, sf_dir), one, TOP_K, digits=DIGITS)


def _knn(spark: SparkSession, sf_dir: str, metric: str = "euclidean", **options) -> DataFrame:
    return knn_exact(vector_items(spark, sf_dir), label_queries(spark, sf_dir), TOP_K, metric, digits=DIGITS, **options)


def knn_batch_euclidean(spark, sf_dir):
    return _knn(spark, sf_dir)


def knn_batch_cosine(spark, sf_dir):
    return _knn(spark, sf_dir, "cosine")


def knn_batch_dot(spark, sf_dir):
    return _knn(spark, sf_dir, "dot_product")


def knn_include_vector(spark, sf_dir):
    hits = _knn(spark, sf_dir, include=["distance", "vector"])
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return hits.select(
        "query_id", "rank", "id", "distance", F.size("vector").alias("width"), F.round(total, 4).alias("total")
    )


def knn_include_metadata(spark, sf_dir):
    hits = _knn(spark, sf_dir, include=["metadata", "contents"])
    return hits.select(
        "query_id", "rank", "id", _meta("label", "int").alias("label"), _meta("lang", "string").alias("lang"),
        F.md5("contents").alias("contents_md5"),
    )


def _knn_filtered(spark, sf_dir, filters: dict) -> DataFrame:
    hits = _knn(spark, sf_dir, filters=filters, include=["distance", "metadata"])
    return hits.select(
        "query_id", "rank", "id", "distance", _meta("label", "int").alias("label"), _meta("lang", "string").alias("lang")
    )


def knn_filter_eq(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"lang": "en"})


def knn_filter_eq_int(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"label": 0})


def knn_filter_gt(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"n_chars": {"$gt": 500}})


def knn_filter_in(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"source": {"$in": SOURCES}})


def knn_filter_and(spark, sf_dir):
    parts = [{"lang": "en"}, {"metadata.score": {"$gt": 0.8}}, {"source": {"$in": SOURCES}}]
    return _knn_filtered(spark, sf_dir, {"$and": parts})


def knn_filter_path(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"doc.quality": 1, "doc.toxic": 0})


def knn_filter_none_match(spark, sf_dir):
    return _knn_filtered(spark, sf_dir, {"lang": "xx"})


def filter_matches(spark, sf_dir):
    return matching_ids(vector_items(spark, sf_dir), {"lang": {"$in": ["en", "de"]}, "n_chars": {"$gt": 500}})


def filter_extensions(spark, sf_dir):
    filters = {
        "$or": [{"lang": {"$ne": "en"}}, {"n_chars": {"$gte": 1000, "$lte": 3000}}],
        "source": {"$nin": ["src0"]},
        "doc": {"$exists": True},
        "label": {"$not": {"$lt": 3}},
    }
    return matching_ids(vector_items(spark, sf_dir), filters)


def filter_json_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("metadata", F.parse_json("props"))
    chosen = events.filter(compile_filter({"k": {"$gt": 50}}))
    return chosen.select("event_id", _meta("k", "int").alias("k"))


def distance_metrics(spark, sf_dir):
    """Every vector against the mean of its own label, under each metric."""
    vectors = table(spark, sf_dir, "embeddings")
    means = broadcast_small(label_centroids(spark, sf_dir))
    joined = vectors.join(means, vectors["label"] == F.col("cell"))

    def rounded(metric):
        return F.round(distance("embedding", "centroid", metric), DIGITS)

    return joined.select(
        "vec_id",
        rounded("euclidean").alias("euclidean"),
        rounded("cosine").alias("cosine"),
        rounded("dot_product").alias("dot_product"),
    )


# Items


def _digest(items: DataFrame) -> DataFrame:
    return items.select(
        "id",
        F.md5("contents").alias("contents_md5"),
        F.when(F.col("vector").isNotNull(), F.size("vector")).alias("width"),
        _meta("toxic", "int").alias("toxic"),
    )


def _label_changes(spark, sf_dir) -> DataFrame:
    """Each labelled document replaces the item of its id by one without a vector."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit(None).cast("array<float>").alias("vector"),
        F.concat(F.lit("quality "), F.col("quality")).alias("contents"),
        F.parse_json(F.to_json(F.struct("toxic"))).alias("metadata"),
    )


def _toxic_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))


def upsert_insert_replace(spark, sf_dir):
    return _digest(upsert_state(vector_items(spark, sf_dir), _label_changes(spark, sf_dir)))


def upsert_idempotent(spark, sf_dir):
    changes = _label_changes(spark, sf_dir)
    return _digest(upsert_state(upsert_state(vector_items(spark, sf_dir), changes), changes))


def upsert_ordered(spark, sf_dir):
    """Many changes per id in one batch; the event number decides."""
    changes = change_log(spark, sf_dir).select("id", "vector", "contents", "metadata", "seq")
    state = upsert_state(vector_items(spark, sf_dir), changes, order_col="seq")
    return state.select("id", F.md5("contents").alias("contents_md5"), _meta("k", "int").alias("k"))


def delete_ids(spark, sf_dir):
    left = delete_state(vector_items(spark, sf_dir), _toxic_ids(spark, sf_dir))
    return left.select("id", _meta("label", "int").alias("label"))


def get_by_ids_ordered(spark, sf_dir):
    """Each event asks for the item of its user: repeated and unknown ids included."""
    asked = table(spark, sf_dir, "events").select(F.col("event_id").alias("ordinal"), F.col("user_id").cast("string").alias("id"))
    found = get_items(vector_items(spark, sf_dir), asked, ["metadata"])
    return found.select("ordinal", "id", _meta("label", "int").alias("label"), _meta("lang", "string").alias("lang"))


def list_ids(spark, sf_dir):
    return list_item_ids(compact(change_log(spark, sf_dir)))


def count_vectors(spark, sf_dir):
    return count_items(vector_items(spark, sf_dir))


def validate_event_items(spark, sf_dir):
    """Events as items, most kinds of them faulty; the rejected ones with the reason."""
    value = F.col("value").cast("float")
    nan = F.lit(float("nan")).cast("float")
    kind = F.col("event_type")
    vector = (
        F.when(kind == "view", F.array(value, value))
        .when(kind == "click", F.array(value))
        .when(kind == "purchase", F.array().cast("array<float>"))
        .when(kind == "signup", F.array(value, nan))
    )
    items = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), vector.alias("vector"))
    _, bad = validate_items(items, dimension=2)
    return bad.select("id", "reason")


def compact_log(spark, sf_dir):
    return _log_digest(compact(change_log(spark, sf_dir)))


def _log_digest(items: DataFrame) -> DataFrame:
    return items.select("id", "contents", _meta("k", "int").alias("k"), F.col("vector")[0].cast("double").alias("value"))


def compact_over_snapshot(spark, sf_dir):
    state = current_state(change_log(spark, sf_dir), vector_items(spark, sf_dir))
    return state.select("id", F.md5("contents").alias("contents_md5"), F.size("vector").alias("width"))


# Coarse lists


def _lists(spark, sf_dir, items: DataFrame):
    centroids = lloyd_round(items, load_centroids(label_centroids(spark, sf_dir)), digits=DIGITS)
    return centroids, assign_cells(items, centroids, digits=DIGITS)


def ivf_assign(spark, sf_dir):
    items = vector_items(spark, sf_dir).select("id", "vector")
    return assign_cells(items, label_centroids(spark, sf_dir), digits=DIGITS).select("id", "cell")


def ivf_centroids(spark, sf_dir):
    means = lloyd_step(vector_items(spark, sf_dir), label_centroids(spark, sf_dir), digits=DIGITS)
    return means.select("cell", "n", F.posexplode("centroid").alias("pos", "x")).withColumn("x", F.round("x", DIGITS))


def _probe(spark, sf_dir, top_k: int = TOP_K, **options) -> DataFrame:
    items = vector_items(spark, sf_dir)
    centroids, cells = _lists(spark, sf_dir, items)
    return probe(cells, _sized(centroids, cells) if options.get("greedy") else centroids,
                 label_queries(spark, sf_dir), top_k, digits=DIGITS, prune=False, **options)


def _sized(centroids: Centroids, cells: DataFrame) -> DataFrame:
    """Centroids with the sizes of the lists they lead."""
    return with_counts(centroid_frame(cells.sparkSession, centroids), cells)


def ivf_probe(spark, sf_dir):
    return _probe(spark, sf_dir, n_probes=3)


def ivf_full_probe(spark, sf_dir):
    return _probe(spark, sf_dir, n_probes=10)


def ivf_greedy(spark, sf_dir):
    return _probe(spark, sf_dir, top_k=60, greedy=True)


def ivf_filtered_probe(spark, sf_dir):
    return _probe(spark, sf_dir, n_probes=3, filters={"lang": "en", "n_chars": {"$gt": 500}})


def ivf_postings_probe(spark, sf_dir):
    """Lists that hold ids only; vectors and metadata come from the item table."""
    items = vector_items(spark, sf_dir)
    centroids, cells = _lists(spark, sf_dir, items)
    return probe(
        cells.select("id", "cell"), centroids, label_queries(spark, sf_dir), TOP_K, n_probes=3,
        filters={"lang": "en"}, items=items, digits=DIGITS, prune=False,
    )


def ivf_train(spark, sf_dir):
    """Training over all items: every item lies in its nearest list, none is lost, and calibrated probes suffice."""
    items = vector_items(spark, sf_dir)
    centroids = load_centroids(train_ivf(items, n_lists=16, max_iters=10))
    cells = assign_cells(items, centroids)
    values = F.array(*[distance("vector", F.lit(row.tolist()), "euclidean") for row in centroids.matrix])
    best = cells.select(values.alias("values"), F.col("cell")).select(F.array_min("values").alias("least"), F.get("values", "cell").alias("own"))
    wrong = best.agg(F.count("*").alias("n_items"), F.count_if(F.col("own") > F.col("least") + 1e-9).alias("wrong_cells"))
    queries = settle(label_queries(spark, sf_dir))
    n_probes = calibrate_probes(cells, centroids, queries, TOP_K)
    recall = evaluation.recall_at_k(knn_exact(items, queries, TOP_K), probe(cells, centroids, queries, TOP_K, n_probes, prune=False))
    enough = recall.select((F.col("recall") >= 0.9).alias("enough")).scalar()
    return wrong.select(
        F.lit(len(centroids.cells)).alias("n_lists"), "n_items", "wrong_cells",
        (F.col("n_items") - F.lit(int(centroids.counts.sum()))).alias("n_lost"), enough.alias("recall_reached"),
    )


def _spread(items: DataFrame, centroids: Centroids):
    """The mean squared distance of the vectors to their nearest centroid, as a one-row column."""
    values = F.array(*[distance("vector", F.lit(row.tolist()), "euclidean") for row in centroids.matrix])
    return items.select(F.array_min(values).alias("least")).agg(F.avg(F.col("least") * F.col("least")).alias("spread")).scalar()


def ivf_train_mini(spark, sf_dir):
    """Rounds over slices of 200 vectors: the lists are at most a tenth wider than those of rounds over all."""
    items = vector_items(spark, sf_dir).select("id", "vector")
    full = load_centroids(train_ivf(items, n_lists=8, max_iters=4))
    mini = load_centroids(train_ivf(items, n_lists=8, max_iters=12, mini_batch=200))
    within = _spread(items, mini) <= F.lit(1.1) * _spread(items, full)
    return items.agg(F.count(F.lit(1)).alias("n_items")).select("n_items", (F.col("n_items") - F.lit(int(mini.counts.sum()))).alias("n_lost"), within.alias("within"))


# Product quantisation


def pq_codebooks(spark, sf_dir):
    books = pq_step(vector_items(spark, sf_dir), label_books(spark, sf_dir, PQ_DIM, PQ_WIDTH), digits=DIGITS)
    flat = books.select("sub", "code", "n", F.posexplode("centroid").alias("pos", "x"))
    return flat.withColumn("x", F.round("x", DIGITS))


def _coded(spark, sf_dir, items: DataFrame):
    books = load_books(label_books(spark, sf_dir, PQ_DIM, PQ_WIDTH))
    return books, encode_pq(items, books, digits=DIGITS)


def pq_encode(spark, sf_dir):
    _, coded = _coded(spark, sf_dir, vector_items(spark, sf_dir).select("id", "vector"))
    return coded.select("id", F.posexplode("codes").alias("sub", "code")).withColumn("code", F.col("code").cast("int"))


def pq_search(spark, sf_dir):
    items = vector_items(spark, sf_dir)
    books, coded = _coded(spark, sf_dir, items)
    return search_pq(coded.select("id", "codes"), books, items, label_queries(spark, sf_dir), TOP_K, rerank=0, digits=DIGITS)


def pq_search_rerank(spark, sf_dir):
    items = vector_items(spark, sf_dir)
    books, coded = _coded(spark, sf_dir, items)
    return search_pq(coded.select("id", "codes"), books, items, label_queries(spark, sf_dir), TOP_K, rerank=4, digits=DIGITS)


def ivfpq_search(spark, sf_dir):
    """Codes within the probed lists, re-ranked."""
    items = vector_items(spark, sf_dir)
    centroids, cells = _lists(spark, sf_dir, items)
    books, coded = _coded(spark, sf_dir, cells)
    return search_pq(
        coded.select("id", "cell", "codes"), books, items, label_queries(spark, sf_dir), TOP_K, rerank=4,
        centroids=centroids, n_probes=3, digits=DIGITS, prune=False,
    )


def pq_train(spark, sf_dir):
    """Trained codebooks: as many codewords as asked for or as there are slices, and codes that are the nearest."""
    items = vector_items(spark, sf_dir).select("id", "vector")
    books = settle(train_pq(items, PQ_DIM, 4, max_iters=5))
    coded = encode_pq(items, load_books(books))
    cut = F.transform("codes", lambda code, sub: F.struct(code.cast("int").alias("own"), F.slice("vector", sub * PQ_WIDTH + 1, F.lit(PQ_WIDTH)).alias("part")))
    parts = coded.select("id", F.posexplode(cut).alias("sub", "x")).select("id", "sub", "x.own", "x.part")
    value = distance("part", "centroid", "euclidean")
    best = parts.join(F.broadcast(books), "sub").groupBy("sub", "id").agg(
        F.min(value).alias("least"), F.min(F.when(F.col("own") == F.col("code"), value)).alias("own")
    )
    wrong = best.groupBy("sub").agg(F.count_if(F.col("own") > F.col("least") + 1e-9).alias("wrong_codes"))
    sizes = books.groupBy("sub").agg(F.count("*").alias("n_codes"))
    return sizes.join(wrong, "sub").select("sub", "n_codes", "wrong_codes")


# Evaluation


def pq_residual(spark, sf_dir):
    """Codes of residuals against codes of the vectors, with the same bits: the decoded vectors lie nearer."""
    items = vector_items(spark, sf_dir).select("id", "vector")
    centroids = load_centroids(train_ivf(items, n_lists=16, max_iters=4))
    placed = assign_cells(items, centroids)
    less = residuals(placed, centroids)
    spreads = []
    for source, known in ((items, None), (less, centroids)):
        books = load_books(train_pq(source, PQ_DIM, 4, max_iters=4))
        decoded = decode_pq(encode_pq(source, books), books, known).select("id", "decoded").join(items, "id")
        gap = distance("decoded", "vector", "euclidean")
        spreads.append(decoded.agg(F.avg(gap * gap).alias("spread")).first()[0])
    return items.agg(F.count(F.lit(1)).alias("n_items")).withColumn("nearer", F.lit(spreads[1] < spreads[0]))


def recall_at_k(spark, sf_dir):
    items = vector_items(spark, sf_dir)
    truth = knn_exact(items, label_queries(spark, sf_dir), TOP_K, digits=DIGITS)
    found = evaluation.recall_at_k(truth, _probe(spark, sf_dir, n_probes=3))
    return found.select("n_queries", F.round("recall", DIGITS).alias("recall"))


_FILTERS = {1: {"lang": "en"}, 2: {"n_chars": {"$gt": 500}}, 3: {"lang": "xx"}}


def _filtered_recalls(spark, sf_dir) -> DataFrame:
    items = vector_items(spark, sf_dir)
    queries = settle(label_queries(spark, sf_dir))
    centroids, cells = _lists(spark, sf_dir, items)
    asked, truth, hits = [], [], []
    for number, filters in _FILTERS.items():
        mark = F.lit(number).alias("filter_id")
        asked.append(queries.select(mark, "query_id"))
        truth.append(knn_exact(items, queries, TOP_K, filters=filters, digits=DIGITS).select(mark, "query_id", "id"))
        hits.append(
            probe(cells, centroids, queries, TOP_K, n_probes=1, filters=filters, digits=DIGITS, prune=False).select(mark, "query_id", "id")
        )
    asked, truth, hits = (_union(parts) for parts in (asked, truth, hits))
    return evaluation.recall_filtered(asked, truth, hits, keys=("filter_id", "query_id"))


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def recall_filtered(spark, sf_dir):
    found = _filtered_recalls(spark, sf_dir)
    return found.select("filter_id", "n_queries", F.round("recall", DIGITS).alias("recall"))


def recall_thresholds(spark, sf_dir):
    """Filters whose recall stays below 0.95 of the floor asked for."""
    floors = spark.createDataFrame(list(RECALL_FLOORS), "filter_id int, threshold double")
    failed = evaluation.recall_failures(_filtered_recalls(spark, sf_dir), floors, 0.95)
    return failed.select(
        "filter_id", F.round("recall_percent", 4).alias("recall_percent"), F.round("floor", 4).alias("floor")
    )


def leak_check(spark, sf_dir):
    deleted = _toxic_ids(spark, sf_dir)
    left = delete_state(vector_items(spark, sf_dir), deleted)
    hits = knn_exact(left, label_queries(spark, sf_dir), TOP_K, digits=DIGITS)
    listed = evaluation.leak_check(left, deleted).select(F.lit("list").alias("source"), "n_leaks")
    found = evaluation.leak_check(hits, deleted).select(F.lit("query").alias("source"), "n_leaks")
    before = evaluation.leak_check(vector_items(spark, sf_dir), deleted).select(F.lit("before").alias("source"), "n_leaks")
    return listed.unionByName(found).unionByName(before)


def roundtrip_integrity(spark, sf_dir):
    """Items written as JSON lines and read back."""
    items = vector_items(spark, sf_dir)
    path = shared_dir(spark, "roundtrip")
    write_items_json(items, path)
    lost = evaluation.roundtrip_diff(items, read_items_json(spark, path))
    both = count_items(items).withColumn("side", F.lit("items")).unionByName(count_items(lost).withColumn("side", F.lit("lost")))
    return both.select("side", "n_items")


def roundtrip_changes(spark, sf_dir):
    """What a replacement changed: the same check on tables that do differ."""
    items = vector_items(spark, sf_dir)
    return evaluation.roundtrip_diff(items, upsert_state(items, _label_changes(spark, sf_dir)))


def id_prefix_count(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.concat_ws("-", "lang", "doc_id").alias("id"))
    return evaluation.id_prefix_count(documents, "en-")


# Text, training, catalogue, confidentiality, streams


def content_query(spark, sf_dir):
    """The documents closest to each benchmark text, by token-hash embeddings."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    queries = embed_text(asked, "text", "query_vector").select("query_id", "query_vector")
    return knn_exact(embed_text(documents, "text"), queries, 5, "cosine", digits=DIGITS)


def embed_on_ingest(spark, sf_dir):
    """Conversation turns arrive as contents without a vector."""
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.lit(None).cast("array<float>").alias("vector"),
        F.col("text").alias("contents"),
    )
    made = embed_missing(turns)
    used = F.size(F.filter("vector", lambda x: x > 0))
    return made.select("id", used.alias("n_used"), F.round(F.array_max("vector").cast("double"), 5).alias("peak"))


def training_decision(spark, sf_dir):
    """One index per document source; its labelled documents are what it was trained on."""
    documents = table(spark, sf_dir, "documents")
    labelled = documents.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    names = F.col("source").alias("index_name")
    counts = documents.groupBy(names).agg(F.count("*").alias("n_items"))
    trained = labelled.groupBy(names).agg(F.count("*").alias("trained_count"))
    catalog = counts.select("index_name").join(trained, "index_name", "left").select(
        "index_name",
        F.col("trained_count").isNotNull().alias("is_trained"),
        F.coalesce("trained_count", F.lit(0)).alias("trained_count"),
    )
    return training_status(catalog, counts, threshold=10, multiplier=2.5)


def catalog_list(spark, sf_dir):
    return list_indexes(event_catalog(spark, sf_dir))


def catalog_describe(spark, sf_dir):
    rows = describe_index(event_catalog(spark, sf_dir))
    return rows.select("index_name", "index_type", "is_trained", "dimension", "metric", "trained_count")


def encrypted_roundtrip(spark, sf_dir):
    """Text sealed and opened again; another key opens nothing."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("contents"))
    key, wrong = key_frame(spark, KEY), key_frame(spark, KEY[::-1])
    sealed = encrypt_columns(documents, ["contents"], key).withColumn("cipher", F.col("contents"))
    opened = decrypt_columns(sealed, {"contents": "string"}, key)
    return opened.select(
        "id",
        F.md5("contents").alias("contents_md5"),
        (F.col("cipher") != F.col("contents").cast("binary")).alias("is_sealed"),
        unseal(F.col("cipher"), wrong.scalar(), F.col("id")).isNotNull().alias("wrong_key_opens"),
    )


def encrypted_vectors(spark, sf_dir):
    """Vectors and metadata sealed and opened; the rows that came back changed."""
    items = vector_items(spark, sf_dir)
    key = key_frame(spark, KEY)
    kinds = {"vector": "array<float>", "contents": "string", "metadata": "variant"}
    opened = decrypt_columns(encrypt_columns(items, list(kinds), key), kinds, key)
    lost = count_items(evaluation.roundtrip_diff(items, opened, tolerance=0.0)).withColumn("side", F.lit("lost"))
    return count_items(opened).withColumn("side", F.lit("items")).unionByName(lost).select("side", "n_items")


def index_query(spark, sf_dir):
    """An encrypted index end to end: create, upsert, delete, search untrained."""
    index = VectorStore(spark, shared_dir(spark, "index")).create_index("sample", KEY, IVFFlat(64))
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    index.delete(_toxic_ids(spark, sf_dir))
    hits = index.query(query_vectors=label_queries(spark, sf_dir), top_k=TOP_K, filters={"lang": "en"})
    return hits.select("query_id", "rank", "id", F.round("distance", DIGITS).alias("distance"), _meta("label", "int").alias("label"))


def index_trained_query(spark, sf_dir):
    """A trained index probed in full, after deletes that came later than training."""
    index = VectorStore(spark, shared_dir(spark, "index")).create_index("sample", KEY, IVFFlat(64))
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    index.train(n_lists=8, max_iters=5)
    index.delete(_toxic_ids(spark, sf_dir))
    hits = index.query(query_vectors=label_queries(spark, sf_dir), top_k=TOP_K, n_probes=8, filters={"lang": "en"})
    return hits.select("query_id", "rank", "id", F.round("distance", DIGITS).alias("distance"), _meta("label", "int").alias("label"))


def _trained(spark, sf_dir, config, bucket_bytes: int = 1 << 16, **options):
    """An index over all vectors, trained, and changed afterwards; its snapshot has many small buckets."""
    index = VectorStore(spark, shared_dir(spark, "index"), bucket_bytes=bucket_bytes).create_index("sample", KEY, config)
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    index.train(n_lists=8, max_iters=5, **options)
    index.delete(_toxic_ids(spark, sf_dir))
    return index


def index_ivf_query(spark, sf_dir):
    """Lists of ids alone, probed in full: vectors and metadata come from the buckets of the items."""
    index = _trained(spark, sf_dir, IVF(64))
    hits = index.query(query_vectors=label_queries(spark, sf_dir), top_k=TOP_K, n_probes=8, filters={"lang": "en"})
    return hits.select("query_id", "rank", "id", F.round("distance", DIGITS).alias("distance"), _meta("label", "int").alias("label"))


def _judged(spark, sf_dir, hits: DataFrame, floor: float) -> DataFrame:
    """Hits against an exact search: how many, whether their distances are the true ones, and whether enough were found."""
    left = delete_state(vector_items(spark, sf_dir), _toxic_ids(spark, sf_dir))
    queries = settle(label_queries(spark, sf_dir))
    truth = knn_exact(left, queries, TOP_K, include=["distance"])
    told = hits.join(left.select("id", "vector"), "id").join(queries, "query_id")
    true = F.abs(F.col("distance") - distance("query_vector", "vector", "euclidean")) < 1e-6
    recall = evaluation.recall_at_k(truth, hits).select(F.lit("floor_reached").alias("what"), (F.col("recall") >= floor).cast("bigint").alias("n"))
    counts = [told.filter(true).select(F.lit("true_hits").alias("what")), told.filter(~true).select(F.lit("untrue_hits").alias("what"))]
    return _union([rows.groupBy("what").agg(F.count(F.lit(1)).alias("n")) for rows in counts] + [recall])


def index_ivfpq_query(spark, sf_dir):
    """Codes probed in full and all re-ranked: the exact answer, with metadata from the same fetch."""
    index = _trained(spark, sf_dir, IVFPQ(64, 8, 6))
    options = dict(top_k=TOP_K, n_probes=8, filters={"lang": "en"}, rerank=1 + index.count() // TOP_K)
    hits = index.query(query_vectors=label_queries(spark, sf_dir), **options)
    return hits.select("query_id", "rank", "id", F.round("distance", DIGITS).alias("distance"), _meta("label", "int").alias("label"))


def index_probe_query(spark, sf_dir):
    """As many probes as calibration chose."""
    index = _trained(spark, sf_dir, IVFFlat(64))
    hits = index.query(query_vectors=label_queries(spark, sf_dir), top_k=TOP_K, include=["distance"])
    return _judged(spark, sf_dir, hits, 0.7)


def index_filtered_auto(spark, sf_dir):
    """Recall under filters of a trained index that chooses its probes: which floors are reached."""
    index = _trained(spark, sf_dir, IVFFlat(64))
    left = delete_state(vector_items(spark, sf_dir), _toxic_ids(spark, sf_dir))
    queries = settle(label_queries(spark, sf_dir))
    asked, truth, hits = [], [], []
    for number, filters in _FILTERS.items():
        mark = F.lit(number).alias("filter_id")
        asked.append(queries.select(mark, "query_id"))
        truth.append(knn_exact(left, queries, TOP_K, filters=filters).select(mark, "query_id", "id"))
        hits.append(index.query(query_vectors=queries, top_k=TOP_K, filters=filters, include=[]).select(mark, "query_id", "id"))
    found = evaluation.recall_filtered(*(_union(parts) for parts in (asked, truth, hits)), keys=("filter_id", "query_id"))
    return found.select("filter_id", "n_queries", (F.col("recall") >= 0.8).alias("floor_reached"))


def knn_bounded(spark, sf_dir):
    """A batch whose tasks first learn from some of them how near a row must be."""
    return knn_exact(vector_items(spark, sf_dir), label_queries(spark, sf_dir), TOP_K, digits=DIGITS, limits=SearchLimits(emit_rows=0))


def index_get_after_compaction(spark, sf_dir):
    """Items of a bucketed snapshot, of which a second compaction wrote some buckets anew, asked for in an order."""
    index = VectorStore(spark, shared_dir(spark, "index"), bucket_bytes=1 << 16).create_index("sample", KEY, IVFFlat(64))
    items = vector_items(spark, sf_dir)
    index.upsert(items, auto_train=False)
    index.compact()
    index.delete(_toxic_ids(spark, sf_dir))
    index.compact()
    asked = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("id"))
    got = index.get(asked, ["vector", "metadata"])
    return got.select("ordinal", "id", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"), _meta("label", "int").alias("label"))


def index_contract(spark, sf_dir):
    """What an index does at the edges of its life, as counts."""
    store = VectorStore(spark, shared_dir(spark, "index"))
    index = store.create_index("sample", KEY, IVFFlat(64))
    empty = index.query(query_vectors=label_queries(spark, sf_dir), top_k=TOP_K).count()
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    before = int(index.is_trained)
    index.train(n_lists=8, max_iters=2)
    loaded = store.load_index("sample", KEY)
    found = {
        "hits_of_empty": empty, "loaded_items": loaded.count(), "trained_before": before, "trained_after": int(loaded.is_trained),
        "wrong_key_opens": 1 - _refused(PermissionError, lambda: store.load_index("sample", KEY[::-1])),
        "two_inputs_pass": 1 - _refused(ValueError, lambda: index.query(query_vector=[0.0] * 64, query_contents="x")),
        "no_input_passes": 1 - _refused(ValueError, lambda: index.query()),
        "second_create_passes": 1 - _refused(ValueError, lambda: store.create_index("sample", KEY)),
        "listed": store.list_indexes().count(),
    }
    index.delete_index()
    found["listed_after_drop"] = store.list_indexes().count()
    found["dropped_loads"] = 1 - _refused(LookupError, lambda: store.load_index("sample", KEY))
    return spark.createDataFrame(list(found.items()), "step string, n bigint")


def _refused(error: type, call) -> int:
    try:
        call()
    except error:
        return 1
    return 0


def training_running(spark, sf_dir):
    """The list of running trainings before, while and after an index over all vectors is trained."""
    store = VectorStore(spark, shared_dir(spark, "index"))
    index = store.create_index("sample", KEY, IVFFlat(64), encrypt=())
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    seen = {"before": store.training_running().count(), "during": 0}
    with ThreadPoolExecutor(1) as pool:
        job = pool.submit(index.train, n_lists=4, max_iters=2)
        while not job.done():
            seen["during"] = max(seen["during"], len(store.store.running_trainings()))
            time.sleep(0.1)
        job.result()
    seen["after"] = store.training_running().count()
    counts = spark.createDataFrame(list(seen.items()), "step string, n bigint")
    return counts.unionByName(index.status().select(F.lit("trained_items").alias("step"), F.col("trained_count").alias("n")))


def dead_claim_taken_over(spark, sf_dir):
    """A writer that died between its claim and its row: the next one takes over, and a late one fails."""
    store = VectorStore(spark, shared_dir(spark, "index"), lease_seconds=600.0)
    folder, root = store.store.folder, store.store.root
    folder.create(f"{root}/_claims/sample/{1:012d}/000")
    found = {"created_within_lease": 1 - _refused(ValueError, lambda: store.create_index("sample", KEY, IVFFlat(64), encrypt=()))}
    # The lease runs out.
    store.store.lease_seconds = 0.0
    index = store.create_index("sample", KEY, IVFFlat(64), encrypt=())
    index.upsert(vector_items(spark, sf_dir), auto_train=False)
    entry = index._entry()
    folder.create(f"{root}/_claims/sample/{entry['version'] + 1:012d}/000")
    index.compact()
    found["late_writer_passes"] = 1 - _refused(LeaseLost, lambda: _write_late(store.store, entry))
    found["compacted_items"] = index._entry()["snapshot_count"]
    return spark.createDataFrame(list(found.items()), "step string, n bigint")


def _write_late(store, entry: dict) -> None:
    """What the first claimant does when it goes on after all."""
    claims = f"{store.root}/_claims/{entry['index_name']}/{entry['version'] + 1:012d}"
    store._require_lease(claims, 0)


def concurrent_upserts(spark, sf_dir):
    """One upsert per label, all at once, into an index that has no dimension yet."""
    index = VectorStore(spark, shared_dir(spark, "index")).create_index("shared", KEY, encrypt=())
    items = vector_items(spark, sf_dir)
    parts = [items.filter(_meta("label", "int") % 4 == n) for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda part: index.upsert(part, auto_train=False), parts))
    return index.items().groupBy(_meta("label", "int").alias("label")).agg(F.count("*").alias("n_items"))


def stream_then_upsert(spark, sf_dir):
    """Batch, stream, batch, stream into one index: the last write of an item wins."""
    root = shared_dir(spark, "stream")
    index = VectorStore(spark, root).create_index("mixed", KEY, encrypt=())
    told = lambda df, what: df.select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"), F.lit(what).alias("contents")
    )
    for n, (kind, most) in enumerate([("batch", 9), ("stream", 6), ("batch", 4), ("stream", 2)]):
        if kind == "batch":
            index.upsert(told(table(spark, sf_dir, "embeddings").filter(F.col("label") <= most), f"{kind}-{n}"), auto_train=False)
        else:
            stream = table_stream(spark, sf_dir, "embeddings").filter(F.col("label") <= most)
            index.upsert_stream(told(stream, f"{kind}-{n}"), f"{root}/checkpoint-{n}").awaitTermination()
    return index.items().groupBy("contents").agg(F.count("*").alias("n_items"))


def filter_big_int(spark, sf_dir):
    """Comparisons of integers whose neighbours share one double."""
    big = F.col("event_id") + F.lit(1 << 53)
    rows = table(spark, sf_dir, "events").select(F.parse_json(F.to_json(F.struct(big.alias("n")))).alias("metadata"))
    counts = [F.count_if(compile_filter({"n": {op: (1 << 53) + 101}})).alias(op[1:]) for op in ("$gt", "$gte", "$lt", "$lte")]
    return rows.agg(*counts)


def stream_upsert_log(spark, sf_dir):
    """Events streamed into a change log, then compacted."""
    root = shared_dir(spark, "stream")
    changes = event_changes(table_stream(spark, sf_dir, "events")).drop("uid")
    upsert_stream(changes, f"{root}/log", f"{root}/checkpoint", order_col="seq").awaitTermination()
    log = spark.read.schema(log_schema([])).parquet(f"{root}/log/*")
    return _log_digest(compact(log))


def stream_query(spark, sf_dir):
    """A stream of query vectors answered against the label means."""
    stream = table_stream(spark, sf_dir, "embeddings")
    asked = stream.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    means = label_centroids(spark, sf_dir).select(F.col("cell").cast("string").alias("id"), F.col("centroid").alias("vector"))
    root = shared_dir(spark, "stream")
    query_stream(
        asked, lambda batch: knn_exact(means, batch, 3, digits=DIGITS), f"{root}/hits", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/hits").select("query_id", "rank", "id", "distance")


QUERIES = {
    query.__name__: query
    for query in (
        knn_single_euclidean, knn_batch_euclidean, knn_batch_cosine, knn_batch_dot, knn_include_vector,
        knn_include_metadata, knn_filter_eq, knn_filter_eq_int, knn_filter_gt, knn_filter_in, knn_filter_and,
        knn_filter_path, knn_filter_none_match, filter_matches, filter_extensions, filter_json_props, distance_metrics,
        upsert_insert_replace, upsert_idempotent, upsert_ordered, delete_ids, get_by_ids_ordered, list_ids,
        count_vectors, validate_event_items, compact_log, compact_over_snapshot,
        ivf_assign, ivf_centroids, ivf_probe, ivf_full_probe, ivf_greedy, ivf_filtered_probe, ivf_postings_probe, ivf_train, ivf_train_mini,
        pq_codebooks, pq_encode, pq_search, pq_search_rerank, ivfpq_search, pq_train, pq_residual,
        recall_at_k, recall_filtered, recall_thresholds, leak_check, roundtrip_integrity, roundtrip_changes, id_prefix_count,
        content_query, embed_on_ingest, training_decision, catalog_list, catalog_describe,
        encrypted_roundtrip, encrypted_vectors, index_query, index_trained_query, index_ivf_query, index_ivfpq_query,
        index_probe_query, index_filtered_auto, knn_bounded, index_get_after_compaction, index_contract, concurrent_upserts,
        training_running, dead_claim_taken_over,
        stream_upsert_log, stream_query, stream_then_upsert, filter_big_int,
    )
}
