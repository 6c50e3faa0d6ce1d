"""The vector index: a named, keyed table with search, training and maintenance.

The class only adds catalogue rows, paths and the key to the table operators; every
method that returns rows returns a DataFrame.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vicinal.functions.crypto import decrypt_columns, encrypt_columns, key_check, key_frame, key_opens
from vicinal.functions.embedding import Embedder, embed_missing, embedding, hash_embedder
from vicinal.operators.buckets import bucket_of, fetch, in_buckets
from vicinal.operators.catalog import describe_index, list_indexes
from vicinal.operators.clustering import Centroids, assign_cells, block_rows, centroid_frame, load_centroids, train_centroids
from vicinal.operators.items import (
    ITEM_COLUMNS,
    as_items,
    current_state,
    duplicate_ids,
    get_items,
    latest,
    list_ids,
    require_valid,
)
from vicinal.operators.ivf import calibrate_probes, matching_lists, probe
from vicinal.operators.knn import knn_exact
from vicinal.operators.pq import encode_pq, load_books, residuals, search_pq, train_pq
from vicinal.operators.training import training_status
from vicinal.options import (
    BLOCK_ROWS,
    BUCKET_BYTES,
    CALIBRATION_QUERIES,
    MAX_BUCKETS,
    RERANK_FACTOR,
    RETRAIN_MULTIPLIER,
    TRAIN_THRESHOLD,
    IndexConfig,
    check_config,
    check_key,
    check_metric,
    check_name,
    check_probes,
    check_top_k,
)
from vicinal.sources.index_store import LEASE_SECONDS, PLAIN_KINDS, IndexStore, known_seq, new_uid, next_seq, write_changes
from vicinal.streaming.ingest import stream_batches

_CENTROID_KIND = {"centroid": "array<double>"}
_MAX_TASKS = 100_000
# Bytes of items that a task of a compaction writes, unless one bucket holds more.
_TASK_BYTES = 32 << 20


class VectorStore:
    """All indexes below one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        embedder: Embedder | None = None,
        embedders: dict[str, Embedder] | None = None,
        train_threshold: int = TRAIN_THRESHOLD,
        retrain_multiplier: float = RETRAIN_MULTIPLIER,
        bucket_bytes: int = BUCKET_BYTES,
        lease_seconds: float = LEASE_SECONDS,
    ):
        self.spark = spark
        self.store = IndexStore(spark, root, lease_seconds)
        self.embedder = embedder
        self.embedders = {"token-hash": None, **(embedders or {})}
        self.train_threshold = train_threshold
        self.retrain_multiplier = retrain_multiplier
        self.bucket_bytes = bucket_bytes

    def create_index(
        self,
        name: str,
        key: bytes,
        config: IndexConfig | None = None,
        metric: str | None = None,
        embedding_model: str | None = None,
        encrypt: Sequence[str] = tuple(PLAIN_KINDS),
    ) -> "VectorIndex":
        """An empty, untrained index under a new name.

        ``encrypt`` names the columns that are stored as ciphertext. Metadata left out
        of it stays readable to the Parquet scan, which lets filters skip row groups.
        """
        name, key, config, metric = check_name(name), check_key(key), check_config(config), check_metric(metric)
        self.check_model(embedding_model)
        unknown = [column for column in encrypt if column not in PLAIN_KINDS]
        if unknown:
            raise ValueError(f"cannot encrypt {unknown}")
        newest = self._newest(name)
        if newest is not None and not newest["dropped"]:
            raise ValueError(f"index {name!r} already exists")
        entry = dict(
            index_name=name,
            version=newest["version"] if newest else 0,
            index_uid=new_uid(),
            index_type=config.index_type,
            dimension=config.dimension,
            metric=metric,
            embedding_model=embedding_model,
            pq_dim=getattr(config, "pq_dim", None),
            pq_bits=getattr(config, "pq_bits", None),
            residual=getattr(config, "residual", None),
            is_trained=False,
            trained_count=0,
            key_check=bytearray(key_check(self.spark, key, name)),
            encrypted=list(encrypt),
            snapshot_count=0,
            parts=[],
            covered=[],
            lists_covered=[],
            dropped=False,
        )
        try:
            self.store.append_entry(entry)
        except FileExistsError:
            raise ValueError(f"index {name!r} already exists") from None
        return VectorIndex(self, name, key)

    def load_index(self, name: str, key: bytes) -> "VectorIndex":
        key, entry = check_key(key), self._entry(name)
        if entry is None:
            raise LookupError(f"no index named {name!r}")
        if not key_opens(self.spark, key, name, entry["key_check"]):
            raise PermissionError(f"wrong key for index {name!r}")
        return VectorIndex(self, name, key)

    def list_indexes(self) -> DataFrame:
        return list_indexes(self.store.catalog())

    def training_running(self) -> DataFrame:
        """``(index_name, n_trainings)`` of the indexes that are being trained just now, here or elsewhere."""
        return self.spark.createDataFrame(self.store.running_trainings(), "index_name string, n_trainings int")

    def describe(self, name: str | None = None) -> DataFrame:
        return describe_index(self.store.catalog(), name)

    def check_model(self, model: str | None) -> None:
        """A named model must be known here: another one would answer in another vector space."""
        if model is not None and model not in self.embedders and self.embedder is None:
            raise ValueError(f"unknown embedding model {model!r}; known: {sorted(self.embedders)}")

    def _newest(self, name: str) -> dict | None:
        """The latest row of one name, dropped or not."""
        return self.store.newest(name)

    def _entry(self, name: str) -> dict | None:
        newest = self._newest(name)
        return None if newest is None or newest["dropped"] else newest


class VectorIndex:
    def __init__(self, owner: VectorStore, name: str, key: bytes):
        self.owner = owner
        self.spark = owner.spark
        self.store = owner.store
        self.name = name
        self._key_df = key_frame(owner.spark, key)

    # Catalogue

    def describe(self) -> DataFrame:
        self._entry()
        return self.owner.describe(self.name)

    @property
    def is_trained(self) -> bool:
        return self._entry()["is_trained"]

    def status(self) -> DataFrame:
        """Trained or not, at which size, whether training is due and whether one runs."""
        entry = self._entry()
        row = (self.name, entry["is_trained"], entry["trained_count"])
        catalog = self.spark.createDataFrame([row], "index_name string, is_trained boolean, trained_count bigint")
        counts = self._items(entry).agg(F.count("*").alias("n_items")).withColumn("index_name", F.lit(self.name))
        known = training_status(catalog, counts, self.owner.train_threshold, self.owner.retrain_multiplier)
        return known.withColumn("is_training", F.lit(self.name in dict(self.store.running_trainings())))

    def delete_index(self) -> None:
        """Drop the index and its files; this handle is invalid afterwards."""
        entry = self._entry()
        self.store.update_entry(entry, {"dropped": True})
        self.store.folder.delete(self.store.index_path(entry))

    # Items

    def upsert(self, df: DataFrame, order_col: str | None = None, auto_train: bool = True) -> dict:
        """Insert or replace whole items by id.

        Contents without a vector are embedded first. Any item that is not acceptable
        fails the call and nothing is written. Returns whether training was triggered.
        """
        entry, changes = self._changes(df, order_col)
        self._append(entry, changes)
        triggered = auto_train and self._training_due(entry)
        if triggered:
            self.train()
        return {"training_triggered": triggered}

    def _changes(self, df: DataFrame, order_col: str | None) -> tuple[dict, DataFrame]:
        """The checked rows of a change set, and the entry with the dimension that they freeze."""
        entry = self._entry()
        items = as_items(df.drop(order_col) if order_col else df)
        if order_col is None:
            repeated = duplicate_ids(items.select("id")).limit(1).collect()
            if repeated:
                raise ValueError(f"id {repeated[0]['id']!r} occurs more than once; pass order_col")
        else:
            newest = latest(df, [order_col])
            items = as_items(newest.drop(order_col))
        if "vector" not in df.columns or entry["embedding_model"] is not None:
            items = embed_missing(items, self._embedder(entry))
        entry = self._with_dimension(entry, items)
        return entry, require_valid(items, entry["dimension"]).withColumn("op", F.lit("U"))

    def upsert_stream(
        self, stream: DataFrame, checkpoint: str, order_col: str | None = None, available_now: bool = True
    ) -> StreamingQuery:
        """Upsert a stream of items; every micro-batch is checked like a batch and is one change set.

        A micro-batch takes its number in the order of change sets when it is first written; a replayed one
        keeps it. ``order_col`` says which row of an id wins within a micro-batch. A rejected item ends
        the stream and nothing of its micro-batch is written.
        """

        def write(batch: DataFrame, mark: str) -> None:
            entry, changes = self._changes(batch, order_col)
            self._append(entry, changes, mark)

        return stream_batches(stream, write, checkpoint, available_now)

    def delete(self, ids: DataFrame | Sequence[str]) -> None:
        """Remove items for good; unknown ids are ignored."""
        if not isinstance(ids, DataFrame):
            ids = self.spark.createDataFrame([(i,) for i in ids], "id string")
        empty = {name: F.lit(None).cast(kind) for name, kind in PLAIN_KINDS.items()}
        self._append(self._entry(), ids.select("id").distinct().withColumns(empty).withColumn("op", F.lit("D")))

    def items(self) -> DataFrame:
        return self._items(self._entry()).select(*ITEM_COLUMNS)

    def get(self, ids: DataFrame | Sequence[str], include: Iterable[str] | None = None) -> DataFrame:
        """Items in the order asked for; of the snapshot only the buckets of the ids are read."""
        return get_items(self._items(self._entry()), ids, include)

    def list_ids(self) -> DataFrame:
        return list_ids(self.items())

    def count(self) -> int:
        return self.list_ids().count()

    def compact(self) -> None:
        """Fold the change log into the snapshot; only the buckets that it touches are written anew."""
        entry = self._entry()
        batches = self.store.batches(entry)
        if set(batches) - set(entry["covered"]):
            self._write_snapshot(entry, batches)

    def vacuum(self) -> None:
        """Delete batches, snapshots and trainings that no later read needs."""
        entry = self._entry()
        path, folder = self.store.index_path(entry), self.store.folder
        done = set(entry["covered"])
        if entry["is_trained"]:
            done &= set(entry["lists_covered"])
        for name in self.store.batches(entry):
            if name in done:
                folder.delete(f"{path}/log/{name}")
        held = {f"gen={part['gen']}": {f"bucket={n}" for n in part["buckets"]} for part in entry["parts"] or []}
        for name in folder.committed(f"{path}/items"):
            if name not in held:
                folder.delete(f"{path}/items/{name}")
                continue
            for bucket in folder.names(f"{path}/items/{name}"):
                if bucket.startswith("bucket=") and bucket not in held[name]:
                    folder.delete(f"{path}/items/{name}/{bucket}")
        for name in folder.names(f"{path}/lists"):
            if name != entry["lists"]:
                folder.delete(f"{path}/lists/{name}")

    # Training

    def train(
        self,
        n_lists: int | None = None,
        batch_size: int | None = None,
        max_iters: int | None = None,
        tolerance: float | None = None,
        max_memory: int | None = None,
        top_k: int = 100,
        seed: int = 42,
        calibration_queries: int = CALIBRATION_QUERIES,
        mini_batch: int | None = None,
    ) -> None:
        """Cluster the items into lists, and quantise them for an ``ivfpq`` index.

        The work starts from a compacted snapshot and reads all of it. ``batch_size`` and ``max_memory``
        (MB) bound the vectors that a task compares at once. The default number of probes is measured on
        ``calibration_queries`` items. With ``mini_batch`` a round reads a slice of about so many items. While it runs the index is listed by ``training_running``.
        """
        block_rows(batch_size, max_memory, n_lists or 1)
        with self.store.training_mark(self._entry()):
            self._train(n_lists, batch_size, max_iters, tolerance, max_memory, top_k, seed, calibration_queries, mini_batch)

    def _train(self, n_lists, batch_size, max_iters, tolerance, max_memory, top_k, seed, calibration_queries, mini_batch) -> None:
        self.compact()
        entry = self._entry()
        items = self._items(entry)
        metric, uid = entry["metric"], new_uid()
        path = f"{self.store.index_path(entry)}/lists/{uid}"
        # The catalogue knows both already: no pass that decrypts every vector to count.
        shape = (entry["snapshot_count"], entry["dimension"]) if entry["snapshot_count"] else None
        # The counts of the last round shape the files; the lists themselves are counted once written.
        centroids = train_centroids(items, n_lists or None, max_iters, tolerance, max_memory, metric, seed, shape, batch_size, mini_batch)
        kept = {"ivf": ["id"], "ivfflat": ["id", "vector", "metadata"], "ivfpq": ["id"]}[entry["index_type"]]
        placed = assign_cells(items, centroids, metric)
        if entry["index_type"] == "ivfpq":
            coded, space = self._to_code(entry, placed, centroids)
            words = train_pq(
                coded, entry["pq_dim"], entry["pq_bits"], space, max_iters, tolerance, seed, shape, batch_size, max_memory
            )
            self._write_sealed(words, f"{path}/books", "sub")
            books = load_books(self._read_sealed(f"{path}/books", "sub"))
            placed = encode_pq(coded, books, space)
            kept = kept + ["codes"]
        self._write_cells(placed.select(*kept, "cell"), centroids, entry, f"{path}/cells")
        sizes = dict(self.spark.read.parquet(f"{path}/cells").groupBy("cell").count().collect())
        counts = np.array([sizes.get(int(cell), 0) for cell in centroids.cells], np.int64)
        centroids = Centroids(centroids.cells, centroids.matrix, counts)
        self._write_sealed(centroid_frame(self.spark, centroids), f"{path}/centroids", "cell")

        first = items.select("id").orderBy(F.xxhash64(F.lit(seed), "id")).limit(calibration_queries)
        asked = fetch(items, first, ["vector"], True).select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
        probes = calibrate_probes(self._read_cells(entry, path), centroids, asked, top_k, metric, items=items)
        self.store.update_entry(
            entry,
            {
                "n_lists": len(centroids.cells),
                "auto_n_probes": probes,
                "is_trained": True,
                "trained_count": int(centroids.counts.sum()),
                "lists": uid,
                "lists_covered": entry["covered"],
            },
        )

    # Search

    def query(
        self,
        query_vector: Sequence[float] | None = None,
        query_vectors: DataFrame | Sequence[Sequence[float]] | None = None,
        query_contents: str | Sequence[str] | None = None,
        top_k: int | None = None,
        n_probes: int | None = None,
        greedy: bool = False,
        filters: dict | None = None,
        include: Iterable[str] | None = None,
        rerank: int = RERANK_FACTOR,
    ) -> DataFrame:
        """Closest items per query as ``(query_id, rank, id, ...)``, in query order.

        Exactly one of a vector, a batch of vectors and contents is given; a batch is a
        list, or a DataFrame ``(query_id, query_vector)``. An untrained index is searched
        exactly. Without ``n_probes`` the value calibrated at training is used; under a filter, as many lists
        as hold that many rows that match.
        """
        entry, top_k = self._entry(), check_top_k(top_k)
        queries = self._queries(entry, query_vector, query_vectors, query_contents)
        options = dict(top_k=top_k, metric=entry["metric"], filters=filters, include=include)
        if not entry["is_trained"]:
            check_probes(n_probes)
            return knn_exact(self._items(entry), queries, **options).orderBy("query_id", "rank")
        path = f"{self.store.index_path(entry)}/lists/{entry['lists']}"
        centroids = load_centroids(self._read_sealed(f"{path}/centroids", "cell"))
        books = load_books(self._read_sealed(f"{path}/books", "sub")) if entry["index_type"] == "ivfpq" else None
        cells = self._current_cells(entry, path, centroids, books)
        options.update(n_probes=n_probes or entry["auto_n_probes"], greedy=greedy)
        check_probes(n_probes)
        items = self._items(entry)
        if filters and n_probes is None and not greedy:
            # What calibration found holds for rows that match.
            options["matching"] = matching_lists(cells, centroids, filters, items)
        if books is not None:
            hits = search_pq(cells, books, items, queries, rerank=rerank, centroids=centroids, residual=bool(entry["residual"]), **options)
        else:
            hits = probe(cells, centroids, queries, items=items, **options)
        return hits.orderBy("query_id", "rank")

    # Internals

    def _entry(self) -> dict:
        entry = self.owner._entry(self.name)
        if entry is None:
            raise LookupError(f"no index named {self.name!r}")
        return entry

    def _embedder(self, entry: dict) -> Embedder:
        model = entry["embedding_model"]
        self.owner.check_model(model)
        return self.owner.embedders.get(model) or self.owner.embedder or hash_embedder(entry["dimension"] or 64)

    def _queries(self, entry, vector, vectors, contents) -> DataFrame:
        if sum(given is not None for given in (vector, vectors, contents)) != 1:
            raise ValueError("give exactly one of query_vector, query_vectors and query_contents")
        if isinstance(vectors, DataFrame):
            return vectors.select("query_id", "query_vector")
        if contents is not None:
            texts = [contents] if isinstance(contents, str) else list(contents)
            frame = self.spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")
            return frame.select("query_id", embedding("text", self._embedder(entry)).alias("query_vector"))
        rows = [[float(x) for x in row] for row in ([vector] if vector is not None else vectors)]
        expected = entry["dimension"] or (len(rows[0]) if rows else 0)
        if any(len(row) != expected or not row for row in rows):
            raise ValueError(f"query vectors must have dimension {expected}")
        return self.spark.createDataFrame(list(enumerate(rows)), "query_id bigint, query_vector array<double>")

    def _with_dimension(self, entry: dict, items: DataFrame) -> dict:
        """Freeze the dimension at the first vector of an index that has none yet."""
        if entry["dimension"] is not None:
            return entry
        row = items.filter(F.size("vector") > 0).select(F.size("vector").alias("width")).first()
        if row is None:
            return entry
        if entry["pq_dim"] is not None and row["width"] % entry["pq_dim"]:
            raise ValueError(f"pq_dim {entry['pq_dim']} does not divide dimension {row['width']}")
        frozen = self.store.update_entry(entry, {"dimension": row["width"]}, unless="dimension")
        return frozen

    def _append(self, entry: dict, changes: DataFrame, mark: str | None = None) -> None:
        """Write one change set; a ``mark`` that was written before keeps its number."""
        batches = self.store.batches(entry) + entry["covered"]
        seq, uid = known_seq(batches, mark) or next_seq(batches), mark or new_uid()
        try:
            write_changes(changes, self.store.log_path(entry), seq, uid, entry["encrypted"], self._key_df)
        except PySparkException as error:
            found = str(error).partition("rejected item ")[2]
            if found:
                raise ValueError("rejected item " + found.splitlines()[0]) from error
            raise

    def _opened(self, df: DataFrame, encrypted: list[str]) -> DataFrame:
        return decrypt_columns(df, {n: PLAIN_KINDS[n] for n in encrypted if n in df.columns}, self._key_df)

    def _raw_items(self, entry: dict, batches: list[str]) -> DataFrame:
        fresh = [name for name in batches if name not in set(entry["covered"])]
        snapshot = self.store.read_snapshot(entry)
        if not fresh and snapshot is not None:
            return snapshot
        return current_state(self.store.read_log(entry, fresh), snapshot)

    def _items(self, entry: dict) -> DataFrame:
        return self._opened(self._raw_items(entry, self.store.batches(entry)), entry["encrypted"])

    def _write_snapshot(self, entry: dict, batches: list[str]) -> None:
        """Write a generation of the touched buckets, or of all where the number of buckets has to double."""
        uid, folder = new_uid(), self.store.folder
        fresh = [name for name in batches if name not in set(entry["covered"])]
        log, snapshot = self.store.read_log(entry, fresh), self.store.read_snapshot(entry)
        held = self.store.snapshot_size(entry) + sum(folder.size(f"{self.store.log_path(entry)}/{name}") for name in fresh)
        buckets, parts = min(MAX_BUCKETS, max(1, math.ceil(held / self.owner.bucket_bytes))), []
        if snapshot is None or buckets >= 2 * entry["buckets"]:
            touched = list(range(buckets))
            rows = current_state(log, snapshot)
        else:
            buckets = entry["buckets"]
            touched = sorted(row[0] for row in log.select(bucket_of("id", buckets)).distinct().collect())
            rows = current_state(log, snapshot.filter(in_buckets(touched)))
            for part in entry["parts"]:
                left = sorted(set(part["buckets"]) - set(touched))
                parts += [{"gen": part["gen"], "buckets": left}] if left else []
        rows = rows.select(*ITEM_COLUMNS, bucket_of("id", buckets).alias("bucket"))
        # A task writes as many buckets as make up its bytes: small ones do not get a task each.
        tasks = max(math.ceil(held / _TASK_BYTES), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartition(max(1, min(tasks, len(touched))), "bucket")
        rows.write.partitionBy("bucket").parquet(f"{self.store.items_path(entry)}/gen={uid}")
        parts.append({"gen": uid, "buckets": touched})
        changes = {"snapshot": uid, "buckets": buckets, "parts": parts, "covered": batches}
        changes["snapshot_count"] = self.store.read_snapshot({**entry, **changes}).count()
        self.store.update_entry(entry, changes)

    def _training_due(self, entry: dict) -> bool:
        """An upper bound from row counts first; the exact count only when that is due."""
        batches = self.store.batches(entry)
        fresh = [name for name in batches if name not in set(entry["covered"])]
        written = self.store.read_log(entry, fresh).filter(F.col("op") == "U").count()
        limit = entry["trained_count"] * self.owner.retrain_multiplier if entry["trained_count"] else self.owner.train_threshold
        if entry["snapshot_count"] + written < limit:
            return False
        return self._raw_items(entry, batches).select("id").count() >= limit

    def _to_code(self, entry: dict, placed: DataFrame, centroids: Centroids) -> tuple[DataFrame, str]:
        """What is quantised, and under which metric: residuals are compared as they are."""
        if not entry["residual"]:
            return placed, entry["metric"]
        return residuals(placed, centroids, entry["metric"]), "euclidean"

    def _write_sealed(self, df: DataFrame, path: str, aad: str) -> None:
        encrypt_columns(df, ["centroid"], self._key_df, aad).write.parquet(path)

    def _read_sealed(self, path: str, aad: str) -> DataFrame:
        return decrypt_columns(self.spark.read.parquet(path), _CENTROID_KIND, self._key_df, aad)

    def _write_cells(self, cells: DataFrame, centroids, entry: dict, path: str) -> None:
        """One directory per list; a large list is spread over several files and tasks."""
        sizes = [(int(c), max(1, math.ceil(n / (8 * BLOCK_ROWS)))) for c, n in zip(centroids.cells, centroids.counts)]
        parts = F.broadcast(self.spark.createDataFrame(sizes, "cell int, parts int"))
        spread = cells.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        files = min(sum(n for _, n in sizes), _MAX_TASKS)
        sealed = [name for name in (*entry["encrypted"], "codes") if name in cells.columns]
        rows = encrypt_columns(spread.repartition(files, "cell", "part").drop("part", "parts"), sealed, self._key_df)
        rows.write.partitionBy("cell").parquet(path)

    def _read_cells(self, entry: dict, path: str) -> DataFrame:
        cells = self.spark.read.parquet(f"{path}/cells")
        if "codes" in cells.columns:
            return decrypt_columns(cells, {"codes": "array<smallint>"}, self._key_df)
        return self._opened(cells, entry["encrypted"])

    def _current_cells(self, entry: dict, path: str, centroids, books) -> DataFrame:
        """The trained lists, less what changed since, plus what was written since."""
        cells = self._read_cells(entry, path)
        fresh = [name for name in self.store.batches(entry) if name not in set(entry["lists_covered"])]
        if not fresh:
            return cells
        changes = latest(self.store.read_log(entry, fresh), ["seq", "uid"])
        written = self._opened(changes.filter(F.col("op") == "U").select(*ITEM_COLUMNS), entry["encrypted"])
        added = assign_cells(written, centroids, entry["metric"])
        if books is not None:
            coded, space = self._to_code(entry, added, centroids)
            added = encode_pq(coded, books, space)
        return cells.join(changes.select("id"), "id", "left_anti").unionByName(added.select(*cells.columns))
