"""Where an index lives: an append-only catalogue, a change log, snapshots, lists.

    <root>/_catalog/<name>/<version>-<attempt>   one row each, the latest wins
    <root>/_claims/<name>/<version>/<attempt>    who may write that version: created exclusively
    <root>/_training/<name>/<uid>                a training that runs, renewed while it does
    <root>/<name>/<uid>/log/<batch>     one directory per committed change set
    <root>/<name>/<uid>/items/gen=<uid>/bucket=<n>  compacted items, by a hash of the id
    <root>/<name>/<uid>/lists/<uid>     centroids, cells and codebooks of one training

No file is ever rewritten. A change set counts once its directory carries Spark's
``_SUCCESS`` marker, so a lost job leaves nothing behind that a reader would see. A catalogue
version belongs to the writer that created its claim, an exclusive create on the file system; any
other reads the newest version again and puts its own changes on top of it.

A claim is a lease. Once it is older than the lease and its version is still not there, another writer takes the next
attempt; readers follow the highest attempt that was committed. A writer looks at the claims before its row
becomes visible and again afterwards, while one that takes over looks at the catalogue after it has claimed; so
one of the two sees the other, and a writer that lost its lease fails instead of believing that it committed.

The snapshot is the sum of its generations: a compaction writes the buckets anew that the change set touches,
and the catalogue says which generation holds which buckets.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.functions.crypto import encrypt_columns
from vicinal.operators.buckets import as_bucketed, in_buckets

CATALOG_SCHEMA = """
    index_name string, version bigint, uid string, index_uid string, index_type string,
    dimension int, metric string, embedding_model string, pq_dim int, pq_bits int,
    n_lists int, auto_n_probes int, is_trained boolean, trained_count bigint,
    key_check binary, encrypted array<string>, snapshot string, snapshot_count bigint,
    covered array<string>, lists string, lists_covered array<string>, dropped boolean,
    buckets int, parts array<struct<gen:string,buckets:array<int>>>, residual boolean
"""
_CLAIM_POLL = 0.2
#: Tasks that list the folders of a table. Spark's own bound is a task for each of up to 10,000 folders.
_LISTING_TASKS = 64
_LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_LOCK = threading.Lock()
#: Seconds after which a claim, or the mark of a training, counts as dead unless it was renewed.
LEASE_SECONDS = 60.0
PLAIN_KINDS = {"vector": "array<float>", "contents": "string", "metadata": "variant"}


class LeaseLost(RuntimeError):
    """Another writer has taken over what this one had claimed; its change may not count."""


class Folder:
    """The few file-system calls Spark has no DataFrame for, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        path = self._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self._conf), path

    def exists(self, path: str) -> bool:
        system, path = self._path(path)
        return system.exists(path)

    def delete(self, path: str) -> None:
        system, path = self._path(path)
        system.delete(path, True)

    def create(self, path: str) -> bool:
        """Create an empty file; False if it exists."""
        system, path = self._path(path)
        system.mkdirs(path.getParent())
        if system.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates then, which two writers may do at once.
            try:
                with open(path.toUri().getPath(), "x"):
                    return True
            except FileExistsError:
                return False
        try:
            return system.createNewFile(path)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise

    def size(self, path: str) -> int:
        """Bytes of all files below a folder; 0 if it does not exist."""
        system, path = self._path(path)
        return system.getContentSummary(path).getLength() if system.exists(path) else 0

    def age(self, path: str) -> float:
        """Seconds since the file was written or renewed, by this machine's clock."""
        system, path = self._path(path)
        return time.time() - system.getFileStatus(path).getModificationTime() / 1000.0

    def renew(self, path: str) -> None:
        system, path = self._path(path)
        system.setTimes(path, int(time.time() * 1000), -1)

    def names(self, path: str) -> list[str]:
        system, pattern = self._path(f"{path}/*")
        return sorted(status.getPath().getName() for status in system.globStatus(pattern) or [])

    def committed(self, path: str) -> list[str]:
        """Names of the sub-directories that a finished job wrote."""
        system, pattern = self._path(f"{path}/*/_SUCCESS")
        return sorted(status.getPath().getParent().getName() for status in system.globStatus(pattern) or [])


class IndexStore:
    def __init__(self, spark: SparkSession, root: str, lease_seconds: float = LEASE_SECONDS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark)
        self.lease_seconds = lease_seconds
        self._listed: dict = {}

    @property
    def catalog_path(self) -> str:
        return f"{self.root}/_catalog"

    def catalog(self) -> DataFrame:
        if not self.folder.names(f"{self.catalog_path}/*"):
            return self.spark.createDataFrame([], CATALOG_SCHEMA)
        return self.spark.read.schema(CATALOG_SCHEMA).parquet(f"{self.catalog_path}/*/*")

    def newest(self, name: str) -> dict | None:
        """The latest row of one name, dropped or not."""
        versions = self.folder.committed(f"{self.catalog_path}/{name}")
        if not versions:
            return None
        row = self.spark.read.schema(CATALOG_SCHEMA).parquet(f"{self.catalog_path}/{name}/{versions[-1]}").first()
        return row.asDict()

    def append_entry(self, entry: dict) -> dict:
        """Commit the next version of an index.

        FileExistsError if another writer has committed it, or claimed it within the lease; LeaseLost if this one was
        so slow that another took over.
        """
        name, version = entry["index_name"], (entry.get("version") or 0) + 1
        claims, attempt = f"{self.root}/_claims/{name}/{version:012d}", self._next_attempt(name, version)
        if not self.folder.create(f"{claims}/{attempt:03d}"):
            raise FileExistsError(claims)
        if self._committed(name, version):
            raise FileExistsError(claims)
        # The attempt leads the uid, so that of two rows of one version the higher attempt counts.
        entry = {**entry, "version": version, "uid": f"{attempt:03d}-{new_uid()}"}
        self._require_lease(claims, attempt)
        self._write_entry(entry, f"{self.catalog_path}/{name}/{version:012d}-{attempt:03d}")
        self._require_lease(claims, attempt)
        return entry

    def _write_entry(self, entry: dict, path: str) -> None:
        self.spark.createDataFrame([entry], CATALOG_SCHEMA).coalesce(1).write.parquet(path)

    def _committed(self, name: str, version: int) -> bool:
        return any(v.startswith(f"{version:012d}-") for v in self.folder.committed(f"{self.catalog_path}/{name}"))

    def _next_attempt(self, name: str, version: int) -> int:
        """0, or one more than an attempt whose lease has run out."""
        claims = f"{self.root}/_claims/{name}/{version:012d}"
        attempts = self.folder.names(claims)
        if not attempts:
            return 0
        if self._committed(name, version) or self.folder.age(f"{claims}/{attempts[-1]}") < self.lease_seconds:
            raise FileExistsError(claims)
        return int(attempts[-1]) + 1

    def _require_lease(self, claims: str, attempt: int) -> None:
        newest = self.folder.names(claims)[-1]
        if int(newest) != attempt:
            raise LeaseLost(f"another writer took over {claims} as attempt {newest}; read the catalogue and try again")

    def update_entry(self, entry: dict, changes: dict, unless: str | None = None) -> dict:
        """Commit changes on top of the newest version of this index.

        With ``unless`` nothing is written if that field has a value by then. Waits for other writers, for a
        dead one as long as its lease.
        """
        while True:
            newest = self.newest(entry["index_name"])
            if newest is None or newest["dropped"] or newest["index_uid"] != entry["index_uid"]:
                raise LookupError(f"no index named {entry['index_name']!r}")
            if unless is not None and newest[unless] is not None:
                return newest
            try:
                return self.append_entry({**newest, **changes})
            except FileExistsError:
                time.sleep(_CLAIM_POLL)

    @contextmanager
    def training_mark(self, entry: dict) -> Iterator[None]:
        """A mark that says that this index is being trained, renewed until the training ends."""
        mark, ended = f"{self.root}/_training/{entry['index_name']}/{new_uid()}", threading.Event()
        self.folder.create(mark)

        def renew() -> None:
            while not ended.wait(self.lease_seconds / 4):
                self.folder.renew(mark)

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            ended.set()
            keeper.join()
            self.folder.delete(mark)

    def running_trainings(self) -> list[tuple[str, int]]:
        """Names of the indexes in training and how many trainings of each; marks that were not renewed are dead."""
        base, found = f"{self.root}/_training", []
        for name in self.folder.names(base):
            alive = sum(self._renewed(f"{base}/{name}/{mark}") for mark in self.folder.names(f"{base}/{name}"))
            found += [(name, alive)] if alive else []
        return found

    def _renewed(self, mark: str) -> bool:
        try:
            return self.folder.age(mark) < self.lease_seconds
        except Py4JJavaError:  # it ended meanwhile
            return False

    def index_path(self, entry: dict) -> str:
        return f"{self.root}/{entry['index_name']}/{entry['index_uid']}"

    def log_path(self, entry: dict) -> str:
        return f"{self.index_path(entry)}/log"

    def batches(self, entry: dict) -> list[str]:
        return self.folder.committed(self.log_path(entry))

    def read_log(self, entry: dict, batches: list[str]) -> DataFrame:
        paths = [f"{self.log_path(entry)}/{name}" for name in batches]
        schema = log_schema(entry["encrypted"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else empty_frame(self.spark, schema)

    def read_snapshot(self, entry: dict) -> DataFrame | None:
        """The compacted items with their ``bucket``; its generations and buckets are partition filters."""
        if not entry["parts"]:
            return None
        base = self.items_path(entry)
        # No file of a generation is ever rewritten: the folders are listed once for a state of the catalogue.
        state = ([(p["gen"], tuple(p["buckets"])) for p in entry["parts"]], entry["buckets"], entry["encrypted"])
        held, rows = self._listed.get(base, (None, None))
        if held != state:
            rows = self._generations(entry, base)
            self._listed[base] = (state, rows)
        return rows

    def _generations(self, entry: dict, base: str) -> DataFrame:
        schema = item_schema(entry["encrypted"]) + ", gen string, bucket int"
        with few_listing_tasks(self.spark):
            rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/gen={p['gen']}" for p in entry["parts"]])
        if any(len(p["buckets"]) < entry["buckets"] for p in entry["parts"]):
            live = [(F.col("gen") == p["gen"]) & in_buckets(p["buckets"]) for p in entry["parts"]]
            rows = rows.filter(reduce(Column.__or__, live))
        return as_bucketed(rows.drop("gen"), entry["buckets"])

    def items_path(self, entry: dict) -> str:
        return f"{self.index_path(entry)}/items"

    def snapshot_size(self, entry: dict) -> int:
        """About the bytes of the living buckets: each generation's by the share of its buckets that live."""
        base, total = self.items_path(entry), 0
        for part in entry["parts"] or []:
            path = f"{base}/gen={part['gen']}"
            written = sum(name.startswith("bucket=") for name in self.folder.names(path))
            total += self.folder.size(path) * min(1.0, len(part["buckets"]) / max(1, written))
        return int(total)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders that are listed meanwhile are listed by a bounded number of tasks, each taking many."""
    with _LISTING_LOCK:
        before = spark.conf.get(_LISTING_CONF)
        spark.conf.set(_LISTING_CONF, str(min(int(before), _LISTING_TASKS)))
        try:
            yield
        finally:
            spark.conf.set(_LISTING_CONF, before)


def new_uid() -> str:
    return uuid.uuid4().hex


def item_schema(encrypted: list[str]) -> str:
    kinds = [f"{name} {'binary' if name in encrypted else kind}" for name, kind in PLAIN_KINDS.items()]
    return ", ".join(["id string", *kinds])


def log_schema(encrypted: list[str]) -> str:
    return item_schema(encrypted) + ", op string, seq bigint, uid string"


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    fields = [part.strip().split(" ", 1) for part in schema.split(",")]
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])


def next_seq(batches: list[str]) -> int:
    """One more than the greatest sequence number among the batch names."""
    return 1 + max((int(name.split("-", 1)[0]) for name in batches), default=0)


def known_seq(batches: list[str], mark: str | None) -> int | None:
    """The number under which a marked change set was written, if it was."""
    return next((int(name.split("-", 1)[0]) for name in batches if mark and name.split("-", 1)[1] == mark), None)


def write_changes(
    changes: DataFrame,
    log_path: str,
    seq: int,
    uid: str,
    encrypted: list[str] | None = None,
    key_df: DataFrame | None = None,
) -> str:
    """Write ``(id, vector, contents, metadata, op)`` as one batch directory.

    Every row gets ``seq`` unless ``changes`` brings its own. The directory is named by
    ``seq`` and ``uid``; writing the same pair again replaces it, which is what a
    replayed micro-batch needs.
    """
    name = f"{seq:020d}-{uid}"
    order = F.col("seq") if "seq" in changes.columns else F.lit(seq)
    rows = changes.select("id", *PLAIN_KINDS, "op", order.cast("bigint").alias("seq"), F.lit(uid).alias("uid"))
    if encrypted:
        rows = encrypt_columns(rows, encrypted, key_df)
    rows.write.mode("overwrite").parquet(f"{log_path}/{name}")
    return name
