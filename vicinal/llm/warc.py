"""Web archives: written by Spark, indexed record by record, read back by byte ranges."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinal.llm.common import bitmap, in_bitmap, stored
from vicinal.session import shared_dir

#: Payloads of fewer bytes are never written as revisits.
LEAST_BYTES = 1000
#: Records of one archive file at most.
RECORDS = 100_000
#: Bytes that one range spans at most (a longer record alone), and the gap up to which neighbours are read together.
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: Bytes of records that a task reads back.
TASK_BYTES = 64 << 20
#: Bytes that are looked at together while records are indexed, and that a batch of records holds.
BLOCK_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
#: Fixed values of the format.
END, LINE = b"\r\n\r\n", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

INDEX = "archive string, offset bigint, length bigint, key string, url string, record_type string, refers_to string, payload_digest string, payload_bytes bigint"
RECORD = f"{INDEX}, payload binary"


def _one_line(text: Column) -> Column:
    """Line ends would end a header: they are written as in a url."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _uuid(*parts: Column) -> Column:
    drawn = F.md5(F.concat_ws("#", *parts))
    pieces = [F.substring(drawn, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def revisits_of(digests: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``(key, digest, refers_to)``: rows whose payload of ``least`` bytes or more also has a greater key.

    ``digests`` has ``key, digest, bytes``. Null is less than every key.
    """
    long = digests.filter(F.col("bytes") >= least).select("key", "digest")
    greatest = long.groupBy("digest").agg(F.max("key").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return long.join(greatest, "digest").filter(~F.col("key").eqNullSafe(F.col("refers_to"))).select("key", "digest", "refers_to").distinct()


def _record(revisit: Column) -> Column:
    """The text of a record; the line ends between two records are the writer's."""
    http = F.concat_ws(LINE, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")), F.lit(LINE))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))

    head = F.concat_ws(
        LINE, F.lit("WARC/1.1"), F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        field("WARC-Record-ID", _uuid(F.coalesce(F.col("key").cast("string"), F.lit("-")), F.col("digest"), F.coalesce("url", F.lit("-")))),
        field("WARC-Date", F.lit(DATE)), field("WARC-Target-URI", _one_line(F.col("url"))), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("Source-Key", _one_line(F.col("key").cast("string"))), F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, field("Refers-To-Key", _one_line(F.col("refers_to").cast("string")))),
        F.lit("Content-Type: application/http; msgtype=response"), field("Content-Length", size.cast("string")), F.lit(LINE),
    )
    return F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))


def write_archives(pages: DataFrame, key: str, url: str, payload: str, least: int = LEAST_BYTES, records: int = RECORDS) -> str:
    """Write a record for every row and return the folder of the archives.

    Of rows with equal payloads of ``least`` bytes or more, those with the greatest key are responses and the others
    revisit them, without the payload; all other rows are responses. A null payload is empty; a null key or url
    has no header field. Every file is a sequence of WARC 1.1 records: Spark's text writer ends each with the two
    line ends that the format asks for, and its committer leaves no half-written file after a lost executor.

    Payloads stay in the partition that read them: only rows that a bit array of fixed size lets through are
    joined with the revisits.
    """
    whole = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), whole.alias("payload"), F.sha1(whole).alias("digest"), F.octet_length(whole).cast("long").alias("bytes"))
    digests = stored(rows.select("key", "digest", "bytes"), "digests")
    revisits = stored(revisits_of(digests, least), "revisits")
    named = F.xxhash64("key", "digest")
    marks = bitmap(revisits.select(named.alias("mark")), "mark").scalar()
    marked = rows.withColumn("mark", named)
    maybe = in_bitmap(marks, "mark")
    target = revisits.select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), F.col("refers_to"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest"))
    hits = marked.filter(maybe).join(target, same, "left").select(_record(F.col("refers_to").isNotNull()).alias("value"))
    no_target = F.lit(None).cast(pages.schema[key].dataType)
    others = marked.filter(~maybe).withColumn("refers_to", no_target).select(_record(F.lit(False)).alias("value"))
    path = shared_dir(pages.sparkSession, "warc")
    others.unionByName(hits).write.option("lineSep", END.decode()).option("maxRecordsPerFile", records).text(path)
    return path


class ArchiveFile:
    """Byte ranges of one file, through the file system that its path names."""

    def __init__(self, path: str):
        parts = urlparse(path)
        if parts.scheme in ("", "file"):
            system, place = pa.fs.LocalFileSystem(), path[len("file:"):] if parts.scheme else path
            place = "/" + place.lstrip("/")
        else:
            system, place = pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        self.file = system.open_input_file(place)
        self.size = self.file.size()
        self.start, self.block = 0, b""

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def near(self, offset: int, length: int) -> bytes:
        """The same for bytes that are asked for in ascending order, from blocks."""
        if offset < self.start or offset + length > self.start + len(self.block):
            self.start, self.block = offset, self.read(offset, max(length, BLOCK_BYTES))
        return self.block[offset - self.start : offset - self.start + length]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(LINE)
    return {name.strip().lower(): value.removeprefix(" ") for name, _, value in (line.partition(":") for line in lines[1:]) if name}


def _head_at(archive: ArchiveFile, offset: int) -> bytes:
    """The lines up to the first empty one, with it."""
    size = 4096
    while True:
        seen = archive.near(offset, min(size, archive.size - offset))
        end = seen.find(END)
        if end >= 0:
            return seen[: end + len(END)]
        if offset + size >= archive.size:
            raise ValueError("a record without end of header")
        size *= 2


def records_of(path: str) -> Iterator[tuple]:
    """The index rows of one archive: headers are read, payloads passed over."""
    archive, offset = ArchiveFile(path), 0
    while offset < archive.size:
        head = _head_at(archive, offset)
        own = _fields(head)
        block = int(own["content-length"])
        http = _fields(_head_at(archive, offset + len(head)))
        length = len(head) + block + len(END)
        yield (
            path, offset, length, own.get("source-key"), own.get("warc-target-uri"), own["warc-type"], own.get("refers-to-key"),
            own["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"]),
        )
        offset += length


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded bytes; the last column may hold a payload."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + (len(row[-1]) if isinstance(row[-1], bytes) else 0)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive, offset, length, key, url, type, target, digest and payload bytes of every record, stored as a table.

    A task goes through whole files, whose records are bounded; it passes over payloads.
    """
    schema = _arrow(INDEX)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = (p for batch in batches for p in batch.column("path").to_pylist())
        yield from _batches((row for p in paths for row in records_of(p)), schema)

    files = spark.read.format("binaryFile").load(path).select("path")
    return stored(files.mapInArrow(walk, INDEX), "warc-index")


def ranges_of(spans: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> Iterator[list[tuple[int, int]]]:
    """``(offset, length)`` sorted and coalesced: neighbours at most ``gap`` bytes apart, within ``most`` bytes."""
    run: list[tuple[int, int]] = []
    for offset, length in sorted(spans):
        if run and (offset - sum(run[-1]) > gap or offset + length - run[0][0] > most):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def _parsed(path: str, offset: int, record: bytes) -> tuple:
    end = record.index(END) + len(END)
    own = _fields(record[:end])
    block = record[end : end + int(own["content-length"])]
    http_end = block.index(END) + len(END)
    kind = own["warc-type"]
    return (
        path, offset, len(record), own.get("source-key"), own.get("warc-target-uri"), kind, own.get("refers-to-key"),
        own["warc-payload-digest"].removeprefix("sha1:"), int(_fields(block[:http_end])["content-length"]), block[http_end:] if kind == "response" else None,
    )


def read_records(selected: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records of the selected index rows, each with its payload (null in a revisit).

    The selection is grouped by file and stretch of ``most`` bytes, so a task's list is bounded; in each, sorted
    ranges are coalesced and read at once; the bytes of the selection say how many tasks there are. Repeated
    selections of a record return it once.
    """
    schema = _arrow(RECORD)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            path, archive = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["archive"] != path:
                        path = row["archive"]
                        archive = ArchiveFile(path)
                    for run in ranges_of([(s["offset"], s["length"]) for s in row["spans"]], gap, most):
                        start = run[0][0]
                        data = archive.read(start, sum(run[-1]) - start)
                        for offset, length in run:
                            yield _parsed(path, offset, data[offset - start : offset - start + length])

        yield from _batches(rows(), schema)

    tasks = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    dealt = selected.select("archive", F.floor(F.col("offset") / most).alias("stretch"), "offset", "length").repartition(tasks, "archive", "stretch")
    grouped = dealt.groupBy("archive", "stretch").agg(F.collect_set(F.struct("offset", "length")).alias("spans"))
    return grouped.select("archive", "spans").mapInArrow(fetch, RECORD)


def read_back(spark: SparkSession, path: str, key_type: str) -> DataFrame:
    """``(key, url, payload_bytes, payload_digest, record_type, refers_to)`` of all records of the archives.

    Bytes and digest of a response are those of the payload that was read; a revisit states those of its target.
    """
    records = read_records(index_archives(spark, path))
    whole = F.col("payload").isNotNull()
    return records.select(
        F.col("key").cast(key_type).alias("key"), "url", F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", F.col("refers_to").cast(key_type).alias("refers_to"),
    )
