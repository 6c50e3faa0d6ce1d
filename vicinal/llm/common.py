"""Helpers the operators share: stored tables, text batches, bitmaps and gapless numbers."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vicinal.session import shared_dir

#: Bytes of text that a task holds in numpy arrays at once; a longer text is held alone.
SLICE_BYTES = 2 << 20
#: Bits of a filter bitmap. Its size is fixed: with more keys it lets more rows through, never fewer.
BITMAP_BITS = 1 << 23


#: Folders of the tables that each open ``scratch`` deletes at its end, the innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def stored(frame: DataFrame, label: str, keep: int = 0) -> DataFrame:
    """Write the rows to the shared folder and read them back, which ends their lineage; ``keep``: beyond so many ``scratch``, the innermost first."""
    spark = frame.sparkSession
    path = shared_dir(spark, label)
    for held in _SCRATCH.get()[::-1][int(keep) :][:1]:
        held.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored within are deleted at the end, and shuffle files let go of: what outlives them must be stored with ``keep``.

    Within another ``scratch`` what is kept lasts until that one ends.
    """
    held: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), held))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for name in held:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark deletes them once the driver has collected their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text, or one longer row."""
    ends = text_bytes(batch.column(column))[1]
    first, rows = 0, batch.num_rows
    while first < rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and where each begins (one more entry than texts); null is empty."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str, chunks: int = 256) -> DataFrame:
    """Add gapless numbers from 0 within each group.

    A group is numbered in ``chunks`` hash chunks whose sizes are summed first, so that no task sorts a
    whole group. ``rows`` is read twice: give a stored table.
    """
    drawn = F.conv(F.substring(F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in order])), 1, 8), 16, 10)
    cut = rows.withColumn("_chunk", F.pmod(drawn.cast("long"), F.lit(chunks)))
    sizes = cut.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*group, "_chunk").orderBy(*order)
    ranked = cut.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(starts, [*group, "_chunk"])
    return joined.withColumn(name, (F.col("_start") + F.col("_rank")).cast("long")).drop("_chunk", "_start", "_rank")


def bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """One row with ``words``, a bit array of fixed size in which the hash of every key is set."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    one = F.expr("shiftleft(1L, cast(_bit & 63 AS int))")
    words = (
        keys.select(place.alias("_bit"))
        .select((F.col("_bit") / 64).cast("int").alias("_at"), one.alias("_word"))
        .groupBy("_at").agg(F.bit_or("_word").alias("_word"))
    )
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("_at"))
    dense = every.join(words, "_at", "left").select("_at", F.coalesce("_word", F.lit(0)).alias("_word"))
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_word")))
    return dense.agg(F.transform(ordered, lambda x: x["_word"]).alias("words"))


def in_bitmap(words: Column, key: str, bits: int = BITMAP_BITS) -> Column:
    """False only if the key is certainly not in the bitmap."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    word = F.get(words, (place / 64).cast("int"))
    return F.call_function("shiftright", word, place.cast("int").bitwiseAND(63)).bitwiseAND(F.lit(1)) == 1
