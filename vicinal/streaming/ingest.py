"""Streams into and against an index, one micro-batch at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vicinal.operators.items import latest
from vicinal.sources.index_store import Folder, known_seq, next_seq, write_changes


def upsert_stream(
    stream: DataFrame,
    log_path: str,
    checkpoint: str,
    order_col: str | None = None,
    encrypted: list[str] | None = None,
    key_df: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream of ``(id, vector, contents, metadata, op)`` to a change log.

    Each micro-batch becomes one log batch under the next number of the log, as a batch write would; a
    replayed micro-batch overwrites its own directory and keeps its number, so a restart adds nothing
    twice. ``order_col`` says which change of an id wins within a micro-batch; it must be given unless ids
    are unique there. A stream that carries its own ``seq`` keeps it: the greatest one wins whatever order the
    changes arrive in. Rows are taken as they are: ``VectorIndex.upsert_stream`` checks them.
    """
    folder = Folder(stream.sparkSession)

    def append(batch: DataFrame, mark: str) -> None:
        changes = batch if order_col is None else latest(batch, [order_col])
        known = folder.committed(log_path)
        write_changes(changes, log_path, known_seq(known, mark) or next_seq(known), mark, encrypted, key_df)

    return stream_batches(stream, append, checkpoint, available_now)


def stream_batches(stream: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    """Hand every micro-batch to ``write`` with a mark that is the same when it is replayed."""
    source = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    return _start(stream, lambda batch, batch_id: write(batch, f"stream-{source}-{batch_id}"), checkpoint, available_now)


def query_stream(
    stream: DataFrame,
    search: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Answer a stream of ``(query_id, query_vector)`` against a static table.

    ``search`` maps a batch of queries to hits, for example ``lambda q: knn_exact(items,
    q, 10)``. Every micro-batch writes its own directory below ``output``.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        search(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return _start(stream, answer, checkpoint, available_now)


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
