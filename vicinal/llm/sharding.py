"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import numbered, stored

#: The hash gives 13 hex digits, 52 bits: exact as a double.
HASH_RANGE = float(1 << 52)


def _draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that depends on the key and the shard alone."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / HASH_RANGE


def rendezvous(key: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """The shard of a key, and its score: the shard with the greatest ``weight / -ln(draw)`` wins.

    A shard of weight 0 gets nothing. With one more shard only keys move for which the new one
    scores highest, and they move into it. A null key counts as the empty string.
    """
    if not weights or max(weights) <= 0:
        raise ValueError("at least one shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct((F.lit(float(w)) / -F.log(_draw(text, n))).alias("score"), F.lit(-n).alias("shard"))
        for n, w in enumerate(weights) if w > 0
    ]
    best = F.array_max(F.array(*scores))
    return (-best["shard"]).cast("int"), best["score"]


def shard(
    rows: DataFrame, key: str, weights: Sequence[float], grown_by: float | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``(key, shard, slot, grown_shard)`` and the columns in ``keep`` for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps. ``grown_shard`` is the shard after adding
    one of weight ``grown_by``; null without it. Repeated rows go to one shard and get a slot each.
    An empty table gives an empty result; other columns are dropped, so their names never clash.
    """
    own = F.col(key)
    placed, score = rendezvous(own, weights)
    new = F.lit(None).cast("int")
    if grown_by is not None:
        text = F.coalesce(own.cast("string"), F.lit(""))
        better = F.lit(float(grown_by)) / -F.log(_draw(text, len(weights))) > score
        new = F.when(better, F.lit(len(weights))).otherwise(placed).cast("int")
    table = stored(rows.select(own, placed.alias("shard"), new.alias("grown_shard"), *keep), "shards")
    return numbered(table, ["shard"], [key, *keep], "slot")
