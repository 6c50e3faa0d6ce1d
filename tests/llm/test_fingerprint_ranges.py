"""Ranges of fingerprints where one id, or none, stands on many rows."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from vicinal.llm import fingerprints
from vicinal.llm.fingerprints import Fingerprint, Ranges, fingerprint_neighbours, ranges_for


def _documents(spark):
    rng = random.Random(5)
    rows = [(None, f"none {n} " + "ab " * rng.randint(0, 20)) for n in range(120)]
    rows += [(7, f"seven {n} " + "cd " * rng.randint(0, 20)) for n in range(120)]
    rows += [(rng.randint(-50, 50), f"other {n}") for n in range(120)] + [(None, None), (7, ""), ((1 << 63) - 1, "last"), (-(1 << 63), "first")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


def test_null_and_frequent_ids_are_split_and_neighbours_stay_right(spark, monkeypatch):
    docs = _documents(spark)
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 400)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    order = sorted(keyed, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]), reverse=True)
    expected = []
    for n, row in enumerate(order):
        after, half = order[(n + 1) % len(order)]["text"], len(row["text"]) // 2
        edited = row["text"][: len(row["text"]) - half] + after[:half]
        own = Fingerprint(row["text"])
        expected.append((row["doc_id"], own.n, hashlib.sha256(edited.encode()).hexdigest(), str(own), own.likeness(Fingerprint(after))))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "near_next"]
    got = fingerprint_neighbours(docs, "doc_id", "text").select(*columns).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got)


def test_no_range_holds_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 400)
    rows = _documents(spark).select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text")).withColumn("_order", F.xxhash64("_text"))
    ranges, table = ranges_for(rows), rows.toPandas()
    ids = np.array([0 if i is None else i for i in (r["_id"] for r in rows.collect())], np.int64)
    held = np.bincount(ranges.of(ids, table["_id"].isna().to_numpy(), table["_order"].to_numpy()), minlength=ranges.total)
    size = sum(len(t.encode()) for t in table["_text"])
    assert ranges.total >= size // 400 and held.max() <= 6 * len(table) / ranges.total and held.sum() == len(table)


def test_ranges_ascend_with_id_and_hash():
    ranges = Ranges([3.0, 5.0, 5.0, 5.0, 9.0], 2)
    top = (1 << 63) - 1
    keys = [(0, True, -top), (0, True, top), (-4, False, 0), (3, False, 0), (5, False, -top), (5, False, 0), (5, False, top), (6, False, -top), (9, False, 0)]
    ids, missing, orders = (np.array(x) for x in zip(*keys))
    assert ranges.of(ids, missing, orders).tolist() == [0, 1, 2, 3, 4, 5, 6, 7, 8] and ranges.total == 9
