"""Runs of words beside a check of all starts and periods."""

import hashlib
import random
import re

import pytest

from vicinal.llm.periodic_runs import find_runs
from vicinal.llm.queries import op11_periodic_runs, planted_periods


def brute_runs(words, exponent=4, least=6):
    """Every start and period, extended word by word; of one stretch the smallest period stays."""
    runs = {}
    for q in range(1, len(words)):
        start = 0
        while start + q < len(words):
            end = start + q
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(least, exponent * q):
                runs.setdefault((start, end), q)
            start = max(start + 1, end - q + 1) if end > start + q else start + 1
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, runs):
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in lost)


def texts_of(rng, count):
    out = []
    for _ in range(count):
        words = rng.choices("abcd", k=rng.choice([0, 1, 5, 30, 60]))
        for _ in range(rng.choice([0, 1, 3])):
            unit = rng.choices(["a", "b", "long", "é", "日本"], k=rng.choice([1, 1, 2, 3, 7]))
            at = rng.randint(0, len(words))
            words[at:at] = (unit * rng.randint(2, 12))[: rng.randint(1, 60)]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t \r\n", "\x0b"]) for w in words))
    return out


@pytest.mark.parametrize("exponent,least", [(4, 6), (3, 2), (5, 20)])
def test_runs_match_brute_force(spark, exponent, least):
    rng = random.Random(exponent)
    texts = [*texts_of(rng, 250), None, "", " \n ", "a" * 5, "x " * 5, "x " * 6, "a b " * 3 + "a", "a b " * 4, "  " * 9]
    frame = spark.createDataFrame([(n, t, "clash", 1) for n, t in enumerate(texts)], "doc_id bigint, text string, runs string, id bigint").repartition(3)
    rows = find_runs(frame, "doc_id", "text", exponent, least).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = split(texts[row["id"]])
        want = brute_runs(words, exponent, least)
        assert [tuple(r) for r in row["runs"]] == want, texts[row["id"]]
        assert row["n_words"] == len(words) and row["collapsed"] == collapsed(words, want)


def test_long_texts_and_large_runs(spark):
    """A run of 60,000 words, a long text of phrases with many neighbours, and copies of a text in one batch."""
    rng = random.Random(5)
    phrase = "one two three four five six"
    many = " ".join(f"{rng.randrange(10**6)} {phrase}" for _ in range(20_000))
    rows = [(1, "x " * 60_000), (2, "a b c " * 15_000 + "a"), (3, many), (4, many), (None, "y " * 7), (None, "y " * 7)]
    found = {}
    for r in find_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text").collect():
        found.setdefault(r["id"], []).append(([tuple(x) for x in r["runs"]], len(r["collapsed"].split())))
    assert found[1] == [([(0, 60_000, 1)], 1)] and found[2] == [([(0, 45_001, 3)], 3)]
    assert found[3] == found[4] == [([], 140_000)] and found[None] == [([(0, 7, 1)], 1)] * 2


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert find_runs(none, "doc_id", "text").collect() == []
    with pytest.raises(ValueError):
        find_runs(none, "doc_id", "text", exponent=2)


def test_query_matches_brute_force(spark, sf_dir):
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op11_periodic_runs(spark, sf_dir).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert len(got) == len(docs)
    for doc in docs:
        words, h = split(doc["text"]), zlib.crc32(str(doc["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs, row = brute_runs(words), got[doc["doc_id"]]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert row["collapsed_sha256"] == sha(collapsed(words, runs))


def test_planted_periods_of_odd_rows(spark):
    rows = [(n, "a b\tc") for n in range(100)] + [(n, None) for n in range(100)] + [(n, " ") for n in range(100)] + [(None, "a b")]
    planted = planted_periods(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(planted) == 301 and sum(r["text"] is None for r in planted) == 100 and any(r["text"] == "a a a" for r in planted)
