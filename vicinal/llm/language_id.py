"""Language identification: sparse logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from sys import maxunicode

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import text_slices

#: Hashed n-gram features, and the longest n-gram.
FEATURES, LONGEST = 1 << 15, 3
#: Bound of the labelled rows that the classifier is fitted on; every language has at least one.
MAX_ROWS = 2_000
#: Languages whose weights are looked up at once.
LANGUAGES_AT_ONCE = 64
#: Rows of a batch that get a feature matrix at once.
ROWS_AT_ONCE = 256
#: Name for texts without a letter.
UNDETERMINED = "und"
#: Follow-the-regularised-leader: step, smoothing, lasso and ridge strength, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.05, 4
#: Factor that brings mean TF-IDF weights to the order of one.
SCALE = 40.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(maxunicode + 1)])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts in lower case, anything else 0, and where each text begins.

    Two zeros stand before every text and after the last, so an n-gram that begins in the part of a text,
    zeros included, has letters of that text alone.
    """
    lower = [t.lower() for t in texts]
    points = np.frombuffer("\0\0".join(["", *lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 2 for t in lower])
    return np.where(_letters()[points], points, 0).astype(np.uint32), starts


def _features(codes: np.ndarray) -> list[np.ndarray]:
    """For n = 1 .. LONGEST the feature of the n-gram at every place; without letters it is ``FEATURES``."""
    found, running, any_letter = [], np.zeros(len(codes), np.uint32), np.zeros(len(codes), bool)
    for n in range(LONGEST):
        ahead = codes[n:]
        running = running[: len(ahead)] * np.uint32(0x01000193) + ahead * np.uint32(0x9E3779B1) + np.uint32(n + 1)
        any_letter = any_letter[: len(ahead)] | (ahead > 0)
        mixed = (running ^ (running >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        mixed = (mixed ^ (mixed >> np.uint32(13))) % np.uint32(FEATURES)
        found.append(np.where(any_letter, mixed, FEATURES).astype(np.int32))
    return found


def _grouped(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batch, column):
        for first in range(0, part.num_rows, ROWS_AT_ONCE):
            yield part.slice(first, ROWS_AT_ONCE)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("_text").to_pylist()]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each feature occurs, and the number of texts.

    Every task adds up its own texts; at most ``FEATURES + 1`` sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for part in _grouped(batch, "_text"):
                rows = part.num_rows
                codes, starts = _codes(_texts(part))
                row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(starts))
                seen = np.zeros((rows, FEATURES + 1), bool)
                for features in _features(codes):
                    seen[row, features[: len(row)]] = True
                seen[:, FEATURES] = True
                sums += seen.sum(axis=0)
        kept = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sums[kept], pa.int64())], ["feature", "n"])

    counted = texts.mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros(FEATURES + 1, np.int64)
    totals[counted["feature"].to_numpy()] = counted["n"].to_numpy()
    return totals[:FEATURES], int(totals[FEATURES])


def sample_vectors(sample: DataFrame) -> pd.DataFrame:
    """``(lang, features, counts)`` of every sampled text: its n-grams and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                part = batch.slice(n, 1)
                found = np.concatenate(_features(_codes(_texts(part))[0]))
                features, counts = np.unique(found[found < FEATURES], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"), part.column("_order"), pa.array([features.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    ],
                    ["lang", "_order", "features", "counts"],
                )

    vectors = sample.mapInArrow(run, "lang string, _order bigint, features array<int>, counts array<int>")
    return vectors.toPandas().sort_values(["_order", "lang"], kind="stable").reset_index(drop=True)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (FEATURES + 1, languages), times the inverse document frequency; the last row is 0
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        codes, starts = _codes(texts)
        logits = np.zeros((len(texts), len(self.languages)))
        grams = np.zeros(len(texts))
        for features in _features(codes):
            places = np.minimum(starts[:-1], len(features) - 1)
            for k in range(0, len(self.languages), LANGUAGES_AT_ONCE):
                some = slice(k, k + LANGUAGES_AT_ONCE)
                logits[:, some] += np.add.reduceat(self.weights[features, some], places, axis=0, dtype=np.float64)
            grams += np.add.reduceat(features < FEATURES, places, dtype=np.int64)
        has_letter = grams > 0
        logits = logits / np.maximum(grams, 1)[:, None] + self.bias
        shares = _softmax(logits / self.temperature)
        best = shares.argmax(axis=1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter)]
        return names, np.where(has_letter, shares[np.arange(len(texts)), best], 0.0).tolist()


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``PASSES`` passes of per-coordinate follow-the-regularised-leader."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))  # the last row is the bias

    def leader(at: np.ndarray) -> np.ndarray:
        lasso = np.where(at == FEATURES, 0.0, L1)[:, None]
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - lasso, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(PASSES):
        for features, values, label in rows:
            at, x = np.append(features, FEATURES), np.append(values, 1.0)
            w = leader(at)
            wrong = _softmax(x @ w)
            wrong[label] -= 1.0
            g = x[:, None] * wrong
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    every = leader(np.arange(FEATURES + 1))
    return every[:FEATURES], every[FEATURES]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on rows the weights were not fitted on."""
    if not len(labels):
        return 1.0
    tried = np.geomspace(0.05, 20.0, 121)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def fit_languages(labelled: DataFrame, text_col: str, lang_col: str, order_col: str, max_rows: int = MAX_ROWS) -> LanguageModel:
    """Fit on a sample of at most about ``max_rows`` labelled rows, spread evenly over the languages.

    Every language takes part: with more languages than ``max_rows`` there is a row of each. Document frequencies count all labelled rows; only the classifier sees a sample, chosen by a hash of
    ``order_col``. Rows with a null text or language are left out. Without any row the model knows no
    language and calls every text undetermined.
    """
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("_text"), F.col(lang_col).alias("lang"), F.xxhash64(order_col).alias("_order")
    )
    draw = F.xxhash64("_order", F.lit(1)).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least")).collect()
    if not sizes:
        return LanguageModel([], np.zeros((FEATURES + 1, 0)), np.zeros(0), 1.0)
    languages = sorted(r["lang"] for r in sizes)
    quota = max(1, max_rows // len(languages))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], max(r["least"], min(1.0, quota / r["n"])))])
    chosen = rows.filter(draw <= share[F.col("lang")])

    counts, total = document_frequencies(rows.select("_text"))
    idf = np.log((1.0 + total) / (1.0 + counts)) + 1.0
    vectors = sample_vectors(chosen)
    examples = []
    for lang, features, found in zip(vectors["lang"], vectors["features"], vectors["counts"]):
        features, found = np.asarray(features), np.asarray(found, np.float64)
        if len(features):
            examples.append((features, SCALE * found / found.sum() * idf[features], languages.index(lang)))
    # The first text of a language is never held back, so that none goes unlearnt.
    seen: set[int] = set()
    firsts = [not (e[2] in seen or seen.add(e[2])) for e in examples]
    fitted = [e for n, e in enumerate(examples) if n % 5 or firsts[n]]
    held = [e for n, e in enumerate(examples) if not n % 5 and not firsts[n]]
    weights, bias = train_ftrl(fitted, len(languages))
    logits = np.array([x @ weights[at] + bias for at, x, _ in held]).reshape(len(held), len(languages))
    temperature = calibrate(logits, np.array([y for _, _, y in held], np.int64))
    scaled = np.vstack([weights * idf[:, None] * SCALE, np.zeros((1, len(languages)))])
    return LanguageModel(languages, scaled.astype(np.float32), bias, temperature)


def predict_languages(docs: DataFrame, text_col: str, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``.

    The score is the calibrated probability of the predicted language, 0 for undetermined texts: null, empty
    or without a letter. Whole texts are read. Repeated rows are judged alike; an empty table stays empty.
    ``docs`` must not have columns of the two names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            names, scores = [], []
            table = pa.RecordBatch.from_arrays([pa.array(batch, pa.string(), from_pandas=True)], ["_text"])
            for part in _grouped(table, "_text"):
                texts = _texts(part)
                if model.languages:
                    more, likely = model.predict(texts)
                else:
                    more, likely = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                names += more
                scores += likely
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    judged = docs.withColumn("_judged", judge(F.col(text_col)))
    return judged.select("*", "_judged.lang_pred", "_judged.score").drop("_judged")


def held_out(id_col: str) -> Column:
    """True for the third of all ids that nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """All columns of ``docs`` and ``held_out, lang_pred, score``, learnt from the rows that are not held out."""
    known = docs.filter(~held_out(id_col))
    model = fit_languages(known, text_col, lang_col, id_col)
    return predict_languages(docs.withColumn("held_out", held_out(id_col)), text_col, model)
