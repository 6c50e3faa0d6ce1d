"""Benchmark questions in documents, also with other numbers, names and units."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinal.llm.common import BITMAP_BITS, stored, text_bytes, text_slices
from vicinal.llm.word_hashes import windows, word_hashes, word_places

#: Words of a template window, and how many of them must be words themselves, not placeholders.
WINDOW, LEAST_WORDS = 8, 4
#: So many windows of an item, or half of them if that is less, make a document contaminated: 13 words in a row.
ENOUGH = 6
#: Items of fewer words have no template; they are looked for word by word.
SHORTEST = 5
#: How sentence beginnings are read in a window: as words, as names, either way the same; or all words as they are.
AS_WORDS, AS_NAMES, ALIKE, EXACT = 0, 1, 2, 3

#: Units that follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound "
    "pounds lb lbs ounce ounces oz ml l liter liters litre litres gallon gallons second seconds sec s minute minutes min "
    "hour hours h day days week weeks month months year years dollar dollars cent cents euro euros usd eur percent "
    "degree degrees meter meters metre metres kilometer kilometers kilometre kilometres"
).split()
#: Numbers written as words.
NUMBERS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()
_NUMBER, _UNIT, _NAME = (np.uint64(k) for k in (1, 2, 3))
_EXACT_SALT = np.uint64(0x5DEECE66D1CE4E5B)


def _hashes_of(words: list[str]) -> np.ndarray:
    data, rows = text_bytes(pa.array(words))
    return np.sort(word_hashes(data, rows[:-1], rows[1:]))


_UNIT_HASHES, _NUMBER_HASHES = _hashes_of(UNITS), _hashes_of(NUMBERS)


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _single_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where letters of scripts without blanks begin and end, each a word; and the bytes of their punctuation.

    Thai, Lao, Burmese, Khmer, kana, bopomofo and Han letters; U+3000 to U+303F and full-width signs.
    """
    leads = np.flatnonzero(data >= 0xE0)
    lead, second, third = data[leads], *(data[np.minimum(leads + k, len(data) - 1)] for k in (1, 2))
    letter = (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    letter |= (lead == 0xE1) & ((second >= 0x80) & (second <= 0x81) | (second == 0x82) & (third <= 0x9F) | (second >= 0x9E) & (second <= 0x9F))
    letter |= (lead == 0xE3) & (second >= 0x81) | (lead >= 0xE4) & (lead <= 0xE9)
    letter |= (lead == 0xEF) & (second >= 0xA4) & (second <= 0xAB) | (lead == 0xF0) & (second >= 0xA0)
    wide = (second == 0xBC) & ((third <= 0x8F) | (third >= 0x9A) & (third <= 0xA0) | (third >= 0xBB))
    wide |= (second == 0xBD) & ((third == 0x80) | (third >= 0x9B) & (third <= 0xA5))
    signs = leads[(lead == 0xE3) & (second == 0x80) | (lead == 0xEF) & wide]
    letters = leads[letter]
    cuts = np.concatenate([letters, letters + np.where(data[letters] >= 0xF0, 4, 3)])
    return np.minimum(cuts, len(data)), (signs[:, None] + np.arange(3)).ravel()


def template(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of all texts: the word's hash, its template hash, the same with names at sentence beginnings, and
    the first word of each text.

    Words are runs of letters and digits, and single letters of scripts without blanks; a dot or comma between digits
    belongs to the number, other ASCII and full-width punctuation separates. A word that begins with a digit, and a
    number word, becomes the number placeholder; a unit right after one the unit placeholder; a capitalised word the
    name placeholder, one that begins a sentence only in the second template.
    """
    data, rows = text_bytes(texts)
    if not len(data):
        return *(np.zeros(0, np.uint64) for _ in range(3)), np.zeros(len(rows), np.int64)
    digit = (data >= 48) & (data <= 57)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    inside = digit | upper | lower | (data >= 128)
    point = (data == 46) | (data == 44)
    inside[1:-1] |= point[1:-1] & digit[:-2] & digit[2:]
    cuts, signs = _single_letters(data)
    inside[signs] = False
    starts, ends, first = word_places(inside, rows, cuts)
    words = word_hashes(data, starts, ends)
    number = digit[starts] | _within(words, _NUMBER_HASHES)
    after_number = np.zeros(len(words), bool)
    after_number[1:] = number[:-1]
    # Sentences end at . ! ? : and line ends; a text begins one.
    stops = np.zeros(len(data) + 1, np.int64)
    np.cumsum((point & (data == 46)) | (data == 33) | (data == 63) | (data == 58) | (data == 10), out=stops[1:])
    begins = np.ones(len(words), bool)
    begins[1:] = stops[starts[1:]] > stops[ends[:-1]]
    begins[first[:-1][first[:-1] < len(words)]] = True
    after_number[first[:-1][first[:-1] < len(words)]] = False
    # Capital letters of two bytes: C3 80 to C3 9E.
    second = data[np.minimum(starts + 1, len(data) - 1)]
    long_upper = (data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    tail = np.minimum(starts + np.where(long_upper, 2, 1), len(data) - 1)
    goes_on = (lower[tail] | (data[tail] >= 128)) & (tail < ends)
    capital = (upper[starts] | long_upper) & goes_on
    found = []
    for name in (capital & ~begins, capital):
        hashes = np.where(name, _NAME, words)
        hashes = np.where(after_number & _within(words, _UNIT_HASHES), _UNIT, hashes)
        found.append(np.where(number, _NUMBER, hashes))
    return words, *found, first


def _windows(read: tuple, size: int, exact: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each way to read the texts: its number, its windows' hashes and places, and the hash of every word so read."""
    words, hashes, names, first = read
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    count = max(0, len(words) - size + 1)
    one_text = row[:count] == row[size - 1 :] if count else np.zeros(0, bool)
    if exact:
        yield EXACT, windows(words, size) ^ _EXACT_SALT, np.flatnonzero(one_text), words
        return
    differ = np.concatenate([[0], np.cumsum(hashes != names)])
    alike = differ[size:] == differ[:count] if count else np.zeros(0, bool)
    for way, some, own in ((ALIKE, hashes, alike), (AS_WORDS, hashes, ~alike), (AS_NAMES, names, ~alike)):
        plain = np.concatenate([[0], np.cumsum(some > 3)])
        literal = plain[size:] - plain[:count] if count else np.zeros(0, np.int64)
        at = np.flatnonzero(one_text & own & (literal >= min(LEAST_WORDS, size - 1)))
        if len(at):
            yield way, windows(some, size), at, some


def _item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``(item_id, size, way, place, hash, words, slots)``: a short item is one window, any other all its windows.

    An item without a template window, and one of few words, gives the windows of its words as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                read = template(batch.column("_text").slice(n, 1))
                words = read[0]
                size = min(window, len(words))
                if not size:
                    continue
                found = list(_windows(read, size, False)) if size >= min(SHORTEST, window) else []
                for way, hashes, at, some in found or _windows(read, size, True):
                    slots = np.where(some <= 3, some, 0).astype(np.uint64) if way != EXACT else np.zeros_like(words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("_item").take(pa.array(np.full(len(at), n))), pa.array(np.full(len(at), size), pa.int32()),
                            pa.array(np.full(len(at), way), pa.int32()), pa.array(at, pa.int32()), pa.array(hashes[at].view(np.int64)),
                            _lists(words, at, size), _lists(slots, at, size),
                        ],
                        ["item_id", "size", "way", "place", "hash", "words", "slots"],
                    )

    kind = dict(items.dtypes)[item_col]
    return items.select(F.col(item_col).alias("_item"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"item_id {kind}, size int, way int, place int, hash bigint, words array<bigint>, slots array<bigint>"
    )


def _lists(values: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    flat = values.view(np.int64)[at[:, None] + np.arange(size)].ravel() if len(at) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * size, pa.int32()), pa.array(flat))


def _document_windows(docs: DataFrame, sizes: list[tuple[int, bool]], bits: np.ndarray) -> DataFrame:
    """``(_id, at, way, hash, said)``: the windows of all texts whose hash an item may have."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                read = template(part.column("_text"))
                words, first = read[0], read[-1]
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                for size, way, found, at, _ in ((size, *x) for size, exact in sizes for x in _windows(read, size, exact)):
                    place = found[at] % np.uint64(BITMAP_BITS)
                    word = shared.value[(place >> np.uint64(6)).astype(np.int64)]
                    kept = at[(word >> (place & np.uint64(63))) & np.uint64(1) == 1]
                    if len(kept):
                        rows = row[kept]
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column("_id").take(pa.array(rows)), pa.array(kept - first[rows], pa.int64()), pa.array(np.full(len(kept), way), pa.int32()),
                                pa.array(found[kept].view(np.int64)), _lists(words, kept, size),
                            ],
                            ["_id", "at", "way", "hash", "said"],
                        )

    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(run, f"_id {kind}, at bigint, way int, hash bigint, said array<bigint>")


def _item_bits(items: DataFrame) -> np.ndarray:
    # The number of bits divides 2^64, so the place is the same for the signed and the unsigned hash.
    place = F.pmod(F.col("hash"), F.lit(BITMAP_BITS))
    word = F.expr(f"shiftleft(1L, cast(pmod(hash, {BITMAP_BITS}) & 63 AS int))")
    words = items.select((place / 64).cast("int").alias("at"), word.alias("word")).groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    bits[words["at"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64).view(np.uint64)
    return bits


def contaminated(
    docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``(id, item_id, n_windows, item_windows, changed)`` for every document that holds a benchmark item.

    Numbers, units and names are placeholders; windows of ``window`` template words are joined by their hash. All
    windows at one distance between document and item form an alignment. It is consistent if each value of
    the item always stands for one value of the document; windows with placeholders count only in consistent
    alignments, others always. A document holds an item if ``ENOUGH`` of its windows, or half of
    them, are matched; ``changed`` tells that some placeholder has another value.

    Capitalised words that begin a sentence are read as words and as names, in alignments of their own. Items of fewer
    than five words, or without a window of enough words that are no placeholders, are held if all their words
    follow each other in the document. A shorter item than a window is one window. Null and
    empty texts match nothing, an empty table on either side gives an empty result. Rows with the same id are
    one document, null being an id like any other. Other columns are not read.
    """
    ours = stored(_item_windows(items, item_col, item_text_col, window), "items")
    totals = ours.groupBy("item_id").agg(
        F.count_distinct("place").alias("item_windows"), F.max(F.col("way") == EXACT).alias("exact")
    )
    # At most two for each size up to the window.
    sizes = sorted((r["size"], r["exact"]) for r in ours.select("size", (F.col("way") == EXACT).alias("exact")).distinct().collect())
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = stored(_document_windows(rows, sizes, _item_bits(ours)), "windows")

    pair = F.arrays_zip(F.col("slots").alias("kind"), F.col("words").alias("item"), F.col("said").alias("doc"))
    slots = F.filter(pair, lambda x: x["kind"] != 0)
    # Windows without a sentence beginning belong to both ways to read one.
    theirs, own = F.col("found.way"), F.col("ours.way")
    ways = F.when(own == EXACT, F.array(F.lit(EXACT))).when((theirs == AS_NAMES) | (own == AS_NAMES), F.array(F.lit(AS_NAMES))).when(
        (theirs == AS_WORDS) | (own == AS_WORDS), F.array(F.lit(AS_WORDS))
    ).otherwise(F.array(F.lit(AS_WORDS), F.lit(AS_NAMES)))
    matched = found.alias("found").join(ours.alias("ours"), "hash").select(
        "_id", "item_id", (F.col("at") - F.col("place")).alias("shift"), F.explode(ways).alias("way"), "place", slots.alias("slots")
    ).distinct()
    # Per alignment: the windows with and without placeholders, and which values stand for which.
    aligned = matched.groupBy("_id", "item_id", "shift", "way").agg(
        F.collect_set("place").alias("all"), F.collect_set(F.when(F.size("slots") == 0, F.col("place"))).alias("plain"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    values = F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x["item"])))
    consistent = F.size("slots") == F.size(values)
    # An exact copy is counted at one distance alone.
    counted = aligned.select(
        "_id", "item_id", F.when(F.col("way") == EXACT, F.col("shift")).alias("shift"), F.when(consistent, F.col("all")).otherwise(F.col("plain")).alias("places"),
        (consistent & F.exists("slots", lambda x: x["item"] != x["doc"])).alias("changed"),
    )
    held = counted.select("_id", "item_id", "shift", "changed", F.explode("places").alias("place")).groupBy("_id", "item_id", "shift").agg(
        F.count_distinct("place").alias("n_windows"), F.max("changed").alias("changed")
    ).groupBy("_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("changed").alias("changed"))
    enough = F.when(F.col("exact"), F.col("item_windows")).otherwise(F.least(F.lit(ENOUGH), F.ceil(F.col("item_windows") / 2)))
    return held.join(totals, "item_id").filter(F.col("n_windows") >= enough).select(
        F.col("_id").alias(id_col), "item_id", "n_windows", "item_windows", "changed"
    )
