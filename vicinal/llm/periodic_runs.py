"""Periodic runs of words, as maximal pairs of the LCP-interval tree of each text."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vicinal.llm.common import text_bytes, text_slices

#: A run has this many periods and words at least.
EXPONENT, LEAST_WORDS = 4, 6
#: Bytes of collapsed text that are gathered at once.
PIECE_BYTES = 4 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)
_RUN = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])


def word_bounds(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text number of every word ``[^\\x20\\x09-\\x0D]+``; ``rows`` has where each text begins and the end."""
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = rows[(rows > 0) & (rows < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(rows, starts, side="right") - 1


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, compared byte by byte."""
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    own = np.zeros(len(data) + 1, np.int8)
    np.add.at(own, starts, 1)
    np.add.at(own, ends, -1)
    packed = np.ascontiguousarray(data[np.cumsum(own[:-1]).astype(bool)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _least_depth(exponent: int, least: int) -> int:
    """The words that the two positions of a run's pair share at least."""
    return min(max((exponent - 1) * q, least - q) for q in range(1, least + 1))


class Suffixes:
    """The suffixes of all texts of a batch that repeat at least ``depth`` words within their own text.

    ``words`` holds the words of all texts, each text with a closing word of its own, and numbers of different
    texts never agree: a shared part never leaves its text. ``places`` are the suffixes in order, ``shared`` what
    each has in common with the one before it, 0 where a group begins.
    """

    def __init__(self, words: np.ndarray, closing: np.ndarray, depth: int):
        base = 1 << (depth.bit_length() - 1)
        places, group = self._sort(words, closing, base)
        text_order = np.argsort(places, kind="stable")
        before = np.full(len(places), -1, np.int64)
        before[1:][group[1:] == group[:-1]] = places[:-1][group[1:] == group[:-1]]
        shared = np.zeros(len(places), np.int64)
        shared[text_order] = self._common(words, places[text_order], before[text_order], base)
        self.places, self.shared = places, np.where(shared >= depth, shared, 0)

    @staticmethod
    def _sort(words: np.ndarray, closing: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix doubling; a suffix leaves as soon as it differs from all others. Groups share ``base`` words."""
        size = len(words)
        order = np.argsort(words, kind="stable")
        ranked = words[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if size else np.zeros(0, bool)
        heads = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        name = np.empty(size, np.int64)
        name[order] = heads
        todo = order[~(new & np.append(new[1:], True))]
        h = 1
        found = (todo, name[todo].copy()) if base == 1 else None
        while len(todo) or found is None:
            key = name[todo] * size + name[todo + h]
            order = np.argsort(key, kind="stable")
            todo, key = todo[order], key[order]
            old = name[todo]
            new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            group = np.concatenate(([True], old[1:] != old[:-1])) if len(key) else np.zeros(0, bool)
            at = np.arange(len(todo))
            name[todo] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
            todo = todo[~(new & np.append(new[1:], True))]
            h *= 2
            if h == base:
                found = (todo, name[todo].copy())
        places, group = found
        order = np.argsort(name[places], kind="stable")
        return places[order], group[order]

    @staticmethod
    def _common(words: np.ndarray, places: np.ndarray, before: np.ndarray, base: int) -> list[int]:
        """Words shared with the suffix before, in text order: of the next word's suffix at most one fewer."""
        sequence, out, h, last = words.tolist(), [], 0, -2
        for at, other in zip(places.tolist(), before.tolist()):
            if other < 0:
                h = 0
            else:
                h = max(h - 1, base) if at == last + 1 else base
                while sequence[at + h] == sequence[other + h]:
                    h += 1
            out.append(h)
            last = at
        return out

    def groups(self, exponent: int) -> Iterator[tuple[list[int], list[int]]]:
        """The subtrees in which two places can be as near as a run's pair must be."""
        if len(self.places) < 2:
            return
        number = np.cumsum(self.shared == 0) - 1
        firsts = np.flatnonzero(self.shared == 0)
        deepest = np.maximum.reduceat(self.shared, firsts)
        order = np.lexsort((self.places, number))
        gaps = np.diff(self.places[order], prepend=0)
        gaps[firsts] = np.iinfo(np.int64).max // exponent
        nearest = np.minimum.reduceat(gaps, firsts)
        ends = np.append(firsts[1:], len(self.places))
        for n in np.flatnonzero(nearest * (exponent - 1) <= deepest).tolist():
            yield self.places[firsts[n] : ends[n]].tolist(), self.shared[firsts[n] : ends[n]].tolist()


def _join(one: list[int], two: list[int], depth: int, words: Sequence[int], exponent: int, found: dict) -> list[int]:
    """Report the maximal pairs between two subtrees of an interval of ``depth`` words and join their lists.

    Each place of the shorter list looks its near ones up in the longer. Two places no farther apart than half the
    depth lie in one stretch of one period, so that all of them but the leftmost have the same word on their
    left: they are one class, and the leftmost another or the same. So the classes need no lists of their own,
    and looking at the leftmost decides. Pairs of one class are not maximal.
    """
    if len(one) < len(two):
        one, two = two, one
    reach = depth // (exponent - 1)
    for p in two:
        k = bisect_left(one, p - reach)
        if k == len(one) or one[k] > p + reach:
            continue
        leftmost, own = one[k], words[p - 1]
        if words[leftmost - 1] == own:
            continue
        near = [leftmost]
        if leftmost > p:
            near = one[k : bisect_left(one, p + reach + 1, k)]
        for r in near:
            start, period = min(p, r), abs(p - r)
            span = (start, start + period + depth)
            if period < found.get(span, period + 1):
                found[span] = period
    if 8 * len(two) < len(one):
        for p in two:
            insort(one, p)
        return one
    one += two
    one.sort()
    return one


def maximal_pairs(places: list[int], shared: list[int], words: Sequence[int], exponent: int, least: int) -> dict[tuple[int, int], int]:
    """``{(start, end): least period}`` of the runs below one subtree, bottom up.

    A maximal pair at distance q whose shared words are q * (exponent - 1) or more covers a stretch that no
    neighbour extends: it is a run as it stands. Its multiples of a period are pairs too; the least one stays.
    """
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, list[int]]] = []
    for n in range(1, len(places) + 1):
        depth = shared[n] if n < len(places) else 0
        carried = [places[n - 1]]
        while stack and stack[-1][0] > depth:
            inner, seen = stack.pop()
            carried = _join(seen, carried, inner, words, exponent, found)
        if stack and stack[-1][0] == depth:
            carried = _join(stack.pop()[1], carried, depth, words, exponent, found)
        stack.append((depth, carried))
    return {span: q for span, q in found.items() if span[1] - span[0] >= least}


def runs_of(numbers: np.ndarray, texts: np.ndarray, n_texts: int, exponent: int = EXPONENT, least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of all runs of every text, in order. ``texts`` has each word's text, ascending."""
    counts = np.bincount(texts, minlength=n_texts)
    begins = np.concatenate(([0], np.cumsum(counts + 1)))
    width = int(numbers.max()) + 1 if len(numbers) else 1
    words = np.empty(len(numbers) + n_texts, np.int64)
    closing = begins[1:] - 1
    words[np.arange(len(numbers)) + texts] = texts * width + numbers
    words[closing] = n_texts * width + np.arange(n_texts)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n_texts)]
    suffixes = Suffixes(words, closing, _least_depth(exponent, least))
    sequence = None
    for places, shared in suffixes.groups(exponent):
        sequence = words.tolist() if sequence is None else sequence
        for (start, end), period in maximal_pairs(places, shared, sequence, exponent, least).items():
            text = int(np.searchsorted(begins, start, side="right")) - 1
            runs[text].append((start - int(begins[text]), end - start, period))
    return [sorted(set(r)) for r in runs]


def _kept(runs: list[list[tuple[int, int, int]]], begins: np.ndarray, size: int) -> np.ndarray:
    """False for the words of a run behind its first period."""
    kept = np.ones(size, bool)
    for text, own in enumerate(runs):
        for start, length, period in own:
            kept[begins[text] + start + period : begins[text] + start + length] = False
    return kept


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: np.ndarray, n_texts: int) -> pa.Array:
    """The given words of every text, one blank between them."""
    follows = np.append(texts[1:] == texts[:-1], False)[: len(texts)]
    sizes = ends - starts + follows
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    out = np.empty(offsets[-1], np.uint8)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, side="right")) - 1)
        size = sizes[first:last]
        source = np.arange(offsets[last] - offsets[first]) + np.repeat(starts[first:last] - (offsets[first:last] - offsets[first]), size)
        out[offsets[first] : offsets[last]] = data[np.minimum(source, len(data) - 1)]
        first = last
    out[offsets[1:][follows] - 1] = 0x20
    ends_of = offsets[np.searchsorted(texts, np.arange(n_texts + 1))]
    return pa.Array.from_buffers(pa.string(), n_texts, [None, pa.py_buffer(ends_of.astype(np.int32)), pa.py_buffer(out)])


def _slice_runs(part: pa.RecordBatch, text: str, exponent: int, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    data, rows = text_bytes(part.column(text))
    starts, ends, texts = word_bounds(data, rows)
    runs = runs_of(word_numbers(data, starts, ends), texts, part.num_rows, exponent, least)
    counts = np.bincount(texts, minlength=part.num_rows)
    kept = _kept(runs, np.concatenate(([0], np.cumsum(counts))), len(starts))
    flat = np.array([run for own in runs for run in own], np.int64).reshape(-1, 3)
    items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(_RUN))
    lengths = np.concatenate(([0], np.cumsum([len(own) for own in runs]))).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(lengths), items, type=pa.list_(pa.field("element", _RUN, False)))
    return pa.array(counts.astype(np.int64)), spans, _collapsed(data, starts[kept], ends[kept], texts[kept], part.num_rows)


def find_runs(docs: DataFrame, id_col: str, text_col: str, exponent: int = EXPONENT, least: int = LEAST_WORDS) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row of ``docs``.

    A run is a stretch of words with smallest period q that is ``max(least, exponent * q)`` words or longer and
    that no neighbouring word extends. ``runs`` has start, length and period of each, by start, then period.
    ``collapsed`` are the words that are not in a run behind its first period, one blank between them. A null or
    empty text, or one of blanks alone, has no words, no runs and an empty collapsed text. Repeated rows give
    repeated rows, an empty table an empty result; other columns are dropped, so their names never clash. Every
    text is taken whole; a task holds 2 MB of texts or one longer text at once, and about 100 times the bytes of
    its words' numbers. ``exponent`` must be 3 or more.
    """
    if exponent < 3:
        raise ValueError("exponent must be 3 or more: nearer pairs have other than two classes")
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType(), False),
        T.StructField("runs", RUNS, False), T.StructField("collapsed", T.StringType(), False),
    ])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), *_slice_runs(part, "text", exponent, least)], names=["id", "n_words", "runs", "collapsed"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(each, schema)
