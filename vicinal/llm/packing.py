"""Packing of tokenised documents into sequences by bin completion."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vicinal.llm.common import numbered, stored, text_bytes, text_slices
from vicinal.llm.word_hashes import word_hashes, word_places
from vicinal.llm.word_index import WordIndex, beyond_latin, rows_with

# One task uses one core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Steps of the search over whole plans in all: fillings looked at and groups that best fit makes. A few seconds on the driver.
MAX_WORK = 1_000_000
#: Steps of one enumeration of fillings, and the undominated ones that a node branches over.
MAX_STEPS, ALTERNATIVES = 2_000, 8
#: Texts of other white space are encoded whole, and words of other characters by the tokenizer.
ODD_SPACE = regex.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u206f\u3000\ufeff]")
PLAIN_WORD = regex.compile(r"[!-;=-~\u00a1-\u00ff]+")
#: Fixed value: how the tokenizer cuts words.
WORD_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Bytes that letters of lower case do not use stand for a word's last byte.
LAST_BYTE = {**{b: bytes([b - 32]) for b in range(97, 123)}, **{b: bytes([b - 128]) for b in range(128, 192)}}
#: Digits and punctuation runs whose ids a worker remembers.
MAX_PARTS = 50_000


def merge_ranks(tokenizer: Tokenizer) -> dict[bytes, int]:
    """The tokens of letters as byte strings whose last byte tells whether the word ends there.

    With them any pair that forms a token may merge, the lowest id first. That equals the tokenizer's own
    merges if every token encodes as itself (a test shows it): where two tokens meet that form a third, all lower
    merges have been made, as they are when the third is encoded alone.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in shown}
    signs.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))})
    suffix, inner = "</w>", {*range(97, 123), *range(128, 192), *range(0xC2, 0xF5)}
    special = set(tokenizer.get_added_tokens_decoder())
    ranks = {}
    for token, rank in tokenizer.get_vocab().items():
        ends = token.endswith(suffix) and token != suffix
        values = [signs.get(c, -1) for c in (token[: -len(suffix)] if ends else token)]
        if rank in special or not values or not inner.issuperset(values) or ends and values[-1] not in LAST_BYTE:
            continue
        ranks[bytes(values[:-1]) + (LAST_BYTE[values[-1]] if ends else bytes(values[-1:]))] = rank
    return ranks


def _merger(ranks: dict[bytes, int]):
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


class WordEncoder:
    """The ids of whole texts from a tokenizer whose merges never cross white space.

    Texts are cut at blanks, tabs and line ends; the ids of a word are looked up by its 64-bit hash, or made.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = _merger(merge_ranks(self.tokenizer))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not all("<" in s for s in special):
            raise ValueError("special tokens need the sign <, which plain words lack")
        self.parts: dict[str, list[int]] = {}
        self.index = WordIndex(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used = self.words = 0

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        if not PLAIN_WORD.fullmatch(word):
            return self._library(word)
        ids = []
        for part in WORD_PARTS.findall(word.lower()):
            own = part.encode()
            last = LAST_BYTE.get(own[-1])
            if last is not None and part.isalpha():
                ids += self.merge(own[:-1] + last)
                continue
            known = self.parts.get(part)
            if known is None:
                known = self._library(part)
                if len(self.parts) < MAX_PARTS:
                    self.parts[part] = known
            ids += known
        return ids

    def _learn(self, words: list[bytes]) -> None:
        made, ends = [], []
        for word in words:
            made += self._word(word.decode())
            ends.append(len(made))
        while self.used + len(made) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.words + len(words) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.used : self.used + len(made)] = made
        self.ends[self.words + 1 : self.words + 1 + len(words)] = self.used + np.array(ends, np.int64)
        self.used += len(made)
        self.words += len(words)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text; null texts have none."""
        data, rows = text_bytes(texts)
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(texts)
        inside = ~((data == 32) | (data == 9) | (data == 10) | (data == 13))
        starts, ends, first = word_places(inside, rows)
        own = data.tobytes()
        at = self.index.look_up(word_hashes(data, starts, ends, exact_case=True), lambda n: own[starts[n] : ends[n]])
        begin = self.ends[at]
        sizes = self.ends[at + 1] - begin
        upto = np.cumsum(sizes)
        ids = self.ids[np.repeat(begin - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)]
        cut = np.concatenate([[0], upto])[first]
        odd = rows_with(beyond_latin(data), rows)
        return [
            np.array(self._library(texts[n].as_py()), np.uint32) if odd[n] and ODD_SPACE.search(texts[n].as_py()) else ids[a:b]
            for n, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist()))
        ]


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int, end_id: int) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: every text as ids, the end id behind it, cut at the capacity."""
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                rows, piece, start, length, sums = [], [], [], [], []
                for n, ids in enumerate(encoder.encode(part.column("_text"))):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at : at + capacity]
                        rows.append(n)
                        piece.append(k)
                        start.append(at)
                        length.append(len(own))
                        sums.append(zlib.crc32(own.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64()),
                    ],
                    [id_col, "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _sums(length: int, copies: int, sums: int, mask: int) -> int:
    """The sums in a bit set, with up to so many pieces of one length added."""
    step = 1
    while copies:
        taken = min(step, copies)
        sums |= sums << length * taken & mask
        copies -= taken
        step *= 2
    return sums


def _reachable(gap: int, lengths: list[int], counts: np.ndarray) -> list[int]:
    """For every place in the falling list, the sums up to ``gap`` of pieces from there on, as bits."""
    mask, sums, out = (1 << gap + 1) - 1, 1, [1]
    for n in reversed(lengths):
        sums = _sums(n, min(int(counts[n]), gap // n), sums, mask)
        out.append(sums)
    return out[::-1]


def best_filling(gap: int, counts: np.ndarray) -> list[int]:
    """Lengths, longest first, that leave the least of the gap unused.

    The sums that the pieces can reach are bit sets; of the fillings with the greatest sum the one with the
    longest pieces is taken, which dominates the others.
    """
    if gap and counts[gap]:
        return [gap]
    lengths = [n for n in np.flatnonzero(counts[: gap + 1])[::-1].tolist() if n]
    reach = _reachable(gap, lengths, counts)
    rest, filling = reach[0].bit_length() - 1, []
    for n, behind in zip(lengths, reach[1:]):
        copies = min(int(counts[n]), rest // n)
        while copies and not behind >> (rest - copies * n) & 1:
            copies -= 1
        filling += [n] * copies
        rest -= copies * n
    return filling


#: One sequence's lengths and the number of sequences that are filled so.
Filling = tuple[list[int], int]


def best_fit(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Best-fit-decreasing for all pieces: of the sequences that a piece fits into it joins the fullest.

    Sequences filled alike are one group. A piece joins the group with the least room that suffices, and so do
    the next of its length until that room is used; a step splits at most one group, whatever the counts.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[list[int], int]]] = {}
    done: list[Filling] = []

    def add(room: int, filling: list[int], copies: int) -> None:
        if not room:
            done.append((filling, copies))
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((filling, copies))

    for n in np.flatnonzero(counts)[::-1].tolist():
        pieces = int(counts[n]) if n else 0
        while pieces:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                filling, copies = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, filling, copies = capacity, [], pieces
            k = room // n
            full = min(copies, pieces // k)
            pieces -= full * k
            if full:
                add(room - k * n, filling + [n] * k, full)
            left = copies - full
            if left and pieces:
                # Fewer than k pieces are left; they share one sequence.
                add(room - pieces * n, filling + [n] * pieces, 1)
                left, pieces = left - 1, 0
            if left and filling:
                add(room, filling, left)
    return done + [x for own in groups.values() for x in own]


def _sequences(fillings: list[Filling]) -> int:
    return sum(copies for _, copies in fillings)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """No plan has fewer.

    For every size k up to half the capacity: pieces of more than half stand alone, those that leave less than k
    take nothing of k or more, and what pieces of k and more have over the room beside the others needs
    sequences of its own. k = 0 is the total over the capacity.
    """
    number, size = np.cumsum(counts), np.cumsum(counts * np.arange(len(counts)))
    half, k = capacity // 2, np.arange(capacity // 2 + 1)
    below = np.maximum(k - 1, 0)
    large = int(number[capacity] - number[half])
    beside = number[capacity - k] - number[half]  # of more than half, with room for k
    room = beside * capacity - (size[capacity - k] - size[half])
    small = size[half] - np.where(k > 0, size[below], 0)
    return large + max(0, int((-((room - small) // capacity)).max()))


def _complete_bins(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Rounds that fill a sequence around the longest remaining piece and repeat it as often as the pieces last."""
    left, longest, fillings = counts.copy(), capacity, []
    while True:
        while longest > 0 and not left[longest]:
            longest -= 1
        if not longest:
            return fillings
        left[longest] -= 1
        filling = [longest, *best_filling(capacity - longest, left)]
        left[longest] += 1
        used, times = np.unique(filling, return_counts=True)
        copies = int((left[used] // times).min())
        left[used] -= copies * times
        fillings.append((filling, copies))


def _dominated(filling: list[tuple[int, int]], waste: int, left: dict[int, int], capacity: int) -> bool:
    """Whether a piece that is left fits in place of some of the filling's, all of them no longer together than it.

    What can be packed beside the filling can then be packed beside the other one.
    """
    mask, sums, several = (1 << capacity + 1) - 1, 1, 0
    for n, copies in filling:
        for _ in range(copies):
            several |= (several | sums & ~1) << n & mask
            sums |= sums << n & mask
    taken = dict(filling)
    for x, copies in left.items():
        if copies > taken.get(x, 0):
            low = max(0, x - waste)
            if sums >> low & (1 << x - low) - 1 or several >> x & 1:
                return True
    return False


def fillings_around(longest: int, counts: np.ndarray, capacity: int, most_waste: int) -> tuple[list[list[int]], int]:
    """Undominated fillings with the longest piece and at most so much waste, those of least waste first; and the steps.

    Lengths are taken in falling order, of each as many as fit or up to eight fewer. A branch ends where the sums that are still
    reachable waste more than allowed.
    """
    gap = capacity - longest
    left = {n: int(counts[n]) for n in np.flatnonzero(counts[: gap + 1])[::-1].tolist() if n}
    if longest in left:
        left[longest] -= 1
    lengths = [n for n, copies in left.items() if copies]
    own = np.zeros(gap + 1, np.int64)
    own[lengths] = [left[n] for n in lengths]
    reach = _reachable(gap, lengths, own)
    found: list[tuple[int, list[tuple[int, int]]]] = []
    stack: list[tuple[int, int, tuple]] = [(0, gap, ())]
    steps = 0
    while stack and steps < MAX_STEPS:
        steps += 1
        at, rest, chosen = stack.pop()
        while at < len(lengths) and lengths[at] > rest:
            at += 1
        if rest - ((reach[at] & (1 << rest + 1) - 1).bit_length() - 1) > most_waste:
            continue
        if at == len(lengths) or not rest:
            if not _dominated(list(chosen), rest, left, capacity):
                found.append((rest, list(chosen)))
            continue
        n = lengths[at]
        for copies in range(min(left[n], rest // n, 8) + 1):
            more = min(left[n], rest // n) - copies
            stack.append((at + 1, rest - more * n, (*chosen, (n, more)) if more else chosen))
        stack[-min(left[n], rest // n, 8) - 1 :] = stack[-min(left[n], rest // n, 8) - 1 :][::-1]
    best = sorted(found, key=lambda x: (x[0], [(-n, -c) for n, c in x[1]]))[:ALTERNATIVES]
    return [[longest, *(n for n, copies in chosen for _ in range(copies))] for _, chosen in best], steps


def _branch(counts: np.ndarray, capacity: int, best: list[Filling]) -> list[Filling]:
    """The best plan that branching over the fillings around the longest piece finds, starting from an incumbent.

    A branch takes a filling as often as its pieces last, or half as often, and ends when its lower bound reaches the
    incumbent; a filling may waste what is left until then. Best fit completes every branch. The search ends with
    a plan that meets the lower bound, or after a fixed amount of work.
    """
    least, fewest, work = least_sequences(counts, capacity), _sequences(best), 0
    sizes = np.arange(len(counts))
    stack: list = [(counts, [], 0, None, 0)]
    while stack and work < MAX_WORK and fewest > least:
        left, plan, used, filling, copies = stack.pop()
        if filling is not None:
            own, times = np.unique(filling, return_counts=True)
            left, plan, used = left.copy(), [*plan, (filling, copies)], used + copies
            left[own] -= copies * times
        work += 20
        if used + least_sequences(left, capacity) >= fewest:
            continue
        rest = best_fit(left, capacity)
        work += 10 * len(rest)
        if used + _sequences(rest) < fewest:
            best, fewest = plan + rest, used + _sequences(rest)
        some = np.flatnonzero(left)
        if not some[some > 0].size:
            continue
        slack = (fewest - 1 - used) * capacity - int((left * sizes).sum())
        options, steps = fillings_around(int(some[-1]), left, capacity, max(0, min(slack, capacity)))
        work += 5 * steps + len(some)
        for option in reversed(options):
            own, times = np.unique(option, return_counts=True)
            most = int((left[own] // times).min())
            stack += [(left, plan, used, option, n) for n in sorted({most, -(-most // 2)})]
    return best


def plan_sequences(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Slots for all pieces, from the number of pieces of each length.

    The better of best-fit-decreasing and of completed bins is the incumbent of a branch and bound over whole plans,
    unless it meets the lower bound; so no plan is longer than best fit. Rows: length, first rank, last rank + 1, first
    sequence, offset, pieces of this length in one sequence. The number of rows depends on the capacity,
    hardly on the number of pieces.
    """
    counts = counts.astype(np.int64)
    fillings = _complete_bins(counts, capacity)
    if _sequences(fillings) > least_sequences(counts, capacity):
        fillings = _branch(counts, capacity, min(fillings, best_fit(counts, capacity), key=_sequences))
    taken, slots, sequence = np.zeros(len(counts), np.int64), [], 0
    for filling, copies in fillings:
        used, times = np.unique(filling, return_counts=True)
        offset = 0
        for n, k in sorted(zip(used.tolist(), times.tolist()), reverse=True):
            slots.append((n, taken[n], taken[n] + copies * k, sequence, offset, k))
            taken[n] += copies * k
            offset += n * k
        sequence += copies
    return np.array(sorted(slots), np.int64).reshape(-1, 6)


def _place(length: np.ndarray, rank: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of pieces from their length and their rank within it."""
    first = np.searchsorted(slots[:, 0], length, side="left")
    size = np.searchsorted(slots[:, 0], length, side="right") - first
    at = np.zeros(len(length), np.int64)
    for n in np.unique(length):
        own = length == n
        f, s = first[own][0], size[own][0]
        at[own] = f + np.searchsorted(slots[f : f + s, 1], rank[own], side="right") - 1
    into, k = rank - slots[at, 1], slots[at, 5]
    return slots[at, 3] + into // k, slots[at, 4] + into % k * length


def pack(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece.

    Texts become ids by the tokenizer in ``path`` (every executor opens it) and end with ``end_id``; null
    and empty texts are that id alone. Longer ones are cut at the capacity. What the plan needs of the
    corpus is the number of pieces of each length, at most ``capacity`` numbers; pieces find their place by
    their rank within their length. Repeated rows are pieces of their own; an empty table gives an empty
    result; other columns are not read.
    """
    pieces = stored(cut_pieces(docs, id_col, text_col, path, capacity, end_id), "pieces")
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes:
        counts[row["length"]] = row["n"]
    slots = docs.sparkSession.sparkContext.broadcast(plan_sequences(counts, capacity))
    ranked = numbered(pieces, ["length"], [id_col, "piece", "ids_crc32"], "_nth")
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = _place(batch.column("length").to_numpy(), batch.column("_nth").to_numpy(), slots.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.select(*names, "_nth").mapInArrow(run, schema)
