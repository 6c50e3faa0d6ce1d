"""Token counts with a shortcut for pre-tokens that are one token."""

from __future__ import annotations

import json
from collections.abc import Iterator

from functools import lru_cache
from sys import maxunicode
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vicinal.llm.common import text_bytes, text_slices
from vicinal.llm.word_hashes import word_hashes, word_places
from vicinal.llm.word_index import WordIndex, beyond_latin, rows_with

#: Fixed value: the pattern that byte-level tokenizers of this family cut texts with.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose sizes a worker remembers; further ones are merged each time.
REMEMBERED = 400_000


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings proven to encode alone as one token.

    Each string is encoded by the tokenizer itself and must come back as its own id; it must also be one
    pre-token, so that it can never be merged with a neighbour.
    """
    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ids = sorted(tokenizer.get_vocab().values())
    texts = tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)
    pattern = regex.compile(PRE_TOKENS)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [
        text for i, text, got in zip(ids, texts, encoded)
        if got.ids == [i] and text not in special and pattern.fullmatch(text)
    ]


@lru_cache(maxsize=4)
def agreed_characters(path: str) -> np.ndarray:
    """For every code point whether ``PRE_TOKENS`` and the tokenizer's own cutter take it for the same kind.

    Both cut a letter, the character and a digit: a letter stays with the first, a number with the last, any other
    character alone. White space but blank, tab and line ends does not count as agreed, since it is not cut at.
    """
    cut, own = regex.compile(PRE_TOKENS), Tokenizer.from_file(path).pre_tokenizer
    agreed = np.zeros(maxunicode + 1, bool)
    agreed[[9, 10, 13, 32]] = True
    spaces = regex.compile(r"\s")
    tried = [c for c in map(chr, range(maxunicode + 1)) if category(c) not in ("Cs", "Cn", "Co") and not spaces.match(c)]
    for first in range(0, len(tried), 4096):
        some = tried[first : first + 4096]
        line = " ".join(f"a{c}1 !{c}!" for c in some)
        mine, theirs = {m.span() for m in cut.finditer(line)}, {at for _, at in own.pre_tokenize_str(line)}
        agreed[[ord(c) for c in some]] = True
        # Every character has 7 places and the blank before them.
        for start, _ in mine ^ theirs:
            agreed[ord(some[(start + 1) // 8])] = False
    return agreed


class TokenCounter:
    """Tokens of whole texts.

    Merges never cross pre-tokens, and no pre-token goes on behind white space, but one blank before a word
    belongs to it. So a text is cut into words, each with its blank or without, and the white space that is
    left; what each has is looked up by a 64-bit hash. This holds for all scripts. Texts with characters that pattern
    engines differ in, rare white space among them, are left to the tokenizer, as are texts with special tokens.
    """

    def __init__(self, path: str, known: list[str], agreed: np.ndarray):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole, self.merged, self.agreed = set(known), {}, agreed
        self.cut = regex.compile(PRE_TOKENS).findall
        self.index = WordIndex(self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.sizes, self.words = np.zeros(1 << 16, np.int64), 0

    def _library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _size(self, text: str) -> int:
        total = 0
        for part in self.cut(text):
            if part in self.whole:
                total += 1
                continue
            size = self.merged.get(part)
            if size is None:
                size = self._library(part)
                if len(self.merged) < REMEMBERED:
                    self.merged[part] = size
            total += size
        return total

    def _learn(self, words: list[bytes]) -> None:
        while self.words + len(words) > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.sizes[self.words : self.words + len(words)] = [self._size(w.decode()) for w in words]
        self.words += len(words)

    def count(self, texts: pa.Array) -> np.ndarray:
        data, rows = text_bytes(texts)
        if not len(data):
            return np.zeros(len(texts), np.int64)
        blank = (data == 32) | (data == 9) | (data == 10) | (data == 13)
        starts, ends, first = word_places(~blank, rows)
        # A blank right before a word goes with it, and is no white space of its own.
        with_blank = (starts > 0) & (data[np.maximum(starts - 1, 0)] == 32)
        with_blank[first[:-1][(first[:-1] < len(starts)) & (np.diff(first) > 0)]] &= (
            starts[first[:-1][np.diff(first) > 0]] > rows[:-1][np.diff(first) > 0]
        )
        begin = starts - with_blank
        total = self._add(data, begin, ends, rows)
        left = blank.copy()
        left[begin[with_blank]] = False
        spaces, upto, _ = word_places(left, rows)
        # White space before a word without a blank of its own: its last character is a pre-token by itself.
        inner = np.isin(upto, starts[~with_blank]) & ~np.isin(upto, rows) & (upto - spaces > 1)
        cuts = upto[inner] - 1
        total += self._add(data, np.concatenate([spaces, cuts]), np.concatenate([np.where(inner, upto - 1, upto), upto[inner]]), rows)
        for n in np.flatnonzero(self._doubtful(data, rows) | self._has_special(data, rows)):
            total[n] = self._library(texts[int(n)].as_py())
        return total

    def _doubtful(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows with a character of which it is not agreed what kind it is."""
        found, own = rows_with(beyond_latin(data), rows), data.tobytes()
        for n in np.flatnonzero(found):
            points = np.frombuffer(own[rows[n] : rows[n + 1]].decode().encode("utf-32-le"), np.uint32)
            found[n] = not self.agreed[points].all()
        return found

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The tokens between the given places, added up by row."""
        own = data.tobytes()
        at = self.index.look_up(word_hashes(data, starts, ends, exact_case=True), lambda n: own[starts[n] : ends[n]])
        row = np.searchsorted(rows, starts, side="right") - 1
        return np.bincount(row, self.sizes[at], len(rows) - 1).astype(np.int64)

    def _has_special(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        own, found = data.tobytes(), np.zeros(len(rows) - 1, bool)
        for special in self.special:
            at = own.find(special)
            while at >= 0:
                found[np.searchsorted(rows, at, side="right") - 1] = True
                at = own.find(special, at + 1)
        return found


def _byte_level(path: str) -> None:
    with open(path) as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        raise ValueError("the shortcut holds for byte-level tokenizers without a normalizer")


def count_tokens(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every row, as the tokenizer in ``path`` counts whole texts.

    ``path`` is a byte-level BPE file that every executor can open. Null and empty texts have 0 tokens.
    Rows are independent: repeated ids give repeated rows, an empty table an empty result, and other
    columns are not read.
    """
    _byte_level(path)
    known = docs.sparkSession.sparkContext.broadcast((whole_tokens(path), agreed_characters(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, *known.value)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                ends = text_bytes(part.column("_text"))[1]
                tokens = counter.count(part.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(ends[1:] - ends[:-1], pa.int64()), pa.array(tokens, pa.int64())],
                    [id_col, "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
