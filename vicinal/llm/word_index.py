"""Numbers for the words of texts, so that what is known of a word is looked up for whole batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Words that a worker remembers (16 bytes each); when there are more, it starts anew.
REMEMBERED = 3_000_000


class WordIndex:
    """A number from 0 on for every word hash; ``learn`` is told the words that get the next numbers."""

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None]):
        self.learn, self.forget = learn, forget
        self._clear()

    def _clear(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray, word_at: Callable[[int], bytes]) -> np.ndarray:
        if len(self.keys) > REMEMBERED:
            self._clear()
            self.forget()
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == unique
        else:
            known = np.zeros(len(unique), bool)
        new = np.flatnonzero(~known)
        if len(new):
            self.learn([word_at(n) for n in first[new].tolist()])
            numbers = np.arange(len(self.keys), len(self.keys) + len(new))
            self.keys = np.insert(self.keys, at[new], unique[new])
            self.numbers = np.insert(self.numbers, at[new], numbers)
            at = np.searchsorted(self.keys, unique)
        return self.numbers[at][inverse]


def rows_with(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each row whether a flag is set between its first byte and the next row's."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), rows)) > 0


def beyond_latin(data: np.ndarray) -> np.ndarray:
    """True at bytes of other characters than tab, line ends, printable ASCII and U+00A1 to U+00FF."""
    allowed = (data >= 0x20) & (data <= 0x7E) | (data == 9) | (data == 10) | (data == 13)
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) | ((data[:-1] == 0xC2) & (data[1:] >= 0xA1))
    lead = (data == 0xC2) | (data == 0xC3)
    return ~(allowed | lead | second)
