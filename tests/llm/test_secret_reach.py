"""Strings near sensitive words: the same as looking from every word to the end, in time that grows with the text."""

import random
import time

from vicinal.llm.secrets import CANDIDATE, REACH, SENSITIVE, _candidates, novel_spans


def from_every_word(text):
    """Starts and ends of the candidates near a word, one word after another."""
    found, last = [], 0
    for word in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(word.end(), last)):
            if m.start() > min(len(text), word.end() + REACH):
                break
            found.append(m.span())
            last = m.end()
    return found


def test_same_candidates():
    rng = random.Random(4)
    parts = ["token", "secret", "auth", " ", "=", "aB3dE5gH7jK9", "x" * 11, "y" * 12, "Zz9" * 30, " . " * 20, "é"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        got, last = [], 0
        for word in SENSITIVE.finditer(text):
            for m in _candidates(text, max(word.end(), last), min(len(text), word.end() + REACH)):
                got.append(m.span())
                last = m.end()
        assert got == from_every_word(text)


def test_many_words_in_a_long_text():
    start = time.process_time()
    assert novel_spans("token " * 180_000, []) == []
    assert time.process_time() - start < 5
