"""Token counts by the shortcut in all scripts, against the tokenizer."""

import random

import pyarrow as pa
import public_tokenizers
import pytest

from vicinal.llm.token_counts import TokenCounter, agreed_characters, whole_tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(BYTES, whole_tokens(BYTES), agreed_characters(BYTES))


def _expected(counter, texts):
    return [len(e.ids) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_other_scripts_use_the_shortcut(counter, monkeypatch):
    texts = [
        "Привет, мир! Это текст о погоде.", "Καλημέρα κόσμε, τι κάνεις;", "今日は天気がいいです。明日も晴れ。",
        "สวัสดีชาวโลก ยินดีต้อนรับ", "שלום עולם 12", "“quoted” – it’s 5 € 🙂", "नमस्ते दुनिया १२३",
    ]
    expected, asked, library = _expected(counter, texts), [], counter._library
    monkeypatch.setattr(counter, "_library", lambda text: asked.append(text) or library(text))
    assert counter.count(pa.array(texts)).tolist() == expected
    assert not set(asked) & set(texts)


def test_rare_white_space_is_left_to_the_tokenizer(counter):
    texts = ["a  b", " 　 x", "a  b  ", "\x0b\x0c a", "é\u0085 z"]
    assert counter._doubtful(*_bytes(texts)).all()
    assert counter.count(pa.array(texts)).tolist() == _expected(counter, texts)


def _bytes(texts):
    from vicinal.llm.common import text_bytes

    return text_bytes(pa.array(texts))


def test_random_mixtures_equal_the_tokenizer(counter):
    rng, agreed = random.Random(4), [i for i, ok in enumerate(counter.agreed) if ok]
    parts = ["Привет ", "’t don't ", "漢字。", "é", "👍🏽", " ", "  ", "\n", "\t", "१२", "Ⅷ²", "‍", " ", "İ", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.7 else chr(rng.choice(agreed)) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert counter.count(pa.array(texts)).tolist() == _expected(counter, texts)
