"""The language model against a plain restatement, and with many languages."""

import math

import numpy as np

from vicinal.llm import language_id
from vicinal.llm.language_id import ALPHA, BETA, L1, L2, PASSES, calibrate, document_frequencies, fit_languages, train_ftrl


def _softmax(values):
    raised = [math.exp(v - max(values)) for v in values]
    return [v / sum(raised) for v in raised]


def _plain_ftrl(rows, classes, bias):
    z, n = {}, {}

    def weight(key):
        lasso = 0.0 if key[0] == bias else L1
        at = z.get(key, 0.0)
        shrunk = math.copysign(max(abs(at) - lasso, 0.0), at)
        return -shrunk / ((BETA + math.sqrt(n.get(key, 0.0))) / ALPHA + L2)

    for _ in range(PASSES):
        for features, values, label in rows:
            pairs = [*zip(features, values), (bias, 1.0)]
            before = {(f, c): weight((f, c)) for f, _ in pairs for c in range(classes)}
            shares = _softmax([sum(v * before[f, c] for f, v in pairs) for c in range(classes)])
            for f, v in pairs:
                for c in range(classes):
                    g = v * (shares[c] - (c == label))
                    old = n.get((f, c), 0.0)
                    n[f, c] = old + g * g
                    z[f, c] = z.get((f, c), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / ALPHA * before[f, c]
    return weight


def test_training_equals_a_plain_restatement():
    rng = np.random.default_rng(2)
    rows = []
    for n in range(40):
        features = np.sort(rng.choice(60, 8, replace=False))
        rows.append((features, rng.random(8) * 3, n % 3))
    weights, bias = train_ftrl(rows, 3)
    weight = _plain_ftrl(rows, 3, language_id.FEATURES)
    expected = np.array([[weight((f, c)) for c in range(3)] for f in range(60)])
    assert np.allclose(weights[:60], expected, atol=1e-9) and (weights[60:] == 0).all() and (weights[:60] == 0).any()
    assert np.allclose(bias, [weight((language_id.FEATURES, c)) for c in range(3)], atol=1e-9)


def test_the_temperature_has_the_least_loss():
    rng = np.random.default_rng(3)
    logits, labels = rng.normal(0, 4, (50, 3)), rng.integers(0, 3, 50)

    def loss(t):
        return -sum(math.log(max(_softmax([x / t for x in row])[y], 1e-12)) for row, y in zip(logits.tolist(), labels.tolist()))

    tried = np.geomspace(0.05, 20.0, 121)
    assert calibrate(logits, labels) == tried[int(np.argmin([loss(t) for t in tried]))]


def test_document_frequencies_count_every_text_once(spark):
    texts = ["aaa", "ab", "", None, "a-b 12", "AB", "é"]
    counts, total = document_frequencies(spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3))
    expected = np.zeros(language_id.FEATURES, np.int64)
    for text in texts:
        found = np.concatenate(language_id._features(language_id._codes([text or ""])[0]))
        for f in set(found[found < language_id.FEATURES].tolist()):
            expected[f] += 1
    assert total == len(texts) and (counts == expected).all()


def test_three_hundred_languages_are_all_learnt(spark, monkeypatch):
    consonants, vowels = "bcdfghklmnprstvz", "aeiou"
    parts = [c + v for c in consonants for v in vowels]
    words = {f"l{n:03d}": parts[n % 80] + parts[(7 * n + n // 80) % 80] for n in range(300)}
    rows = [(1000 * k + n, " ".join([word] * 12), lang) for k in range(3) for n, (lang, word) in enumerate(words.items())]
    rows += [(9000, "qqxx wwyy qqxx", "rare")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit_languages(docs, "text", "lang", "doc_id", max_rows=200)
    assert len(model.languages) == 301
    names, scores = model.predict([" ".join([w] * 9) for w in words.values()] + ["qqxx wwyy"])
    right = sum(a == b for a, b in zip(names, [*words, "rare"]))
    assert right >= 0.95 * 301 and names[-1] == "rare"
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 1)
    again, same = model.predict([" ".join([w] * 9) for w in words.values()] + ["qqxx wwyy"])
    assert again == names and np.allclose(same, scores)
