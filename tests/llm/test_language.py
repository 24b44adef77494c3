"""Language models: probabilities that add up, a slow version of them, held-out accuracy, rejection."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import language

COUNTS = {
    "xx": {b"banana": 5, b"bandana": 2, b"cab": 1, "né".encode(): 3},
    "yy": {b"kiwi": 4, b"wiki": 4, b"ban": 1},
}


def slow_probability(model_counts, history, char, order=language.ORDER):
    """Interpolated Kneser-Ney from its definition, for one language over the shared alphabet."""
    grams = [{} for _ in range(order + 1)]
    alphabet = set()
    for lang, words in COUNTS.items():
        for w in words:
            alphabet |= set(w.decode()) | {"\x01"}
    for w, n in model_counts.items():
        s = "\x01" * (order - 1) + w.decode() + "\x01"
        for i in range(order - 1, len(s)):
            grams[order][s[i - order + 1 : i + 1]] = grams[order].get(s[i - order + 1 : i + 1], 0) + n
    for n in range(order - 1, 0, -1):
        for g in grams[n + 1]:
            grams[n][g[1:]] = grams[n].get(g[1:], 0) + 1

    def p(history, char):
        n = len(history) + 1
        lower = p(history[1:], char) if n > 1 else 1.0 / (len(alphabet) + 1)
        ones = sum(c == 1 for c in grams[n].values())
        twos = sum(c == 2 for c in grams[n].values())
        d = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + 2 * twos else 0.5))
        follow = {g: c for g, c in grams[n].items() if g[:-1] == history}
        total = sum(follow.values())
        if not total:
            return lower
        return max(follow.get(history + char, 0) - d, 0) / total * (history + char in follow) + d * len(follow) / total * lower

    return p(history, char)


@pytest.mark.parametrize("word", [b"banana", b"wiki", b"cabana", "é".encode(), b"zz"])
def test_word_logs_match_the_definition(word):
    model = language.fit(COUNTS)
    logs, chars = model.word_logs([b"kiwi", word, b"ban"])
    assert chars[1] == len(word.decode()) + 1
    s = "\x01" * (language.ORDER - 1) + word.decode() + "\x01"
    for k, lang in enumerate(model.langs):
        expected = 0.0
        for i in range(language.ORDER - 1, len(s)):
            known = any(s[i] in w.decode() + "\x01" for c in COUNTS.values() for w in c)
            if known:
                expected += math.log(slow_probability(COUNTS[lang], s[i - language.ORDER + 1 : i], s[i]))
            else:
                expected = None
                break
        if expected is not None:
            assert logs[1, k] == pytest.approx(expected, abs=1e-4)


def text(rng, syllables, words):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    kinds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ei", "ung", "ä"], "cc": ["tion", "que", "é", "ou"]}
    rows = [(i, text(rng, kinds[lang], rng.randrange(3, 60)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    return rows


def test_held_out_accuracy_and_rejection(documents, corpus, odd):
    docs = documents(corpus)
    model = language.train(docs.where("doc_id < 120"))
    found = docs.select("doc_id", "lang", language.identify(F.col("text"), model).alias("r")).where("doc_id >= 120").collect()
    assert np.mean([r.lang == r.r.lang_pred for r in found]) >= 0.98
    assert not any(r.r.rejected for r in found) and all(0 <= r.r.score <= 1 for r in found)
    rng = random.Random(3)
    noise = documents([(i, "".join(rng.choice("bcdfghjklpqrvwxyz ") for _ in range(400))) for i in range(5)])
    assert all(r.r.rejected for r in noise.select(language.identify(F.col("text"), model).alias("r")).collect())
    rows = {r.doc_id: r.r for r in odd.select("doc_id", language.identify(F.col("text"), model).alias("r")).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected for i in (1, 2, 3, 7))
    assert all(rows[i].lang_pred in model.langs for i in (4, 5, 6, 8, None))


def test_nothing_to_learn_from(documents, odd):
    model = language.train(documents([(1, "text", None), (None, "text", "en"), (2, None, "en")]))
    found = odd.select(language.identify(F.col("text"), model).alias("r")).collect()
    assert {r.r.lang_pred for r in found} == {"und"}
    assert odd.where("false").select(language.identify(F.col("text"), model)).count() == 0


def test_an_evicted_cache_changes_nothing(documents, corpus, monkeypatch):
    docs = documents(corpus)
    model = language.train(docs)
    first = docs.select("doc_id", language.identify(F.col("text"), model).alias("r")).orderBy("doc_id").collect()
    monkeypatch.setattr(language, "CACHE_WORDS", 5)
    assert docs.select("doc_id", language.identify(F.col("text"), model).alias("r")).orderBy("doc_id").collect() == first
