"""Prediction by partial matching: sums to one, a slow version, and the word unigram base."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import ppm


def counts_of(texts):
    c = Counter()
    for t in texts:
        c.update((t or "").encode().lower().split() + [b"\n"])
    return c


def trie_of(counts, least=0.0):
    keys, sums = ppm.node_counts(list(counts), np.array(list(counts.values()), dtype=float))
    keys, inverse = np.unique(keys, return_inverse=True)
    sums = np.bincount(inverse, sums)
    symbols = sums[keys >> np.uint64(56) == 0].sum()
    return ppm.Trie(keys[sums >= least], sums[sums >= least], symbols, sum(counts.values()))


def slow_log10(counts, token, least=0.0):
    """From the definition, with dictionaries of contexts."""
    table: dict[bytes, Counter] = {}
    for word, n in counts.items():
        line = b" " + word + (b"" if word == b"\n" else b" ")
        for i in range(1, len(line)):
            for k in range(0, min(ppm.ORDER, i) + 1):
                table.setdefault(line[i - k : i], Counter())[line[i]] += n
    total = {c: sum(f.values()) for c, f in table.items()}
    kept = {c: {s: n for s, n in f.items() if n >= least} for c, f in table.items()}
    line = b" " + token + (b"" if token == b"\n" else b" ")
    out = 0.0
    for i in range(1, len(line)):
        excluded: set = set()
        for k in range(min(ppm.ORDER, i), -1, -1):
            here = kept.get(line[i - k : i])
            if not here:
                continue
            room = total[line[i - k : i]] - sum(here[s] for s in excluded if s in here)
            free = {s: n for s, n in here.items() if s not in excluded}
            if line[i] in free:
                out += math.log10((free[line[i]] - 0.5) / room)
                break
            escape = room - sum(free.values()) + 0.5 * len(free)
            if room > 1e-9 and escape > 1e-9:
                out += math.log10(escape / room)
            excluded = set(here)
        else:
            out -= math.log10(256 - len(excluded))
    return out


TEXTS = ["banana bandana cab", "a banana", None, "", "the theme then THE", "né née"]


@pytest.mark.parametrize("least", [0, 2])
def test_probabilities_match_the_definition(least):
    counts = counts_of(TEXTS)
    trie = trie_of(counts, least)
    words = [b"banana", b"the", b"bandanas", b"zebra", b"\n", "né".encode(), b"x", b"thecab"]
    for word, log in zip(words, trie.log10(words), strict=True):
        assert log == pytest.approx(slow_log10(counts, word, least), abs=1e-9), word


@pytest.mark.parametrize("least", [0, 3])
def test_the_symbols_of_a_place_sum_to_one(least):
    """All one-symbol continuations after a prefix: their probabilities add up."""
    trie = trie_of(counts_of(TEXTS * 3), least)
    bytes_ = [b for b in range(256) if b not in (0x20, 0x0A)]
    for prefix in (b"", b"b", b"the", b"q"):
        # P(prefix + symbol ...) is compared through words that differ in one byte only at the end.
        closing = 10 ** trie.log10([prefix])[0] if prefix else 10 ** trie.log10([b"\n"])[0]
        total = closing
        for b in bytes_:
            word = prefix + bytes([b])
            total += 10 ** (trie.log10([word])[0] - closing_of(trie, word))
        start = 1.0 if not prefix else 10 ** (trie.log10([prefix])[0] - closing_of(trie, prefix))
        # The unused bytes (a space as a word's first byte, a line break inside a word) hold the rest.
        assert total <= start * (1 + 1e-9) and total >= start * 0.9


def closing_of(trie, word):
    """log10 probability of the space that closes the word, after it."""
    p = ppm.places([word])
    alone = ppm.Trie.log10
    whole = alone(trie, [word])[0]
    # The probability of the word without its closing space, by leaving the last place out.
    keep = np.arange(len(p.depth)) < len(p.depth) - 1
    original = ppm.places
    try:
        ppm.places = lambda _: ppm.Places([c[keep] for c in p.codes], p.depth[keep], p.token[keep])
        return whole - alone(trie, [word])[0]
    finally:
        ppm.places = original


@pytest.mark.parametrize("head_bits", [1, 20])
def test_base_and_scores_of_documents(documents, head_bits):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "of", "Word", "word,", "é", f"r{rng.randrange(400)}"]) for _ in range(rng.randrange(40))) for _ in range(150)]
    texts += [None, "", " \t "]
    rows = list(enumerate(texts))
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = ppm.score_digest(documents(rows), learned, ~learned, head_bits=head_bits).collect()
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = counts_of(train)
    n, v = sum(counts.values()), len(counts)
    trie = trie_of(counts)
    assert sorted(r.doc_id for r in found) == list(range(len(rows)))
    for r in found:
        words = (texts[r.doc_id] or "").encode().lower().split() + [b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r.score == pytest.approx(float(trie.log10(words).sum()))


def test_training_helps(documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ka", "to", "mi", "ru"]) for _ in range(3))
    docs = documents([(i, " ".join(word() for _ in range(60))) for i in range(60)])
    known = ppm.score_digest(docs, F.col("doc_id") < 40, F.lit(False)).where("doc_id >= 40").agg(F.sum("score")).first()[0]
    blank = ppm.score_digest(docs, F.lit(False), F.lit(False)).where("doc_id >= 40").agg(F.sum("score")).first()[0]
    assert known > blank / 4


def test_odd_rows(odd):
    found = ppm.score_digest(odd, F.col("doc_id") % 2 == 0, F.lit(False)).collect()
    assert len(found) == 10
    by = {r.doc_id: r for r in found}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[5].n_tokens == 360_001
    assert all(r.score < 0 and r.base_score < 0 for r in found)
    assert ppm.score_digest(odd.where("false"), F.lit(True), F.lit(False)).count() == 0


def test_no_counted_node_is_left_out(documents):
    """Beyond 2^20 training symbols a context seen once still counts."""
    rng = random.Random(5)
    common = ["the", "of", "and", "to", "in"]
    texts = [" ".join(rng.choices(common, k=6000)) + f" qx{i}zyv" for i in range(64)]
    rows = list(enumerate(texts))
    learned = F.col("doc_id") < 63
    found = {r.doc_id: r for r in ppm.score_digest(documents(rows), learned, ~learned).collect()}
    counts = counts_of(texts[:63])
    assert sum((len(w) + (w != b"\n")) * n for w, n in counts.items()) > 1 << 20
    trie = trie_of(counts)
    for doc in (0, 40, 63):
        words = texts[doc].encode().split() + [b"\n"]
        assert found[doc].score == pytest.approx(float(trie.log10(words).sum()), rel=1e-9)


def stream(text):
    """A whole text as it is coded; its first space is not."""
    return b" " + b" ".join((text or "").encode().lower().split() + [b"\n"])


def slow_through(texts, text):
    """From the definition, with contexts that run through whole texts."""
    table: dict[bytes, Counter] = {}
    for line in map(stream, texts):
        for i in range(1, len(line)):
            for k in range(min(ppm.ORDER, i) + 1):
                table.setdefault(line[i - k : i], Counter())[line[i]] += 1
    line, out = stream(text), 0.0
    for i in range(1, len(line)):
        excluded: set = set()
        for k in range(min(ppm.ORDER, i), -1, -1):
            here = table.get(line[i - k : i])
            if not here:
                continue
            free = {s: n for s, n in here.items() if s not in excluded}
            room = sum(free.values())
            if line[i] in free:
                out += math.log10((free[line[i]] - 0.5) / room)
                break
            if free:
                out += math.log10(0.5 * len(free) / room)
            excluded = set(here)
        else:
            out -= math.log10(256 - len(excluded))
    return out


def test_contexts_run_over_spaces(documents):
    rng = random.Random(3)
    phrases = ["the cat sat on a mat", "né dans la rue", "one two three four", "a b c d e f g"]
    texts = [" ".join(rng.choices(phrases, k=rng.randrange(1, 9))) for _ in range(60)]
    shuffled = texts[0].split() + phrases[0].split() * 3
    texts += [" ".join([texts[0], *[phrases[0]] * 3]), " ".join(rng.sample(shuffled, len(shuffled))), None, "", "zzz the"]
    docs = documents(list(enumerate(texts)))
    found = {r.doc_id: r for r in ppm.score_digest(docs, F.col("doc_id") < 50, F.lit(False), head_bits=4, through=True).collect()}
    for doc, text in enumerate(texts):
        assert found[doc].score == pytest.approx(slow_through(texts[:50], text), rel=1e-9), text
    assert found[60].score > found[61].score + 1 and found[60].base_score == pytest.approx(found[61].base_score)


@pytest.mark.parametrize("through", [True, False])
def test_pieces_of_long_texts_have_the_same_windows(monkeypatch, through):
    texts = ["the theme of them all " * 9, None, "né " * 30 + "x" * 50, "a"]
    whole = [ppm.windows(g, through) for g in ppm._pieces(texts)]
    monkeypatch.setattr(ppm, "PIECE_BYTES", 17)
    cut = [ppm.windows(g, through) for g in ppm._pieces(texts)]
    assert len(cut) > 10 and len(whole) == 1
    for k in (0, 1):
        assert np.array_equal(whole[0][k], np.concatenate([c[k] for c in cut]))


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_the_head_finds_what_a_dictionary_finds(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 7 << 56, n, dtype=np.uint64))
    known = dict(zip(keys.tolist(), (-rng.random(len(keys))).tolist(), strict=True))
    head = ppm.Head(keys, np.array([known[k] for k in keys.tolist()]))
    wanted = np.concatenate([keys, keys ^ np.uint64(1), rng.integers(0, 7 << 56, 500, dtype=np.uint64), keys[:3]])
    logs, hit = head.find(wanted)
    assert hit.tolist() == [w in known for w in wanted.tolist()]
    assert logs.tolist() == [known.get(w, 0.0) for w in wanted.tolist()]


class Sent:
    def __init__(self, value):
        self.get = lambda: value


def test_blocks_of_a_bucket_are_coded_together(monkeypatch):
    """Many small blocks cost one look at the trie, and each text gets its own sums; a full buffer changes neither."""
    found, n = np.unique(ppm.windows([(0, b" the theme of them all " * 3, 1)], True)[0], return_counts=True)
    low = ppm.window_nodes(found, n.astype(float), range(ppm.LOW + 1))
    words = [b" them ", b" theme", b" fall ", b" zzz them "]

    def block(bucket, word, owner):
        keys = ppm.windows([(0, word, 1)], True)[0]
        return {"bucket": bucket, "kind": 1, "windows": keys.tobytes(), "owners": [owner, owner + 100], "runs": [2, len(keys) - 2]}

    rows = []
    for bucket in (0, 1):
        rows.append({"bucket": bucket, "kind": 0, "windows": found.tobytes(), "counts": n.astype(float).tobytes()})
        rows += [block(bucket, words[i % 4], 10 * bucket + i % 4) for i in range(200)]
    trie, calls = ppm._bucket_trie(low, [found], [n.astype(float)]), []
    coded = ppm._coded
    monkeypatch.setattr(ppm, "_coded", lambda *a: calls.append(1) or coded(*a))

    def sums():
        out = Counter()
        for batch in ppm._settled(Sent(low))(iter([ppm._blocks(rows)])):
            for row in batch.to_pylist():
                out[row["key"]] += row["log"]
        return out

    together = sums()
    assert len(calls) == 2
    monkeypatch.setattr(ppm, "CODED_TOGETHER", 1)
    assert sums() == pytest.approx(together) and len(calls) == 402
    for bucket in (0, 1):
        for i, word in enumerate(words):
            logs = coded(trie, ppm.windows([(0, word, 1)], True)[0])
            assert together[10 * bucket + i] == pytest.approx(50 * logs[:2].sum())
            assert together[10 * bucket + i + 100] == pytest.approx(50 * logs[2:].sum())


def test_words_of_a_column_are_those_of_each_text():
    texts = ["The  the\tTHE\x0bcafé É\x1cx", None, "", " \r\n ", " né e f ", "a\x85b\x00 c", "z" * 5000]
    words, at, owner = ppm.words_of(ppm.pa.array(["cut off", *texts])[1:])
    names = words.to_pylist()
    assert len(set(names)) == len(names)
    for row, text in enumerate(texts):
        assert [names[i] for i in at[owner == row]] == ppm.tokens_of(text)[:-1]


@pytest.mark.parametrize("most", [1, 300_000])
def test_counts_of_a_task_are_passed_on_in_parts(monkeypatch, most):
    monkeypatch.setattr(ppm, "COUNTER_WORDS", most)
    batch = ppm.pa.record_batch({"text": TEXTS, "learned": [True, False, True, True, False, True]})
    parts = list(ppm._count_tokens(iter([batch] * 3)))
    assert len(parts) == (3 if most == 1 else 1)
    found, trained = Counter(), Counter()
    for row in (r for p in parts for r in p.to_pylist()):
        found[row["token"]] += row["n"]
        trained[row["token"]] += row["trained"]
    assert found == counts_of(TEXTS * 3) and +trained == counts_of([TEXTS[i] for i in (0, 2, 3, 5)] * 3)


def test_a_bucket_gives_one_row_for_what_a_text_asks_of_it():
    found, n = np.unique(ppm.windows([(0, b" the theme ", 1)], True)[0], return_counts=True)
    low = ppm.window_nodes(found, n.astype(float), range(ppm.LOW + 1))
    text = {"doc_id": 70, "held_out": True, "n_tokens": 3, "n_known": 1, "base": -1.0, "log": -2.0}
    rows = [
        {"bucket": 3, "kind": 0, "windows": found.tobytes(), "counts": n.astype(float).tobytes()},
        {"bucket": 3, "kind": 0, "tokens": [b"the", b"no"], "k": [1, 0], "base": [-0.5, -4.0]},
        {"bucket": 3, "kind": 1, "windows": found[:3].tobytes(), "owners": [7, 8], "runs": [2, 1]},
        {"bucket": 3, "kind": 1, "tokens": [b"no", b"the", b"the"], "k": [1, 2, 5], "owners": [7, 7, 9]},
        {"bucket": 3, "kind": 2, "key": 7, "text": text},
    ]
    got = [r for b in ppm._settled(Sent(low))(iter([ppm._blocks(rows)])) for r in b.to_pylist()]
    logs = ppm._coded(ppm._bucket_trie(low, [found], [n.astype(float)]), found[:3])
    assert [r for r in got if r["doc_id"] is not None] == [{"key": 7, **text}]
    sums = sorted((r["key"], r["n_known"], r["base"], r["log"]) for r in got if r["doc_id"] is None)
    assert [r[:3] for r in sums] == [(7, 2, -5.0), (8, 0, 0.0), (9, 5, -2.5)]
    assert [r[3] for r in sums] == pytest.approx([logs[:2].sum(), logs[2], 0.0])
