"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import runs


def brute(words, least=12):
    """All runs by comparing words p apart, period after period; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, 2 * p):
                found.setdefault((start, length), p)
    return sorted((s, p, n) for (s, n), p in found.items())


def seeded(words, doc_id):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = seeded(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
    found = [(s, n, p) for s, p, n in brute(words)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    four = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(found), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def sequences():
    rng = random.Random(5)
    for letters in (1, 2, 2, 2, 3, 5):
        for n in (0, 1, 2, 11, 12, 13, 40, 150, 400):
            yield [rng.randrange(letters) for _ in range(n)]
    # Periodic parts of periods that are themselves periodic, with and without a break.
    for _ in range(250):
        out = []
        while len(out) < 250:
            word = [rng.randrange(2) for _ in range(rng.randrange(1, 5))]
            unit = (word * rng.randrange(1, 9))[: rng.randrange(1, 24)] + [rng.randrange(2)] * rng.randrange(0, 2)
            out += (unit * 6)[: rng.randrange(1, 6 * len(unit) + 1)]
        yield out
    a, b = [0, 1], [1, 0]
    for _ in range(8):
        a, b = a + b, b + a  # no cubes at all
    yield a
    x, y = [0], [0, 1]
    for _ in range(11):
        x, y = y, y + x  # as many runs as a sequence can have, nearly
    yield y


@pytest.mark.parametrize("least", [2, 12])
def test_every_run_is_found(least):
    for words in sequences():
        found = [tuple(r) for r in runs.find(np.array(words, dtype=np.int64), least)[:, [0, 2, 1]].tolist()]
        assert found == brute(words, least), words


def test_texts_searched_together_do_not_meet():
    texts = [["a"] * 7, ["a"] * 7, [], ["b", "c"] * 9, ["b", "c"] * 3]
    assert [d[:4] for d in runs._searched(texts)] == [(0, None, None, None), (0, None, None, None), (0, None, None, None), (1, 0, 18, 2), (0, None, None, None)]


def test_against_brute_force_on_documents(spark, documents):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") if i % 3 else rng.choice(["é", "c", "d "]) for _ in range(rng.randrange(0, 90)))) for i in range(300)]
    rows += [(1000, "x y z " * 30 + "　x"), (1001, None), (1002, ""), (1003, " \t\x0b\x0c\r\n"), (None, "q " * 20), (None, "q " * 20)]
    found = documents(rows).select("doc_id", runs.digest(F.col("text"), F.col("doc_id")).alias("r")).select("doc_id", "r.*").drop("n_words")
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_long_and_odd_texts(odd):
    found = odd.select("doc_id", runs.digest(F.col("text"), F.col("doc_id")).alias("r")).select("doc_id", "r.*")
    rows = {r.doc_id: r for r in found.collect()}
    assert (rows[5].n_runs, rows[5].start, rows[5].length, rows[5].period) == (1, 0, 360_000, 6)
    assert (rows[1].n_runs, rows[1].start, rows[1].runs_sha256) == (0, None, hashlib.sha256(b"").hexdigest())
    assert found.where("doc_id = 6").distinct().count() == 1 and found.count() == 10
    assert odd.where("false").select(runs.digest(F.col("text"), F.col("doc_id"))).count() == 0
