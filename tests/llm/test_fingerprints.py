"""Fingerprints against plain sets, and peeling against what was put in."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from activity_engine.llm import fingerprints as fp


def keys(text):
    found = re.findall(fp.PARAGRAPH, text)
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in found}


def brute(rows):
    """(doc_id, n_chars, edited_sha256, near_edited, near_next) of rows with ids of their own."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        near = []
        for other in (edited, after):
            a, b = keys(text), keys(other)
            near.append(len(a & b) / len(a | b) if a | b else 1.0)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return sorted(out)


def prints(text, width=fp.WIDTH):
    cells: dict = {}
    for k in keys(text):
        *places, own = ((k % 2**30 * a + (k >> 30) * b) % (2**31 - 1) for a, b in (fp.multipliers(t, 0) for t in range(4)))
        for t in range(3):
            at = t * width + places[t] % width
            n, key, check = cells.get(at, (0, 0, 0))
            cells[at] = (n + 1, key ^ k, check ^ own)
    return ";".join(f"{at:x}:{n:x}:{k:x}:{c:x}" for at, (n, k, c) in sorted(cells.items()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["alpha", "bêta", "gamma", "δ", "\U0001f600", "x"]

    def text(lines):
        return "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) + rng.choice([".", "! ok.", "", "?"]) for _ in range(lines))

    made = [(i * 3, text(rng.randrange(0, 40))) for i in range(120)]
    made += [(1001, None), (1003, ""), (1005, "  \n \n"), (1007, "..."), (1009, text(900)), (1010, text(1)), (-5, made[4][1]), (-7, made[4][1])]
    return made


def test_agrees_with_sets(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(fp, "CHUNK_CHARS", 1 << 14)  # many chunks
    found = fp.fingerprint_digest(documents(rows)).collect()
    assert [tuple(pytest.approx(x) if isinstance(x, float) else x for x in r) for r in brute(rows)] == sorted(
        (r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found
    )
    texts = dict(rows)
    assert all(r.fingerprint == prints(texts[r.doc_id] or "") for r in found)
    assert next(r for r in found if r.doc_id == -5).fingerprint == next(r for r in found if r.doc_id == -7).fingerprint


def test_peeling_gives_the_differing_digests(spark):
    rng = random.Random(1)
    shared, left, right = ([rng.getrandbits(60) for _ in range(n)] for n in (500, 9, 14))
    held = spark.createDataFrame([(1, k, s) for s, ks in ((1, shared + left), (-1, shared + right)) for k in ks], "id int, key bigint, s int")
    held = held.withColumn("width", F.lit(32).cast("bigint"))
    state = fp.peel(fp.sketch(held, ["id"], 3, F.col("s")).where("n != 0 or key != 0 or sum != 0"), ["id"], 3, listed=True)
    assert sorted((r.key, r.n) for r in state.collect()) == sorted([(k, 1) for k in left] + [(k, -1) for k in right])
    assert {r.part for r in state.collect()} == {3}


def test_pairs_that_do_not_peel_are_tried_again(spark):
    rng = random.Random(6)
    rows = [(i, [rng.getrandbits(60) for _ in range(n)], [rng.getrandbits(60) for _ in range(n // 2)]) for i, n in enumerate([0, 1, 3, 30, 300, 3000])]
    frame = spark.createDataFrame(rows, "id int, a array<bigint>, b array<bigint>")
    found = {r.id: r.differing for r in fp.compare(frame, ["id"], {"p": ("a", "b")}, factor=0.25).collect()}
    assert found == {i: len(a) + len(b) for i, a, b in rows if a}


def test_hashes_do_not_agree_on_what_they_put_together():
    """Digests with the same place under one hash have other places under the others and in later turns."""
    rng = random.Random(4)
    ratios = {(fp.multipliers(n, s)[1] * pow(fp.multipliers(n, s)[0], -1, fp.PRIME)) % fp.PRIME for n in range(4) for s in range(30)}
    assert len(ratios) == 120
    value = lambda k, n, s: (k % 2**30 * fp.multipliers(n, s)[0] + (k >> 30) * fp.multipliers(n, s)[1]) % fp.PRIME
    for _ in range(50):
        low, high = rng.randrange(2**30), rng.randrange(2**30 - 1)
        # One more of the high half is made up for by the low half under hash 0 of turn 0.
        a, b = fp.multipliers(0, 0)
        other = (low - b * pow(a, -1, fp.PRIME)) % fp.PRIME
        if other < 2**30:
            one, two = (high << 30) + low, ((high + 1) << 30) + other
            assert value(one, 0, 0) == value(two, 0, 0)
            assert all(value(one, n, s) != value(two, n, s) for n in range(4) for s in range(5) if (n, s) != (0, 0))


def test_odd_rows(odd):
    found = fp.fingerprint_digest(odd).collect()
    assert len(found) == 10
    by = {r.doc_id: r for r in found}
    assert (by[1].n_chars, by[1].fingerprint) == (0, "") and by[5].n_chars == 2_340_000
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert {r.fingerprint for r in found if r.doc_id == 6} == {prints("same words here again")}
    assert fp.fingerprint_digest(odd.where("false")).count() == 0
    alone = fp.fingerprint_digest(odd.where("doc_id = 4")).collect()
    assert [(r.near_edited, r.near_next) for r in alone] == [(1.0, 1.0)]


def test_a_row_moves_once_and_runs_no_python(documents, rows):
    plan = fp.with_next(documents(rows))[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
