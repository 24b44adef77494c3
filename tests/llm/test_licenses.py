"""Licence scans against a search word by word and a dynamic program for the edits."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from activity_engine.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_base(text):
    words = WORD.findall(lower(text))
    hits = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits})))


def least_edits(pattern, text):
    """Fewest edits that turn the pattern into some stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        match rng.randrange(3):
            case 0:
                chars[i] = rng.choice("abcxyz")
            case 1:
                chars.insert(i, rng.choice("abcxyz"))
            case _:
                del chars[i]
    return "".join(chars)


def test_base_matches_a_plain_search(documents):
    rng = random.Random(2)
    parts = ["MIT", "mit", "License", "license", "apache", "General", "public", "licensee", "é", "x9", " ", "-", "_", "\n", "MIT-License"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(200)] + [None, "", "mit license"]
    rows = documents(list(enumerate(texts))).select("doc_id", licenses.scan(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_every_notice_within_its_edits_is_found():
    """The seeds lose nothing: what a dynamic program finds, the scan finds."""
    rng = random.Random(5)
    wanted = licenses.notices()
    scanner = licenses.Scanner(wanted)
    for _ in range(150):
        notice = rng.choice(wanted)
        line = edited(rng, notice.text, rng.randrange(notice.edits + 3))
        text = f"some words before {line} and after"
        joined = b" ".join(licenses.words_of(text)).decode()
        near = {n.label for n in wanted if least_edits(n.text, joined) <= n.edits}
        found = scanner.spans(joined)
        assert bool(found) == bool(near), text
        for label, a, b, edits in found:
            best = min(least_edits(n.text, joined[a:b]) for n in wanted if n.label == label)
            assert label in near and best <= edits <= max(n.edits for n in wanted if n.label == label)


def test_near_miss_labels():
    found = licenses.scan_text("(c) Licensed under CC BY-NC 4.0!", licenses.Scanner(licenses.notices()))
    assert found["labels"] == "cc-by-nc" and found["n_base"] == 0 and found["score"] == 1.0
    (span,) = found["spans"]
    assert (span["start"], span["end"], span["edits"]) == (1, 8, 0)
    typo = licenses.scan_text("relased undr the MIT licence", licenses.Scanner(licenses.notices()))
    assert "mit" not in typo["base_labels"] and typo["score"] < 1


def test_odd_rows(odd):
    rows = odd.select("doc_id", licenses.scan(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    assert len(rows) == 10 and all(r.labels == "" and r.score == 0 for r in rows)
    assert {r.n_words for r in rows if r.doc_id == 5} == {360_000}
    assert odd.where("false").select(licenses.scan(F.col("text"))).count() == 0


def test_notices_side_by_side_are_all_found():
    scanner = licenses.Scanner(licenses.notices())
    spans = scanner.spans("licensed under the mit licence licensed under the mit license")
    assert [(label, edits) for label, _, _, edits in spans] == [("mit", 1), ("mit", 0)]
    rng = random.Random(11)
    for _ in range(60):
        wanted = [rng.choice(scanner.wanted) for _ in range(rng.randrange(2, 5))]
        text = " ".join(edited(rng, n.text, rng.randrange(0, 2)) for n in wanted)
        assert len(scanner.spans(text)) >= len(wanted), text


def test_every_place_of_a_notice_is_in_a_span():
    """Wherever the dynamic program ends a notice within its edits, a span of no more edits covers that place."""
    rng = random.Random(13)
    wanted = licenses.notices((("mit", "released under the mit license"),))
    scanner, notice = licenses.Scanner(wanted), wanted[0]
    for _ in range(25):
        parts = [edited(rng, notice.text, rng.randrange(0, notice.edits + 2)) if rng.random() < 0.5 else "some other words" for _ in range(5)]
        text = " ".join(parts)
        row, ends = [0] * (len(text) + 1), []
        for i, p in enumerate(notice.text, 1):
            new = [i]
            for j, c in enumerate(text, 1):
                new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
            row = new
        ends = [j for j, cost in enumerate(row) if cost <= notice.edits]
        spans = scanner.spans(text)
        for j in ends:
            assert any(a < j <= b + notice.edits and edits <= row[j] for _, a, b, edits in spans), (text, j)


def test_long_texts_with_many_notices_take_linear_time():
    text = "released under the mit license and then " * 20_000
    found = licenses.scan_text(text, licenses.Scanner(licenses.notices()))
    assert len(found["spans"]) == 20_000 == found["n_base"] and found["spans"][-1]["start"] == 7 * 19_999
