"""Benchmark decontamination against a plain Smith-Waterman over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from activity_engine.llm import decontaminate as dc


def smith_waterman(a, b):
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            step = dc.MATCH if x == y and x > 0 else dc.MISMATCH
            new.append(max(0, row[j - 1] + step, row[j] + dc.GAP, new[j - 1] + dc.GAP))
        best = max(best, *new)
        row = new
    return best


def test_alignment_matches_the_plain_program():
    rng = np.random.default_rng(3)
    for _ in range(20):
        m, w = rng.integers(1, 30), rng.integers(1, 60)
        first = rng.integers(1, 6, (8, m)).astype(np.int32)
        second = rng.integers(0, 6, (8, w)).astype(np.int32)
        second[:, w // 2 :][rng.random((8, w - w // 2)) < 0.1] = -1
        score, begin, end = dc.align(first, second)
        for k in range(8):
            assert score[k] == smith_waterman(first[k].tolist(), second[k].tolist())
            if score[k]:
                # The reported stretch holds the whole alignment.
                assert smith_waterman(first[k].tolist(), second[k, begin[k] : end[k]].tolist()) == score[k]


def paraphrase(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 2:
            out.append(f"other{rng.randrange(1000)}")
        elif x < share * 0.75:
            out += [w, "indeed"]
        elif x >= share:
            out.append(w)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)] + ["the", "of", "and"] * 400
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(12, 50)))) for i in range(25)]
    items += [(100, "w1 w2 w3 w4"), (101, "w9 w8"), (102, "Solo!"), (103, None), (104, "  ")]
    docs, planted = [], {}
    for d in range(160):
        words = rng.choices(vocabulary, k=rng.randrange(0, 120))
        if d % 4 == 0:
            item, text = items[0] if d % 8 == 0 else rng.choice(items[:25])
            share = rng.choice([0, 0, 0.1, 0.2])
            at = rng.randrange(len(words) + 1)
            words[at:at] = paraphrase(rng, text.split(), share)
            planted[d] = item
        docs.append((d, " ".join(words).upper() if d % 3 == 0 else ", ".join(words)))
    docs += [(900, "w1, w2 w3 -- W4"), (901, "w1 w2 w3"), (902, "x solo y"), (903, None)]
    return items, docs, planted


def test_planted_passages_are_found_and_clean_documents_are_left(spark, documents, corpus):
    items, docs, planted = corpus
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    found = dc.contaminated(documents(docs), bench).collect()
    pairs = {(r.doc_id, r.item_id): r for r in found}
    assert {(d, i) for d, i in planted.items()} <= set(pairs)
    assert (900, 100) in pairs and (902, 102) in pairs and not any(d in (901, 903) for d, _ in pairs)
    numbers = {}
    number = lambda text: [numbers.setdefault(w, len(numbers) + 1) for w in dc.words_of(text)]
    texts, wanted = dict(docs), {i: number(t) for i, t in items}
    for (d, i), r in pairs.items():
        words = number(texts[d])
        full = smith_waterman(wanted[i], words) / (dc.MATCH * len(wanted[i]))
        assert r.score == pytest.approx(full) and r.score >= dc.LEAST_SCORE
        inside = smith_waterman(wanted[i], words[r.from_word : r.to_word]) / (dc.MATCH * len(wanted[i]))
        assert inside == pytest.approx(full)
    # Nothing else scores high enough: all pairs, without seeds.
    for d, text in docs:
        for i, item in wanted.items():
            if len(item) >= dc.FEW_WORDS and (d, i) not in pairs:
                assert smith_waterman(item, number(text)) < dc.LEAST_SCORE * dc.MATCH * len(item)


def test_blocks_of_items_find_the_same(spark, documents, corpus, monkeypatch):
    items, docs, _ = corpus
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(dc.contaminated(documents(docs), bench).select("doc_id", "item_id", "score").collect())
    blocks = list(dc.blocks(bench, 200))
    assert len(blocks) > 3
    monkeypatch.setattr(dc, "blocks", lambda _: blocks)
    assert sorted(dc.contaminated(documents(docs), bench).select("doc_id", "item_id", "score").collect()) == whole


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, "same words here again"), (2, None), (2, "no id at all"), (2, "no id at all")], "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id) for r in dc.contaminated(odd.where("doc_id is not null"), bench).collect())
    assert found == [(6, 1), (6, 1)]
    assert [r.doc_id for r in dc.contaminated(odd.where("doc_id is null"), bench).collect()] == [None, None]
    assert dc.contaminated(odd, bench.where("false")).count() == 0
    assert dc.contaminated(odd.where("false"), bench).count() == 0
