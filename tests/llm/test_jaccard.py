"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from activity_engine.llm import jaccard
from activity_engine.llm.components import components
from activity_engine.llm.words import WordHasher, shingles


def sets_of(rows, n):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[k : k + min(n, len(w))]) for k in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(rows, n, percent):
    """Component id of each row, by comparing all pairs."""
    sets = sets_of(rows, n)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(
        ((doc, len(sets[i]), low.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=repr
    )


def edit(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[i] = f"new{rng.randrange(10**6)}"
        else:
            words[i : i + 1] = [words[i], "x"] if rng.random() < 0.5 else []
    return words


def corpus(seed):
    """Clusters of copies with zero to many edits, chains, shared passages, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for c in range(12):
        base = rng.choices(vocabulary, k=rng.choice([8, 25, 60, 90]))
        if c % 3 == 0:
            base = passage + base[: rng.choice([1, 3, 20])]
        words = base
        for k in range(rng.randrange(1, 12)):
            words = edit(rng, words if c % 2 else base, rng.choice([0, 0, 1, 1, 2, 4])) or ["w1"]  # odd ones drift away
            rows.append((len(rows) * 3 % 1000, " ".join(words).upper() if k % 5 == 0 else "  ".join(words)))
    return rows + [(2001, "a b"), (2002, "A b"), (2003, "a"), (2004, ""), (2005, None), (2006, "a b c"), (2007, " \n ")]


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 3, 90), (3, 5, 80), (4, 2, 60)])
def test_components_match_all_pairs(documents, seed, n, percent):
    rows = corpus(seed)
    found = jaccard.join_digest(documents(rows), n=n, percent=percent)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, n, percent)


def test_a_large_group_of_near_copies(documents):
    """Copies of one text with one or two words changed; some only link through a third one."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(150)]
    rows = [(i, " ".join(edit(rng, base, rng.choice([1, 2, 2, 3, 5])))) for i in range(150)]
    found = jaccard.join_digest(documents(rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 3, 90)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = jaccard.join_digest(odd).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows, 3, 90)
    assert jaccard.join_digest(odd.where("false")).count() == 0


def test_word_hashes_tell_words_apart():
    texts = ["a b  a\tB", None, "", "a\x00 a", "ü U " * 3, "long " * 600_000, "x" * 5_000_000 + " a"]
    hashes = list(WordHasher().texts(texts))
    names = {}
    for text, found in zip(texts, hashes, strict=True):
        words = (text or "").encode().lower().split()
        assert len(words) == len(found)
        for w, h in zip(words, found.tolist(), strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    assert len(shingles(hashes[0], 3)) == 2 and len(shingles(hashes[0][:2], 3)) == 1


def test_suffix_filter_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(2))
        apart = len(np.setxor1d(x, y))
        assert jaccard.suffix_apart(x, y, 1000) <= apart
        if len(x) and len(y):
            assert jaccard.similar(x, y, 80) == (100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (300, 301), (301, 300)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    expected = {(k, 0) for k in range(41)} | {(100 + k, 100) for k in range(30)} | {(300, 300), (301, 300)}
    assert {tuple(r) for r in found} == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_links(rows, n, percent):
    sets = sets_of(rows, n)
    return {
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    }


@pytest.mark.parametrize("large", [False, True])
def test_every_link_is_returned(documents, large):
    """Links inside a component too, over several blocks; copies count each."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(120)]
    rows = [(i, " ".join(edit(rng, base, rng.choice([0, 1, 2, 3, 5])))) for i in range(700 if large else 60)]
    rows += [(5000 + i, t) for i, (_, t) in enumerate(corpus(6))] if not large else []
    found = jaccard.join_digest(documents(rows), n_links=True).collect()
    pairs = brute_links(rows, 3, 90)
    counts = [0] * len(rows)
    for i, j in pairs:
        counts[i] += 1
        counts[j] += 1
    assert {r.doc_id: r.n_links for r in found} == {doc: counts[i] for i, (doc, _) in enumerate(rows)}
    docs = documents(rows).select("doc_id", "text")
    placed = jaccard._prefixes(docs, jaccard.rarity(docs), 3, 90)
    sets = sets_of(rows, 3)
    different = {frozenset((frozenset(sets[i]), frozenset(sets[j]))) for i, j in pairs if sets[i] != sets[j]}
    returned = [(bytes(r.a), bytes(r.b)) for r in jaccard.links(docs, placed).collect()]
    assert len(returned) == len(set(returned)) == len(different)
