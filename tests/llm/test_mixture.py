"""Mixing sources, against a brute-force version of the targets and a walk over the schedule."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from activity_engine.llm import mixture


def water_fill(sizes, weights, share, ceiling):
    """Targets by dealing out and resharing, round after round."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        dealt = {s: left * weight[s] / total for s in open_} if open_ else {}
        over = [s for s in open_ if dealt[s] > ceiling * sizes[s]]
        if not over:
            return {**fixed, **dealt}
        for s in over:
            fixed[s] = ceiling * sizes[s]
            left -= fixed[s]


@pytest.fixture(scope="module")
def mixed(documents):
    rng = random.Random(4)
    sources = ["a"] * 6 + ["b", "B", "é", None, "tiny"]
    rows = [(i, " ".join(["w"] * rng.randrange(0, 200)), "en", rng.choice(sources)) for i in range(400)]
    rows += [(500, "one two", "en", "alone"), (501, None, "en", "empty"), (502, "w " * 9_000, "en", "long")]
    return rows, documents(rows)


def test_targets_and_taken_words(mixed):
    rows, docs = mixed
    found = mixture.mix_digest(docs, block_words=16).collect()
    assert mixture.mix_digest(docs, block_words=16).orderBy("doc_id").collect() == sorted(found, key=lambda r: r.doc_id)
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    targets = water_fill(sizes, [5.0, 2.0, 1.0], 1.5, 2.0)
    taken = Counter()
    assert sorted(r.doc_id for r in found) == sorted(size)
    for r in found:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s])
        assert r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, target in targets.items():
        assert target - 1 < taken[s] <= target + 1e-6, s
    assert sum(targets.values()) == pytest.approx(1.5 * sum(size.values()))


def test_the_schedule_is_even_and_reads_every_word_in_order(mixed):
    _, docs = mixed
    mix, targets = mixture.mix(mixture.prepare(docs), block_words=16)
    rows = mix.collect()
    share = {r.source: r.target for r in targets.collect()}
    total = sum(share.values())
    owner = {r.slot: r.source for r in rows}
    # Any run of slots holds each source close to its share.
    first = [owner[s] for s in sorted(owner)[: len(owner) // 4]]
    for s, target in share.items():
        assert abs(first.count(s) - len(first) * target / total) <= 12
    # Ranks follow the slots, and the words of a document are each read once a round.
    for s in share:
        ranks = [r.rank for r in sorted((r for r in rows if r.source == s), key=lambda r: (r.slot, r.round))]
        assert ranks == sorted(ranks)
    read = Counter()
    for r in rows:
        for w in range(r.from_word, r.to_word):
            read[r.twin, r.round, w] += 1
    assert max(read.values()) == 1


def test_hot_sources_are_ordered_in_chunks(mixed, monkeypatch):
    _, docs = mixed
    monkeypatch.setattr(mixture, "CHUNK_ROWS", 5)
    rows = mixture.mix_digest(docs, block_words=16).collect()
    by_source = Counter()
    for r in rows:
        by_source[r.target] += r.taken
    assert all(r.taken <= 2 * r.size for r in rows)
    assert abs(sum(by_source.values()) - 1.5 * sum(r.size for r in rows)) <= 200


def test_small_sources_take_their_targets(documents):
    """300 sources of 10 words beside one of 200,000, with slots of the default size."""
    rows = [(i, " ".join(["w"] * 10), "en", f"tiny{i:03}") for i in range(300)] + [(1000 + i, "v " * 400, "en", "large") for i in range(500)]
    found = mixture.mix_digest(documents(rows)).collect()
    taken, target = Counter(), {}
    for r in found:
        s = "large" if r.doc_id >= 1000 else r.doc_id
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken <= 2 * r.size
    assert len(target) == 301 and all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_slots_of_a_range_are_its_points_reversed(spark):
    rng = random.Random(3)
    for bits in (0, 1, 5, 9):
        cuts = sorted(rng.randrange(0, (1 << bits) + 1) for _ in range(2))
        wanted = sorted(int(f"{g:0{bits}b}"[::-1] or "0", 2) if bits else 0 for g in range(*cuts))
        ranks = spark.range(len(wanted)).select(mixture.slot_of(F.col("id"), F.lit(cuts[0]).cast("bigint"), F.lit(cuts[1]).cast("bigint"), bits).alias("s"))
        assert [r.s for r in ranks.collect()] == wanted


def test_odd_rows(odd):
    rows = mixture.mix_digest(odd).collect()
    assert len(rows) == 10
    assert {(r.doc_id, r.size) for r in rows} >= {(1, 0), (2, 0), (3, 0), (4, 1), (6, 4), (None, 4)}
    assert mixture.mix_digest(odd.where("false")).count() == 0
    assert [r.taken for r in mixture.mix_digest(odd.where("doc_id < 4")).collect()] == [0, 0, 0]
