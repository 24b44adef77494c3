"""Vector codes against plain assigning and averaging, and the trees against looking at every point."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction
from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from activity_engine.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, block binary"


def brute(rows, parts=8, entries=16, rounds=6):
    """The contract's rows, one part at a time in Python's whole numbers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cuts = []
    for _, v, _ in kept:
        w = [floor(Fraction(float(np.float32(x))) * 4096) for x in v]
        w += [0] * (parts * width - len(w))
        cuts.append([w[p * width : (p + 1) * width] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cuts[k][p] for k in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p in range(parts):
            held = defaultdict(list)
            for c in cuts:
                held[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [
                [sum(col) // len(held[k]) for col in zip(*held[k], strict=True)] if held[k] else e for k, e in enumerate(books[p])
            ]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, by_label = [], defaultdict(int)
    for (i, _, label), c in zip(kept, cuts, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] += error
        found.append((i, label, "".join(f"{k:02x}" for _, k in best), error))
    return [(i, code, error, by_label[label], sha) for i, label, code, error in found]


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, label, "x", "y", b"z") for i, v, label in rows], SCHEMA)
    return sorted(map(tuple, codes.code_digest(frame.repartition(3), **settings).collect()), key=str)


def cluster(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    v = centers[rng.integers(6, size=n)] + rng.normal(size=(n, dim)) * 0.2
    return [(int(i), [float(x) for x in row], int(i) % 3 if i % 7 else None) for i, row in enumerate(v.astype(np.float32))]


def test_agrees_with_plain_rounds(spark):
    rows = cluster(700)
    assert run(spark, rows, block_rows=256) == sorted(brute(rows), key=str)


def test_ties_copies_and_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    grid = rng.integers(-2, 3, size=(300, 16)) / 4096
    rows = [(int(i), [float(x) for x in v], 1) for i, v in enumerate(grid)]
    rows += [(1000 + i, [0.25] * 16, 2) for i in range(300)]
    rows += [rows[3], rows[3], (None, [0.5] * 16, 2)]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    rows = [
        (5, [0.1, -0.1, 0.3], 1), (1, None, 1), (2, [None, 1.0, 1.0], 1), (3, [nan, 1.0, 1.0], 1), (4, [inf, 0.0, 0.0], 1),
        (6, [], None), (7, [-0.00001] * 9, None), (8, [-inf], 2), (None, [1.0], 1),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, [r for r in rows if r[0] in (1, 2, 3, 4)]) == [] == run(spark, [])


def test_trees_own_every_point_once_and_rule_out_entries():
    rng = np.random.default_rng(9)
    points = (np.concatenate([rng.normal(size=(3000, 8)) * 40 + c for c in rng.normal(size=(8, 8)) * 3000])).astype(np.int64)
    tree = codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for lo, hi, child, total, c, r in zip(tree.lo, tree.hi, tree.child, tree.sums, tree.center, tree.radius, strict=True):
        x = points[tree.order[lo:hi]]
        assert (x.sum(axis=0) == total).all() and (np.sqrt(((x - c) ** 2).sum(axis=1)) <= r + 1e-6).all()
        if child[0] >= 0:
            assert (tree.lo[child[0]], tree.hi[child[0]], tree.hi[child[1]]) == (lo, tree.lo[child[1]], hi)
    book = points[rng.choice(len(points), 16, replace=False)]
    owned = seen = 0
    for nodes, entry, _ in tree.walk(book):
        sizes = (tree.hi - tree.lo)[nodes]
        owned += sizes[entry >= 0].sum()
        seen += sizes.sum()
    assert seen == len(points) and owned > 0.2 * seen


@pytest.mark.parametrize("dim", [8, 24])
def test_blocks_agree_with_every_distance(dim):
    rng = np.random.default_rng(dim)
    vectors = rng.integers(-300, 300, size=(900, 8, dim // 8))
    vectors[:200] = vectors[0]
    books = vectors[rng.choice(900, 16, replace=False)].transpose(1, 0, 2)
    block = codes.Block(list(range(900)), [None] * 900, vectors, leaf=10)
    found, errors = block.codes(books)
    d = ((vectors[:, :, None] - books[None]) ** 2).sum(axis=3)
    assert (found == d.argmin(axis=2)).all() and (errors == d.min(axis=2).sum(axis=1)).all()
    sums = block.sums(books)
    for p in range(8):
        for e in range(16):
            own = vectors[found[:, p] == e, p]
            assert (sums[p, e, :-1] == own.sum(axis=0)).all() and sums[p, e, -1] == len(own)
