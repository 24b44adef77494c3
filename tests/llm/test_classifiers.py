"""Toxicity and quality: gradients, held-out accuracy, windows, and the odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import quality, toxicity


def labelled(seed=2, n=240):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdeimnorst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rude = ["grobian", "grobisch", "swinett", "swinoso"]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 90))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), rng.choice(rude))
        low = i % 4 == 0
        if low:
            words = [w + "###" if k % 2 else w.upper() + "!!" for k, w in enumerate(words)]
        rows.append((i, " ".join(words), int(toxic), int(not low)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, documents):
    rows = labelled()
    docs = documents([r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(None, 1, 1), (9_999, 0, None)], "doc_id bigint, toxic int, quality int")
    return docs, labels, rows


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.fit([("nothing to learn", 0)])
    p = {k: v.astype(np.float64) for k, v in net.params.items() if k not in ("word", "char")}
    projected = rng.standard_normal((6, 6 * toxicity.HIDDEN))
    ids = np.array([[0, 1, 2, 3], [4, 2, -1, -1], [1, 1, 0, 2]])
    y = np.array([1.0, 0.0, 1.0])

    def loss(projected):
        z = toxicity._forward(p, projected, ids)[0].astype(np.float64)
        return float((np.logaddexp(0, z) - y * z).sum())

    kept = toxicity._forward(p, projected, ids, keep=True)
    grads, d_in = toxicity._backward(p, kept, 1 / (1 + np.exp(-kept[0])) - y, len(projected))
    for name in ("o", "v", "A", "Uf", "Ub", "c"):
        for at in list(np.ndindex(p[name].shape))[::7]:
            keep = p[name][at]
            p[name][at] = keep + 1e-3
            up = loss(projected)
            p[name][at] = keep - 1e-3
            down = loss(projected)
            p[name][at] = keep
            assert grads[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-3), name
    for at in [(0, 0), (2, 9), (1, 30), (4, 47)]:
        keep = projected[at]
        projected[at] = keep + 1e-3
        up = loss(projected)
        projected[at] = keep - 1e-3
        down = loss(projected)
        projected[at] = keep
        assert d_in[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_windows_cover_every_word():
    lengths = np.array([0, 1, toxicity.WINDOW, toxicity.WINDOW + 1, 100, 0, 5])
    at, text = toxicity.windows(lengths)
    starts = np.cumsum(lengths) - lengths
    for k, n in enumerate(lengths):
        own = at[text == k]
        seen = sorted(set(own[own >= 0].tolist()))
        assert seen == list(range(starts[k], starts[k] + n))
        if n > toxicity.WINDOW:
            assert (own >= 0).all() and len(own) == 1 + -(-(n - toxicity.WINDOW) // toxicity.STRIDE)


def test_toxicity_on_held_out_rows(tables, odd):
    docs, labels, rows = tables
    net = toxicity.train(docs, labels.where("doc_id % 4 > 0"))
    truth = {r[0]: r[2] for r in rows}
    found = {r.doc_id: r.s for r in docs.where("doc_id % 4 = 0").select("doc_id", toxicity.score(F.col("text"), net).alias("s")).collect()}
    assert np.mean([(s >= 0.5) == truth[i] for i, s in found.items()]) >= 0.9
    scores = {r.doc_id: r.s for r in odd.select("doc_id", toxicity.score(F.col("text"), net).alias("s")).collect()}
    assert scores[1] == scores[2] == scores[3] == 0 and all(0 <= s <= 1 for s in scores.values())
    assert odd.where("false").select(toxicity.score(F.col("text"), net)).count() == 0


def test_a_rude_word_anywhere_in_a_long_text_counts(tables, documents):
    docs, labels, rows = tables
    net = toxicity.train(docs, labels)
    clean = " ".join(r[1] for r in rows if not r[2] and r[3])
    words = clean.split()
    middle = " ".join([*words[: len(words) // 2], "swinett grobian", *words[len(words) // 2 :]])
    score = {r.doc_id: r.s for r in documents([(1, middle), (2, middle.upper())]).select("doc_id", toxicity.score(F.col("text"), net).alias("s")).collect()}
    assert score[1] >= 0.5 and score[2] == score[1]


def test_quality_on_held_out_rows(tables, odd):
    docs, labels, rows = tables
    weights = quality.train(docs, labels.where("doc_id % 5 > 0"))
    truth = {r[0]: r[3] for r in rows}
    found = {r.doc_id: r.s for r in docs.where("doc_id % 5 = 0").select("doc_id", quality.score(F.col("text"), weights).alias("s")).collect()}
    assert np.mean([(s >= 0.3) == truth[i] for i, s in found.items()]) >= 0.95
    scores = [r.s for r in odd.select(quality.score(F.col("text"), weights).alias("s")).collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)


def test_quality_score_is_the_dot_product(tables, documents, monkeypatch):
    docs, labels, _ = tables
    weights = quality.train(docs, labels)
    text = "one two two THREE!! one"
    places, values = quality.features(text, quality.Hashes())
    assert np.sqrt((values**2).sum()) == pytest.approx(1)
    expected = 1 / (1 + np.exp(-(sum(weights[p] * v for p, v in zip(places, values)) + weights[-1])))
    monkeypatch.setattr(quality, "CACHE_WORDS", 2)
    (row,) = documents([(1, text)]).select(quality.score(F.col("text"), weights).alias("s")).collect()
    assert row.s == pytest.approx(expected, abs=1e-6)


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "text")])
    none = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, toxic int, quality int")
    for labels in (none, none.where("false")):
        (row,) = docs.select(toxicity.score(F.col("text"), toxicity.train(docs, labels)).alias("t"), quality.score(F.col("text"), quality.train(docs, labels)).alias("q")).collect()
        assert 0 <= row.t < 0.5 and row.q == 0.5


def test_forward_pass_matches_a_plain_one():
    """Both directions, attention pooling and the logit, one word and one window at a time."""
    import math

    rng = np.random.default_rng(4)
    hidden, width = toxicity.HIDDEN, toxicity.WORD_DIM + toxicity.CHAR_DIM
    shapes = {
        "Wf": (width, 3 * hidden), "Wb": (width, 3 * hidden), "Uf": (hidden, 3 * hidden), "Ub": (hidden, 3 * hidden), "bf": (3 * hidden,),
        "bb": (3 * hidden,), "A": (2 * hidden, toxicity.ATTENTION), "v": (toxicity.ATTENTION,), "o": (2 * hidden,), "c": (1,),
    }
    p = {k: rng.normal(size=s).astype(np.float32) * np.float32(0.4) for k, s in shapes.items()}
    words = np.concatenate([rng.normal(size=(5, width)), np.zeros((1, width))]).astype(np.float32)
    windows = [[0, 1, 2, 3], [4], [2, 2, 2, 2, 1, 0]]
    ids = np.full((3, 6), -1)
    for k, w in enumerate(windows):
        ids[k, : len(w)] = w

    def gate(x):
        return 1 / (1 + math.exp(-x))

    def run(inputs, w, u, b):
        h, out = [0.0] * hidden, []
        for x in inputs:
            a = x @ p[w] + p[b]
            g = np.array(h) @ p[u]
            new = []
            for i in range(hidden):
                z, r = gate(a[i] + g[i]), gate(a[hidden + i] + g[hidden + i])
                c = math.tanh(a[2 * hidden + i] + r * g[2 * hidden + i])
                new.append((1 - z) * c + z * h[i])
            h = new
            out.append(h)
        return out

    network = toxicity.Network({**p, "word": np.zeros((1, 1)), "char": np.zeros((1, 1))})
    found = network.logits(network.project(words), ids)
    for k, w in enumerate(windows):
        # Blank words stand behind a short window: the backward pass comes through them first.
        inputs = [words[i] for i in w] + [words[5]] * (6 - len(w))
        ahead, behind = run(inputs, "Wf", "Uf", "bf"), run(inputs[::-1], "Wb", "Ub", "bb")[::-1]
        states = [np.array(a + b) for a, b in zip(ahead, behind)][: len(w)]
        scores = [math.exp(float(np.tanh(s @ p["A"]) @ p["v"])) for s in states]
        pooled = sum(e / sum(scores) * s for e, s in zip(scores, states))
        assert found[k] == pytest.approx(float(pooled @ p["o"] + p["c"][0]), abs=1e-4)


def test_ftrl_matches_a_plain_one():
    """Updates coordinate by coordinate with dictionaries, in the same order of rows."""
    import math

    rows = [(f"good words number {i % 3} and {i}", 1) for i in range(6)] + [(f"bad noise {i % 2} {i} !!", 0) for i in range(5)]
    settings = {"bits": 10, "updates": 60, "alpha": 0.6, "beta": 1.0, "l1": 0.02, "l2": 0.01}
    found = quality.fit(rows, **settings)
    hashes, size = quality.Hashes(), 1 << 10
    rng = np.random.default_rng(7)
    orders = [rng.permutation([i for i, r in enumerate(rows) if r[1] == y]).tolist() for y in (0, 1)]
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= 0.02 else -(zi - math.copysign(0.02, zi)) / ((1.0 + math.sqrt(n.get(i, 0.0))) / 0.6 + 0.01)

    for turn in range(60):
        order = orders[turn % 2]
        text, y = rows[order[turn // 2 % len(order)]]
        places, values = quality.features(text, hashes, 10)
        active = [*zip(places.tolist(), values.tolist()), (size, 0.3)]
        error = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in active))) - y
        for i, v, w in [(i, v, weight(i)) for i, v in active]:
            g = error * v
            step = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / 0.6
            z[i], n[i] = z.get(i, 0.0) + g - step * w, n.get(i, 0.0) + g * g
    for i in range(size):
        assert found[i] == pytest.approx(weight(i), abs=1e-5)
    assert found[size] == pytest.approx(0.3 * weight(size), abs=1e-5) and np.count_nonzero(found) > 10
