"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the embedding of its hash beside the mean embedding of its character n-grams. A
window of words runs through two gated recurrent layers, one in each direction; attention pools their
states and a logistic unit gives the window's logit. All overlapping windows of a text are scored and
the largest logit counts, turned into a probability by a scale and shift fitted on the sample.

Labels belong to whole texts, so training picks windows: in each round the window of each text with the
largest logit is learned from. Embeddings start from the log-odds of their n-gram among the labelled
texts, which tells the first round where to look.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, fit_in_task, labelled_sample, mix64, pieces

WINDOW, STRIDE = 32, 16
WORD_BITS, CHAR_BITS = 14, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 6, 10, 8, 8
CHAR_GRAMS = (3, 4, 5, 6)
# Labelled rows per class, and characters of a row, that are learned from at most.
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
ROUNDS, STEPS, BATCH, RATE = 5, 60, 96, 0.01
CACHE_WORDS = 100_000
CHUNK = 1024  # windows that run through the network together

_TO_SPACE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case runs of ASCII letters and of anything beyond ASCII."""
    return (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed place of each word; places of all character n-grams, and the word that each belongs to."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(64 - WORD_BITS)
    joined = np.frombuffer(b"\x01" + b"\x02\x01".join(words) + b"\x02", dtype=np.uint8)
    word = np.cumsum(joined == 1) - 1
    places, owners = [], []
    h = np.zeros(len(joined), dtype=np.uint64)
    inside = np.ones(len(joined), dtype=bool)
    for n in range(1, max(CHAR_GRAMS) + 1):
        # n bytes that start here, as far as they stay inside the word.
        size = len(joined) - n + 1
        if size <= 0:
            break
        h = mix64(h[:size] * np.uint64(0x100000001B3) + joined[n - 1 :].astype(np.uint64) + np.uint64(n))
        inside = inside[:size] & (word[n - 1 :] == word[:size])
        if n in CHAR_GRAMS:
            at = np.flatnonzero(inside)
            places.append((h[at] >> np.uint64(64 - CHAR_BITS)).astype(np.int64))
            owners.append(word[at])
    # Every word has an n-gram: one of a single byte makes one with its two marks.
    return own.astype(np.int64), np.concatenate(places), np.concatenate(owners)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.float32(1.0) + np.tanh(np.float32(0.5) * x))


@dataclass
class Network:
    params: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    def embed(self, words: list[bytes]) -> np.ndarray:
        own, places, owner = word_inputs(words)
        chars = np.zeros((len(words), CHAR_DIM), dtype=np.float32)
        for k in range(CHAR_DIM):
            chars[:, k] = np.bincount(owner, self.params["char"][places, k], len(words))
        chars /= np.maximum(1, np.bincount(owner, minlength=len(words)))[:, None].astype(np.float32)
        return np.concatenate([self.params["word"][own], chars], axis=1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input part of both directions' gates; what is remembered for each word."""
        p = self.params
        return np.concatenate([x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]], axis=1)

    def logits(self, projected: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Logit of each window; `ids` has the words of the windows, -1 where a window has ended."""
        out = [_forward(self.params, projected, ids[i : i + CHUNK])[0] for i in range(0, len(ids), CHUNK)]
        return np.concatenate(out) if out else np.zeros(0, dtype=np.float32)

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * logit.astype(np.float64) + self.shift, -35, 35)))


def _forward(p: dict[str, np.ndarray], projected: np.ndarray, ids: np.ndarray, keep: bool = False):
    n, steps = ids.shape
    mask = ids >= 0
    blank = projected.shape[0] - 1  # the last row is the blank word
    at = np.where(mask, ids, blank)
    states = np.zeros((2, steps, n, HIDDEN), dtype=np.float32)
    trace = []
    for way, (u, off) in enumerate((("Uf", 0), ("Ub", 3 * HIDDEN))):
        h, matrix = np.zeros((n, HIDDEN), dtype=np.float32), p[u]
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            x = projected[at[:, t], off : off + 3 * HIDDEN]
            g = h @ matrix
            zr = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            if keep:
                trace.append((way, t, h, z, r, c, g[:, 2 * HIDDEN :]))
            h = new
            states[way, t] = h
    both = np.concatenate([states[0], states[1]], axis=2).transpose(1, 0, 2)
    hidden = np.tanh(both @ p["A"])
    weight = np.where(mask, hidden @ p["v"], np.float32(-1e9))
    weight = np.exp(weight - weight.max(axis=1, keepdims=True)) * mask
    weight /= np.maximum(weight.sum(axis=1, keepdims=True), np.float32(1e-9))
    pooled = np.einsum("nt,nth->nh", weight, both)
    logit = pooled @ p["o"] + p["c"][0]
    return (logit, both, hidden, weight, pooled, trace, at) if keep else (logit,)


def _backward(p: dict[str, np.ndarray], kept: tuple, gradient: np.ndarray, rows: int):
    """Gradients of the parameters and of the projected inputs."""
    _, both, hidden, weight, pooled, trace, at = kept
    grads = {"o": pooled.T @ gradient, "c": np.array([gradient.sum()], dtype=np.float32)}
    d_pooled = gradient[:, None] * p["o"]
    d_both = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = np.einsum("nth,nh->nt", both, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    grads["v"] = np.einsum("nt,nta->a", d_score, hidden)
    d_hidden = d_score[:, :, None] * p["v"] * (1 - hidden * hidden)
    grads["A"] = np.einsum("nth,nta->ha", both, d_hidden)
    d_both = d_both + d_hidden @ p["A"].T
    d_input = np.zeros((rows, 6 * HIDDEN), dtype=np.float32)
    grads["Uf"], grads["Ub"] = np.zeros_like(p["Uf"]), np.zeros_like(p["Ub"])
    carry = [np.zeros((len(gradient), HIDDEN), dtype=np.float32) for _ in range(2)]
    for way, t, h, z, r, c, gc in reversed(trace):
        u = "Uf" if way == 0 else "Ub"
        d = carry[way] + d_both[:, t, way * HIDDEN : (way + 1) * HIDDEN]
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (h - c) * z * (1 - z)
        dr = dc * gc * r * (1 - r)
        d_gate = np.concatenate([dz, dr, dc * r], axis=1)
        grads[u] += h.T @ d_gate
        carry[way] = d * z + d_gate @ p[u].T
        np.add.at(d_input[:, way * 3 * HIDDEN : (way + 1) * 3 * HIDDEN], at[:, t], np.concatenate([dz, dr, dc], axis=1))
    return grads, d_input


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places of all windows of texts that stand one after the other, and the text of each window.

    Windows start every STRIDE words; the last one ends with the text. Texts without words have none.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    number = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), number)
    k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    first = np.minimum(k * STRIDE, np.maximum(0, lengths[text] - WINDOW))
    within = first[:, None] + np.arange(WINDOW)
    base = (np.cumsum(lengths) - lengths)[text]
    return np.where(within < lengths[text][:, None], base[:, None] + within, -1), text


def _log_odds(places: np.ndarray, positive: np.ndarray, negative: np.ndarray, size: int, docs: tuple[int, int]) -> np.ndarray:
    a = np.bincount(places, positive, size) + 1.0
    b = np.bincount(places, negative, size) + 1.0
    sure = (a + b - 2) / (a + b + 3)  # n-grams of few texts say little
    return (sure * np.clip(np.log(a / b) - np.log((docs[0] + 1) / (docs[1] + 1)), -3, 3)).astype(np.float32)


def fit(rows: list[tuple[str, int]], seed: int = 11) -> Network:
    """A network from (text, 0 or 1) rows; without both classes one that scores every text just under 0.5."""
    rng = np.random.default_rng(seed)

    def some(*shape: int, size: float) -> np.ndarray:
        return (rng.standard_normal(shape) * size).astype(np.float32)

    width = WORD_DIM + CHAR_DIM
    p = {
        "word": some(1 << WORD_BITS, WORD_DIM, size=0.05), "char": some(1 << CHAR_BITS, CHAR_DIM, size=0.05),
        "Wf": some(width, 3 * HIDDEN, size=0.35), "Wb": some(width, 3 * HIDDEN, size=0.35),
        "Uf": some(HIDDEN, 3 * HIDDEN, size=0.25), "Ub": some(HIDDEN, 3 * HIDDEN, size=0.25),
        "bf": np.zeros(3 * HIDDEN, np.float32), "bb": np.zeros(3 * HIDDEN, np.float32),
        "A": some(2 * HIDDEN, ATTENTION, size=0.35), "v": some(ATTENTION, size=0.5),
        "o": some(2 * HIDDEN, size=0.3), "c": np.zeros(1, np.float32),
    }
    network = Network(p)
    texts = [(words_of(t), y) for t, y in rows]
    texts = [(w, y) for w, y in texts if w]
    labels = np.array([y for _, y in texts], dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        network.scale, network.shift = 0.0, -0.01
        return network
    ids: dict[bytes, int] = {}
    flat = np.array([ids.setdefault(w, len(ids)) for ws, _ in texts for w in ws], dtype=np.int64)
    vocabulary, lengths = list(ids), np.array([len(ws) for ws, _ in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    pairs = np.unique(owner * len(ids) + flat)
    seen, y = pairs % len(ids), labels[pairs // len(ids)]
    positive, negative = np.bincount(seen, y, len(ids)), np.bincount(seen, 1 - y, len(ids))
    docs = (int(labels.sum()), int((1 - labels).sum()))
    own, grams, gram_word = word_inputs(vocabulary)
    p["word"][:, 0] = _log_odds(own, positive, negative, 1 << WORD_BITS, docs)
    p["char"][:, 0] = _log_odds(grams, positive[gram_word], negative[gram_word], 1 << CHAR_BITS, docs)
    order = np.argsort(gram_word, kind="stable")
    grams, starts = grams[order], np.searchsorted(gram_word[order], np.arange(len(ids) + 1))
    at, text = windows(lengths)
    ids_of = np.where(at >= 0, flat[at], -1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    tick = 0
    best = np.zeros(len(texts), dtype=np.int64)
    for turn in range(ROUNDS + 1):
        projected = network.project(np.concatenate([network.embed(vocabulary), np.zeros((1, width), np.float32)]))
        if turn == 0:
            # The window with the most telling words; later the one the network finds.
            tell = network.embed(vocabulary)[:, [0, WORD_DIM]].sum(axis=1)
            logit = np.where(ids_of >= 0, tell[ids_of], -9).max(axis=1)
        else:
            logit = network.logits(projected, ids_of)
        ranked = np.lexsort((logit, text))
        best = ranked[np.searchsorted(text[ranked], np.arange(len(texts)), side="right") - 1]
        if turn == ROUNDS:
            break
        for _ in range(STEPS):
            chosen = rng.integers(0, len(texts), BATCH)
            pick = best[chosen]
            plain = rng.random(BATCH) < 0.3  # any window of a clean text is clean
            clean = np.flatnonzero((labels[chosen] == 0) & plain)
            lo = np.searchsorted(text, chosen[clean])
            hi = np.searchsorted(text, chosen[clean], side="right")
            pick[clean] = lo + (rng.random(len(clean)) * (hi - lo)).astype(np.int64)
            batch = ids_of[pick]
            used, local = np.unique(batch[batch >= 0], return_inverse=True)
            here = np.full(batch.shape, -1)
            here[batch >= 0] = local
            counts = starts[used + 1] - starts[used]
            spots = grams[np.repeat(starts[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
            member = np.repeat(np.arange(len(used)), counts)
            chars = np.zeros((len(used), CHAR_DIM), np.float32)
            np.add.at(chars, member, p["char"][spots])
            chars /= counts[:, None].astype(np.float32)
            x = np.concatenate([np.concatenate([p["word"][own[used]], chars], axis=1), np.zeros((1, width), np.float32)])
            kept = _forward(p, network.project(x), here, keep=True)
            error = ((1 / (1 + np.exp(-kept[0]))) - labels[chosen]).astype(np.float32) / BATCH
            grads, d_in = _backward(p, kept, error, len(x))
            df, db = d_in[:, : 3 * HIDDEN], d_in[:, 3 * HIDDEN :]
            grads["Wf"], grads["bf"], grads["Wb"], grads["bb"] = x.T @ df, df.sum(axis=0), x.T @ db, db.sum(axis=0)
            dx = (df @ p["Wf"].T + db @ p["Wb"].T)[:-1]
            tick += 1
            _adam(p, moments, grads, tick)
            rate = np.float32(RATE * 5)
            np.add.at(p["word"], own[used], -rate * dx[:, :WORD_DIM])
            np.add.at(p["char"], spots, -rate * (dx[:, WORD_DIM:] / counts[:, None].astype(np.float32))[member])
    network.scale, network.shift = _calibrate(logit[best].astype(np.float64), labels)
    return network


def _adam(p: dict, moments: dict, grads: dict, tick: int) -> None:
    for name, g in grads.items():
        m, s = moments[name]
        m *= 0.9
        m += 0.1 * g
        s *= 0.999
        s += 0.001 * g * g
        p[name] -= (RATE * (m / (1 - 0.9**tick)) / (np.sqrt(s / (1 - 0.999**tick)) + 1e-8)).astype(np.float32)


def _calibrate(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the sample's logits, both classes counting alike."""
    middle, spread = float(np.median(logit)), float(logit.std()) or 1.0
    x = (logit - middle) / spread
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        e, h = weight * (q - labels), weight * q * (1 - q)
        ga, gb = (e * x).sum() + 1e-3 * a, e.sum()
        haa, hab, hbb = (h * x * x).sum() + 1e-3, (h * x).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab + 1e-12
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return float(max(a, 1e-3) / spread), float(b - max(a, 1e-3) * middle / spread)


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", docs: int = SAMPLE_DOCS) -> Network:
    return fit_in_task(labelled_sample(documents, labels, label, docs, SAMPLE_CHARS), fit)


def score(text: Column, network: Network) -> Column:
    """Probability of label 1 for a text column: that of its worst window.

    A null text, or one without words, has no window and scores 0. Every row is scored by itself.
    """
    shared = Shared(network)

    @F.arrow_udf("double")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.get()
        blank = net.project(np.zeros((1, WORD_DIM + CHAR_DIM), np.float32))
        ids: dict[bytes, int] = {}
        table = np.zeros((0, 6 * HIDDEN), np.float32)
        for array, cuts in pieces(arrays):
            out = []
            for start, length in cuts:
                texts = [words_of(t) for t in array.slice(start, length).to_pylist()]
                flat = [w for ws in texts for w in ws]
                new = [w for w in set(flat) if w not in ids]
                if len(ids) + len(new) > CACHE_WORDS:
                    ids, new, table = {}, list(set(flat)), table[:0]
                if new:
                    ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
                    table = np.concatenate([table, net.project(net.embed(new))])
                known = np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))
                scores = np.zeros(len(texts))
                at, text_no = windows(np.array([len(ws) for ws in texts]))
                if len(at):
                    rows = np.concatenate([table, blank])
                    logit = np.full(len(texts), -np.inf)
                    np.maximum.at(logit, text_no, net.logits(rows, np.where(at >= 0, known[at], -1)).astype(np.float64))
                    some = np.isfinite(logit)
                    scores[some] = net.probability(logit[some])
                out.append(scores)
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return run(text)
