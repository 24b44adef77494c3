"""Quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of other signs; unigrams and bigrams of them are hashed
into a fixed number of weights; all bigrams of a token with itself are one feature. A feature's value is its damped count, and a text's values have length
one. The weights are learned from a bounded sample by FTRL-proximal, row by row, and a text's score is
one sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, fit_in_task, labelled_sample, mix64, pieces

BITS = 18
# Labelled rows per class, and characters of a row, that are learned from at most.
SAMPLE_DOCS = 2500
SAMPLE_CHARS = 20_000
# Rows learned from, one after the other; the two classes take turns.
UPDATES = 16_000
CACHE_WORDS = 200_000
# Hash of the bigram of a token with itself, whichever it is.
REPEATED = np.uint64(0x5F3C_91A2_77E4_0B1D)

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\x00-\x20A-Za-z0-9\x80-\xff]+")


class Hashes(dict):
    """64-bit hash of a token, remembered for a bounded number of tokens."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[token] = xxhash.xxh3_64_intdigest(token)
        return found


def features(text: str | None, hashes: Hashes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's unigrams and bigrams; nothing for a text without tokens."""
    tokens = _TOKEN.findall((text or "").encode("utf-8", "replace"))
    one = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    two = mix64(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])
    two[one[:-1] == one[1:]] = REPEATED
    places, counts = np.unique(np.concatenate([one, two]) >> np.uint64(64 - bits), return_counts=True)
    values = 1.0 + np.log(counts)
    return places.astype(np.int64), values / max(1e-12, float(np.sqrt((values * values).sum())))


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(
    rows: list[tuple[str, int]],
    bits: int = BITS,
    updates: int = UPDATES,
    alpha: float = 0.6,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
) -> np.ndarray:
    """Weights, the last one the bias, from (text, 0 or 1) rows. Without rows of both classes all are zero."""
    size = 1 << bits
    w, z, n = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if len({y for _, y in rows}) < 2:
        return w.astype(np.float32)
    hashes = Hashes()
    known = []
    for text, y in rows:
        places, values = features(text, hashes, bits)
        known.append((np.append(places, size), np.append(values, 0.3), y))
    rng = np.random.default_rng(7)
    classes = [rng.permutation([i for i, row in enumerate(known) if row[2] == y]) for y in (0, 1)]
    for turn in range(updates):
        own = classes[turn % 2]
        places, values, y = known[own[turn // 2 % len(own)]]
        zi, ni = z[places], n[places]
        wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
        g = (sigmoid(float(wi @ values)) - y) * values
        step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
        z[places] = zi + g - step * wi
        n[places] = ni + g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    w[size] *= 0.3
    return w.astype(np.float32)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", docs: int = SAMPLE_DOCS) -> np.ndarray:
    return fit_in_task(labelled_sample(documents, labels, label, docs, SAMPLE_CHARS), fit)


def score(text: Column, weights: np.ndarray) -> Column:
    """Probability of label 1 for a text column.

    Null and empty texts have no features and get the score of the bias alone. Every row is scored by
    itself; whole texts are read.
    """
    shared = Shared(weights)

    @F.arrow_udf("double")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, hashes = shared.get(), Hashes()
        bits = (len(w) - 1).bit_length() - 1
        for array, cuts in pieces(arrays):
            out = []
            for start, length in cuts:
                for text in array.slice(start, length).to_pylist():
                    places, values = features(text, hashes, bits)
                    out.append(float(sigmoid(float(w[places] @ values) + float(w[-1]))))
            yield pa.array(out, pa.float64())

    return run(text)
