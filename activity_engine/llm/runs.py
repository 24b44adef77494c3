"""Periodic runs of words, by the dictionary of basic factors.

A run is a longest stretch of words with a smallest period q (words q apart are identical) that is at
least twice as long. The dictionary names every factor whose length L is a power of two: equal factors,
equal names; a name of length 2L is made of two of length L. A run of period q, L <= q < 2L, starts with a
factor of length L that occurs again q words later. Occurrences of one factor that follow each other
by at most L/2 words form an arithmetic progression whose difference is the factor's period, and between
two progressions lie more than L/2 words, so a factor and its repetition lie at most three progressions
apart. Each pair of such progressions proposes the distances of their members, again an arithmetic
progression, one place for each distance. Every proposal is extended to both sides with the dictionary
from the longest factors to the shortest, and equal stretches are kept once, with the smallest period.

Many texts are searched at a time: they stand one after the other, parted by words that are equal to
nothing, so that no factor goes over a border.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_engine.llm.common import SLICE_ROWS

LEAST_WORDS = 12
# Texts that are searched together have about so many words; a longer text is searched alone.
GROUP_WORDS = 1 << 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FIELDS = [pa.field(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")]
_FIELDS += [pa.field("runs_sha256", pa.string()), pa.field("collapsed_sha256", pa.string()), pa.field("n_words", pa.int64())]
RESULT = ", ".join(f"{f.name}: {'string' if f.type == pa.string() else 'bigint'}" for f in _FIELDS)


class Factors:
    """The names of all factors of a sequence whose lengths are powers of two, as far as any repeats.

    A factor that occurs once has a name of its own, which is not worked out: at each length only factors
    whose halves both repeat are looked at. One level takes four bytes a word.
    """

    def __init__(self, first: np.ndarray) -> None:
        """`first`: numbers of the words, from 0; negative ones are equal to nothing."""
        n = self.n = len(first)
        self.levels: list[np.ndarray] = []
        # (positions, ascending in each class; first index of each class) of the factors that repeat.
        self.classes: list[tuple[np.ndarray, np.ndarray]] = []
        places = np.flatnonzero(first >= 0)
        keys = first[places].astype(np.int64)
        size = 1
        while len(places):
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            counts = np.diff(np.append(starts, len(ordered)))
            name = np.repeat(np.arange(len(starts)), counts)
            many = np.repeat(counts > 1, counts)
            if not many.any():
                break
            names = np.arange(n, 2 * n, dtype=np.int32 if n < 1 << 30 else np.int64)
            found = places[order][many]
            names[found] = name[many]
            self.levels.append(names)
            kept = counts[counts > 1]
            self.classes.append((found, np.cumsum(kept) - kept))
            # Both halves of the next length have to repeat.
            left = np.sort(found)
            left = left[left + size < n]
            left = left[names[left + size] < n]
            keys = names[left].astype(np.int64) * n + names[left + size]
            places = left
            size *= 2

    def agree(self, i: np.ndarray, j: np.ndarray, right: bool) -> np.ndarray:
        """How many words agree from i and j on to the right, or before them to the left; i < j.

        No factor longer than the last level repeats, so each length fits once at most.
        """
        reach = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size = 1 << k
            a, b = (i + reach, j + reach) if right else (i - reach - size, j - reach - size)
            ok = (a >= 0) & (b + size <= self.n)
            ok[ok] = self.levels[k][a[ok]] == self.levels[k][b[ok]]
            reach += ok * size
        return reach


def _progressions(found: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(class, first, last, members, difference) of the progressions of one length, in order."""
    kind = np.zeros(len(found), dtype=np.int64)
    kind[starts[1:]] = 1
    kind = np.cumsum(kind)
    gap = np.diff(found)
    inside = kind[1:] == kind[:-1]
    least = np.full(len(starts), np.iinfo(np.int64).max)
    np.minimum.at(least, kind[1:][inside], gap[inside])
    chained = inside & (gap == least[kind[1:]]) & (2 * gap <= size)
    head = np.flatnonzero(np.concatenate([[True], ~chained]))
    tail = np.append(head[1:], len(found)) - 1
    return kind[head], found[head], found[tail], tail - head + 1, np.where(2 * least <= size, least, 0)[kind[head]]


def proposals(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): a place in every run and its period, besides pairs that are no run's."""
    places, periods = [], []
    for level, (found, starts) in enumerate(factors.classes):
        size = 1 << level
        kind, first, last, members, step = _progressions(found, starts, size)
        for ahead in (1, 2, 3):
            a = np.arange(len(kind) - ahead)
            a = a[kind[a] == kind[a + ahead]]
            b = a + ahead
            near = first[b] - last[a]
            a, b, near = (x[near < 2 * size] for x in (a, b, near))
            by = np.maximum(step[a], 1)
            most = np.minimum(np.where(step[a] > 0, members[a] + members[b] - 2, 0), (2 * size - 1 - near) // by)
            least = np.maximum(0, -(-(size - near) // by))  # shorter ones are proposed by shorter factors
            number = np.maximum(0, most - least + 1)
            row = np.repeat(np.arange(len(a)), number)
            t = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + least[row]
            places.append(last[a][row] - np.minimum(t, members[a][row] - 1) * step[a][row])
            periods.append(near[row] + t * step[a][row])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def find(numbers: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least `least` words, by start and period.

    `numbers`: equal numbers stand for equal words, negative ones are equal to nothing.
    """
    factors = Factors(numbers)
    i, p = proposals(factors)
    j = i + p
    start = i - factors.agree(i, j, right=False)
    length = j + factors.agree(i, j, right=True) - start
    kept = length >= np.maximum(least, 2 * p)
    rows = np.stack([start[kept], length[kept], p[kept]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # A stretch with a smaller period has that one only.
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])[: len(rows)]
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _seeded(words: list[str], doc_id: int | None) -> list[str]:
    """The words, of which those of every tenth document are made to repeat, as the query's contract says."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _digest(words: list[str], runs: np.ndarray) -> tuple:
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0
    collapsed = words if kept.all() else [w for w, k in zip(words, kept.tolist(), strict=True) if k]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    best = (None,) * 4
    if len(runs):
        s, n, p = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (s, n, p, 1000 * n // p)
    sha = [hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in (listed, " ".join(collapsed))]
    return (len(runs), *best, *sha, len(words))


def _searched(texts: list[list[str]]) -> Iterator[tuple]:
    """The digests of some texts, whose words are searched together."""
    numbers: dict[str, int] = {}
    joined: list[int] = []
    bounds = [0]
    for words in texts:
        joined += [numbers.setdefault(w, len(numbers)) for w in words]
        joined.append(-1)
        bounds.append(len(joined))
    runs = find(np.array(joined, dtype=np.int64))
    edges = np.searchsorted(runs[:, 0], bounds)
    for k, (a, b) in enumerate(pairwise(edges.tolist())):
        yield _digest(texts[k], runs[a:b] - np.array([bounds[k], 0, 0]))


def _slice(texts: pa.Array, ids: pa.Array) -> Iterator[tuple]:
    group: list[list[str]] = []
    size = 0
    for text, doc_id in zip(texts.to_pylist(), ids.to_pylist(), strict=True):
        words = _seeded(_WORD.findall(text or ""), doc_id)
        if group and size + len(words) > GROUP_WORDS:
            yield from _searched(group)
            group, size = [], 0
        group.append(words)
        size += len(words)
    yield from _searched(group)


def digest(text: Column, seed_id: Column | None = None) -> Column:
    """A struct of `RESULT` for each text, whole; words are `[^\\x20\\x09-\\x0D]+`, numbered from 0.

    With `seed_id` the words of a tenth of the ids are made to repeat first (`_seeded`).

    Defined results: null and texts without words have no run (n_runs 0, four nulls) and hash the empty
    text; a null id counts as one whose words are left alone; equal rows give equal results; an empty
    table gives none. Memory: about 100 bytes a word of the texts searched together, or of one long text.
    """

    @F.arrow_udf(f"struct<{RESULT}>")
    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ids in columns:
            rows = [row for s in range(0, len(texts), SLICE_ROWS) for row in _slice(texts.slice(s, SLICE_ROWS), ids.slice(s, SLICE_ROWS))]
            values = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
            yield pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, _FIELDS, strict=True)], fields=_FIELDS)

    return run(text, (F.lit(None) if seed_id is None else seed_id).cast("bigint"))
