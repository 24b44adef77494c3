"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Every benchmark item keeps its rarest n-grams as seeds: ordered by the number of documents that have
them, the first `KEPT` share. The share is relative, so an item that leaked into very many documents
keeps seeds too. A document that has a seed of an item is aligned with it around the seed; the score is
the best local alignment's, as a share of the item's own, so edits, gaps and changed words cost little.

Benchmark items are dealt with in blocks of a fixed number of words, and each block is sent to the
executors whole. Documents are read twice per block and never move: first to count seeds, then to seed
and align. Nothing is grouped by item or n-gram, so a passage in a third of all documents is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, slices

SEED_WORDS = 3
KEPT = 0.75
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
# Items with fewer words leak only where all their words stand.
FEW_WORDS = 8
# Words of a block of items; about 20 bytes each are sent to every executor.
BLOCK_WORDS = 1 << 19
# Alignments that are filled together.
TOGETHER = 128

_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))

RESULT = "doc_id bigint, item_id bigint, score double, from_word bigint, to_word bigint, seeds bigint"


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of letters and digits; other ASCII signs part them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


@dataclass
class Block:
    """Benchmark items as numbers of their words, and their n-grams as sorted keys."""

    ids: list[int]
    items: list[np.ndarray]
    numbers: dict[bytes, int]
    keys: np.ndarray = field(default=None)  # distinct n-grams, sorted
    owner: np.ndarray = field(default=None)  # items and places of each n-gram, by n-gram
    place: np.ndarray = field(default=None)
    start: np.ndarray = field(default=None)
    sizes: list[int] = field(default_factory=list)  # words that the n-grams really have
    rare: np.ndarray | None = None  # whether (n-gram, item) is a seed

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Block:
        numbers: dict[bytes, int] = {}
        texts = [(i, words_of(t)) for i, t in rows]
        texts = [(i, w) for i, w in texts if w]
        items = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in ws], dtype=np.int64) for _, ws in texts]
        block = cls([i for i, _ in texts], items, numbers)
        block.sizes = sorted({min(SEED_WORDS, len(item)) for item in items})
        keys, owner, place = [], [], []
        for k, item in enumerate(items):
            own = block.grams(item)
            keys.append(own), owner.append(np.full(len(own), k)), place.append(np.arange(len(own)))
        if not items:
            keys, owner, place = ([np.zeros(0, np.int64)] for _ in range(3))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        block.keys, first = np.unique(flat[order], return_index=True)
        block.owner, block.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        block.start = np.append(first, len(flat))
        return block

    def number(self, words: list[bytes]) -> np.ndarray:
        """Numbers of a document's words; 0 for a word that no item has."""
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))

    def grams(self, words: np.ndarray) -> np.ndarray:
        """Key of the n-gram at each place; 0 where a word is unknown. Short items are padded with 0 words.

        The keys of up to three word numbers below 2^21 are exact.
        """
        padded = np.concatenate([words, np.zeros(max(0, SEED_WORDS - len(words)), np.int64)])
        size = len(padded) - SEED_WORDS + 1
        key = np.zeros(size, dtype=np.int64)
        for k in range(SEED_WORDS):
            key = (key << 21) | padded[k : k + size]
        return key

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known n-grams in a document, and which they are."""
        if not len(words) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # An item of fewer words than a seed has has 0 for the words it lacks.
        known = np.flatnonzero(words)
        if not len(known):
            return known, known
        padded = np.concatenate([words, np.zeros(SEED_WORDS - 1, np.int64)])
        found_at, found = [], []
        for size in self.sizes:
            at = known
            for k in range(1, size):
                at = at[padded[at + k] > 0]
            key = np.zeros(len(at), dtype=np.int64)
            for k in range(SEED_WORDS):
                key = (key << 21) | (padded[at + k] if k < size else 0)
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[i] == key
            found_at.append(at[hit]), found.append(i[hit])
        return np.concatenate(found_at), np.concatenate(found)

    def keep_rare(self, documents_with: np.ndarray) -> None:
        """Mark each item's rarest n-grams; equally rare ones go by their key."""
        gram = np.repeat(np.arange(len(self.keys)), np.diff(self.start))
        order = np.lexsort((gram, documents_with[gram], self.owner))
        owner = self.owner[order]
        rank = np.arange(len(order)) - np.searchsorted(owner, owner)
        of = np.bincount(self.owner, minlength=len(self.items))[owner]
        self.rare = np.zeros(len(order), dtype=bool)
        self.rare[order] = rank < np.ceil(KEPT * of)


def align(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each row of two matrices of word numbers: score, and its end and start in `second`.

    0 in `second` (a word the block does not know) and -1 (past the end) match nothing. Cells are filled
    word by word of `second`, for all rows at once; a running maximum stands in for gaps within a column.
    """
    n, m = first.shape
    steps = np.arange(m + 1, dtype=np.int32)
    score = np.zeros((n, m + 1), dtype=np.int32)
    origin = np.zeros((n, m + 1), dtype=np.int32)  # where in `second` the cell's alignment begins
    best, end, begin = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows = np.arange(n)
    for j in range(second.shape[1]):
        word = second[:, j : j + 1]
        step = np.where((first == word) & (word > 0), MATCH, MISMATCH)
        through = score[:, :-1] + step
        came = np.where(score[:, :-1] > 0, origin[:, :-1], j)
        beside = score[:, 1:] + GAP
        new, start = np.zeros_like(score), np.full_like(origin, j)
        take = through >= beside
        new[:, 1:] = np.maximum(0, np.where(take, through, beside))
        start[:, 1:] = np.where(take, came, origin[:, 1:])
        # Gaps in `second`: a cell may come from any cell above it, a GAP for each step.
        lifted = new - GAP * steps
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == top, steps, 0), axis=1)
        gapped = top + GAP * steps
        start = np.where(gapped > new, np.take_along_axis(start, source.astype(np.int64), axis=1), start)
        score, origin = np.maximum(new, gapped), start
        at = score.argmax(axis=1)
        value = score[rows, at]
        better = value > best
        best[better], end[better], begin[better] = value[better], j + 1, origin[rows, at][better]
    return best, begin, end


def _documents_with(documents: DataFrame, block: Block) -> np.ndarray:
    """Number of documents that have each n-gram of the block."""
    shared = Shared(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        seen = np.zeros(len(own.keys), dtype=np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                seen[np.unique(own.hits(own.number(words))[1])] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(at, pa.int64()), "n": pa.array(seen[at], pa.int64())})

    counted = documents.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n"))
    out = np.zeros(len(block.keys), dtype=np.int64)
    for gram, n in counted.collect():
        out[gram] = n
    return out


def candidates(block: Block, words: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(item, from, to, seeds): stretches of a document that its seeds say an item may stand in."""
    at, gram = block.hits(words)
    if not len(at):
        return []
    counts = block.start[gram + 1] - block.start[gram]
    entry = np.repeat(block.start[gram] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    kept = block.rare[entry]
    item, spot = block.owner[entry[kept]], np.repeat(at, counts)[kept] - block.place[entry[kept]]
    found: list[tuple[int, int, int, int]] = []
    for k in np.argsort(item * (len(words) + 1_000_000) + spot, kind="stable").tolist():
        i, size = int(item[k]), len(block.items[item[k]])
        slack = size // 2 + 2
        lo, hi = max(0, int(spot[k]) - slack), min(len(words), int(spot[k]) + size + slack)
        if found and found[-1][0] == i and lo <= found[-1][2] and hi - found[-1][1] <= 4 * size + 8:
            found[-1] = (i, found[-1][1], max(found[-1][2], hi), found[-1][3] + 1)
        else:
            found.append((i, lo, hi, 1))
    return found


def _aligned(block: Block, jobs: list[tuple[int, np.ndarray, tuple[int, int, int, int]]]) -> Iterator[tuple]:
    """(document row, item, score, from, to, seeds) of each candidate whose score is enough."""
    jobs.sort(key=lambda job: (len(block.items[job[2][0]]), job[2][2] - job[2][1]))
    for start in range(0, len(jobs), TOGETHER):
        part = jobs[start : start + TOGETHER]
        m = max(len(block.items[c[0]]) for _, _, c in part)
        w = max(c[2] - c[1] for _, _, c in part)
        first, second = np.full((len(part), m), -2, np.int32), np.full((len(part), w), -1, np.int32)
        for k, (_, words, (item, lo, hi, _)) in enumerate(part):
            first[k, : len(block.items[item])] = block.items[item]
            second[k, : hi - lo] = words[lo:hi]
        best, begin, end = align(first, second)
        for k, (row, _, (item, lo, _, seeds)) in enumerate(part):
            size = len(block.items[item])
            score = best[k] / (MATCH * size)
            if score >= (LEAST_SCORE if size >= FEW_WORDS else 1.0):
                yield row, item, float(score), lo + int(begin[k]), lo + int(end[k]), seeds


def _matches(documents: DataFrame, block: Block) -> DataFrame:
    shared = Shared(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in slices(batches):
            ids = batch.column(0).to_pylist()
            jobs = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                listed = words_of(text)
                words = own.number(listed)
                jobs += [(row, words, c) for c in candidates(own, words)]
            best: dict[tuple[int, int], tuple] = {}
            for found in _aligned(own, jobs):
                key = found[:2]
                if key not in best or (-found[2], found[3]) < (-best[key][2], best[key][3]):
                    best[key] = found
            rows = sorted(best.values())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([ids[r[0]] for r in rows], pa.int64()),
                    "item_id": pa.array([own.ids[r[1]] for r in rows], pa.int64()),
                    "score": pa.array([r[2] for r in rows], pa.float64()),
                    "from_word": pa.array([r[3] for r in rows], pa.int64()),
                    "to_word": pa.array([r[4] for r in rows], pa.int64()),
                    "seeds": pa.array([r[5] for r in rows], pa.int64()),
                }
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def blocks(benchmark: DataFrame, words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items with words, in order of their ids, cut into blocks; one block is on the driver at a time."""
    rows: list[tuple[int, str]] = []
    size = 0
    for row in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        n = len(words_of(row[1]))
        if rows and size + n > words:
            yield Block.of(rows)
            rows, size = [], 0
        rows.append((row[0], row[1]))
        size += n
    if rows:
        yield Block.of(rows)


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, score, from_word, to_word, seeds): where an item or an edited copy of it stands.

    One row for each document row and item whose best alignment scores at least LEAST_SCORE of the
    item's own score; an item of fewer than FEW_WORDS words must stand whole. Of equal alignments the
    first counts. Null and empty texts, on either side, match nothing; an empty benchmark gives no rows.
    Repeated document rows and repeated items give rows each.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text"))
    found = None
    for block in blocks(items):
        block.keep_rare(_documents_with(rows, block))
        part = _matches(rows, block)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else documents.sparkSession.createDataFrame([], RESULT)
