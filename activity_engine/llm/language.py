"""Language identification by interpolated Kneser-Ney character models.

One model per language is fitted on a bounded sample of labelled rows. The n-grams of all languages
share one sorted array of hashes per order, whose rows hold the interpolated log-probability in every
language, so one binary search serves all of them. Text is read as lower-case words of letters between
boundary marks, which makes a word's log-probability independent of its neighbours: each task scores
a word once and reuses it while it stays in a cache of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, bounded_sample, fit_in_task, mix64, pieces, slices

UNKNOWN = "und"
ORDER = 4
# Labelled rows a language is learned from, at most.
SAMPLE_DOCS = 600
CACHE_WORDS = 200_000
# Rejection: the entropy lies nearer to that of random letters than to the language's mean, and its
# excess over the mean, times the square root of the length (of at most CALIBRATION_CHARS characters),
# is MARGIN times the widest seen in the sample.
MARGIN = 1.25
CALIBRATION_CHARS = 400

_EDGE = 1  # boundary mark; a control character, so never a part of a word
_TO_SPACE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_WITH_DIGITS = bytes(0x30 if 0x30 <= c <= 0x39 else b for c, b in enumerate(_TO_SPACE))

RESULT = "lang_pred string, score double, entropy double, rejected boolean"


def words_of(text: str) -> list[bytes]:
    """Lower-case words of ASCII letters and anything beyond ASCII.

    Words with digits (keys, numbers) speak no language and are left out, unless there are no others.
    """
    low = text.lower().encode("utf-8", "replace")
    marked = low.translate(_WITH_DIGITS)
    words = marked.split()
    if b"0" in marked:
        words = [w for w in words if b"0" not in w]
    return words or low.translate(_TO_SPACE).split()


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def code_points(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each behind ORDER - 1 marks and before one; the word of each scored place."""
    gap = chr(_EDGE) * ORDER
    joined = gap[1:] + gap.join(w.decode("utf-8", "replace") for w in words) + gap[0]
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # A place is scored unless it is one of the marks in front of a word.
    edge = points == _EDGE
    scored = ~edge
    scored[1:] |= edge[1:] & ~edge[:-1]
    scored[: ORDER - 1] = False
    places = np.flatnonzero(scored)
    closing = edge[places]
    word = np.cumsum(closing) - closing
    return points, np.stack([places, word])


def gram_hash(points: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place."""
    h = np.full(len(places), n, dtype=np.uint64)
    for back in range(n - 1, -1, -1):
        h = mix64(h * np.uint64(0x100000001B3) + points[places - back].astype(np.uint64))
    return h


@dataclass
class Model:
    langs: list[str]
    grams: list[np.ndarray]  # by order from 1: sorted hashes
    logs: list[np.ndarray]  # and log-probabilities by language
    contexts: list[np.ndarray]  # by order of the context from 1
    backoffs: list[np.ndarray]
    floor: float
    uniform: float = 0.0  # log-probability of a character under no model at all
    mean: np.ndarray | None = None
    widest: np.ndarray | None = None

    def word_logs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each word in each language, and its number of scored characters."""
        points, (places, word) = code_points(words)
        total = np.zeros((len(places), len(self.langs)), dtype=np.float32)
        open_ = np.arange(len(places))
        for n in range(ORDER, 0, -1):
            at = places[open_]
            h = gram_hash(points, at, n)
            i = np.minimum(np.searchsorted(self.grams[n - 1], h), len(self.grams[n - 1]) - 1)
            hit = self.grams[n - 1][i] == h
            total[open_[hit]] += self.logs[n - 1][i[hit]]
            open_ = open_[~hit]
            if n == 1 or not len(open_):
                break
            h = gram_hash(points, places[open_] - 1, n - 1)
            i = np.minimum(np.searchsorted(self.contexts[n - 2], h), len(self.contexts[n - 2]) - 1)
            known = self.contexts[n - 2][i] == h
            total[open_[known]] += self.backoffs[n - 2][i[known]]
        total[open_] += self.floor
        sizes = np.bincount(word, minlength=len(words))
        logs = np.add.reduceat(total, np.cumsum(sizes) - sizes, axis=0)  # each word has a place at least
        return logs, sizes.astype(np.float32)

    def decide(self, logs: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score, its entropy, and whether it is rejected, for each text."""
        entropy = -logs / np.maximum(chars, 1)[:, None]
        best = np.argmin(entropy, axis=1)
        low = entropy[np.arange(len(best)), best]
        # Confidence grows with the evidence, but a long text is not surer than CALIBRATION_CHARS.
        gaps = (low[:, None] - entropy) * np.sqrt(np.minimum(np.maximum(chars, 1), CALIBRATION_CHARS))[:, None]
        score = 1.0 / np.exp(np.maximum(gaps, -50)).sum(axis=1)
        rejected = np.zeros(len(best), dtype=bool)
        if self.mean is not None:
            excess = (low - self.mean[best]) * np.sqrt(np.minimum(chars, CALIBRATION_CHARS))
            rejected = (excess > self.widest[best]) & (low > (self.mean[best] - self.uniform) / 2)
        return best, score, low, rejected


def fit(counts: dict[str, dict[bytes, int]]) -> Model:
    """Interpolated Kneser-Ney models from word counts per language."""
    langs = sorted(counts)
    vocabulary = sorted(set().union(*[counts[x] for x in langs])) if langs else []
    if not vocabulary:
        empty = [np.array([], dtype=np.uint64)] * ORDER
        return Model([], empty, [np.zeros((0, 0), np.float32)] * ORDER, empty, [np.zeros((0, 0), np.float32)] * ORDER, 0.0)
    points, (places, word) = code_points(vocabulary)
    weights = np.array([[counts[x].get(w, 0) for x in langs] for w in vocabulary], dtype=np.float64)
    grams, first, sums = [], [], []
    for n in range(1, ORDER + 1):
        keys, at, inverse = np.unique(gram_hash(points, places, n), return_index=True, return_inverse=True)
        c = np.zeros((len(keys), len(langs)))
        if n == ORDER:
            np.add.at(c, inverse, weights[word])
        grams.append(keys), first.append(places[at]), sums.append(c)
    for n in range(ORDER - 1, 0, -1):
        # Lower orders count the different characters seen in front of the n-gram.
        below = np.searchsorted(grams[n - 1], gram_hash(points, first[n], n))
        np.add.at(sums[n - 1], below, sums[n] > 0)
    alphabet = len(grams[0]) + 1
    lower = np.full((1, len(langs)), 1.0 / alphabet)
    logs, contexts, backoffs = [], [], []
    for n in range(1, ORDER + 1):
        c = sums[n - 1]
        ones, twos = (c == 1).sum(axis=0), (c == 2).sum(axis=0)
        discount = np.clip(np.where(ones + 2 * twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.1, 0.95)
        if n == 1:
            owner, context = np.zeros(len(c), dtype=np.int64), np.zeros(1, dtype=np.uint64)
            below = np.zeros(len(c), dtype=np.int64)
        else:
            context, owner = np.unique(gram_hash(points, first[n - 1] - 1, n - 1), return_inverse=True)
            below = np.searchsorted(grams[n - 2], gram_hash(points, first[n - 1], n - 1))
        total, kinds = np.zeros((len(context), len(langs))), np.zeros((len(context), len(langs)))
        np.add.at(total, owner, c)
        np.add.at(kinds, owner, c > 0)
        share = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        seen = np.where(total[owner] > 0, np.maximum(c - discount, 0) / np.maximum(total[owner], 1), 0.0)
        lower = seen + share[owner] * (lower[below] if n > 1 else lower)
        logs.append(np.log(lower).astype(np.float32))
        contexts.append(context), backoffs.append(np.log(share).astype(np.float32))
    floor = float(np.log(1.0 / alphabet)) + float(backoffs[0].mean())
    return Model(langs, grams, logs, contexts[1:], backoffs[1:], floor, float(np.log(1.0 / alphabet)))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts: dict[tuple[str, bytes], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in words_of(text or ""):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in counts], pa.string()),
                "word": pa.array([k[1] for k in counts], pa.binary()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )


def _fit_rows(rows: list[tuple[str, bytes, int]]) -> Model:
    counts: dict[str, dict[bytes, int]] = {}
    for lang, word, n in rows:
        counts.setdefault(lang, {})[word] = n
    return fit(counts)


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS
) -> Model:
    """Models from at most about `docs` rows per language; rows without id, text or language teach nothing.

    Words are counted on the executors and fitted in one task; the model comes to the driver, as do the
    sample's entropies, from which the rejection is calibrated.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sample = bounded_sample(rows.where("text is not null"), "lang", "id", docs)
    counted = sample.select("lang", "text").mapInArrow(_word_counts, "lang string, word binary, n bigint")
    model = fit_in_task(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), _fit_rows)
    if not model.langs:
        return model
    scored = sample.select("lang", identify(F.col("text"), model).alias("r")).where("lang = r.lang_pred")
    chars = F.least(F.col("r.chars"), F.lit(float(CALIBRATION_CHARS)))
    kept = scored.select("lang", F.col("r.entropy").alias("e"), chars.alias("c")).where("c > 0").collect()
    model.mean, model.widest = np.zeros(len(model.langs)), np.full(len(model.langs), np.inf)
    for k, lang in enumerate(model.langs):
        e, c = (np.array([r[i] for r in kept if r[0] == lang]) for i in (1, 2))
        if len(e):
            model.mean[k] = np.average(e, weights=c)
            model.widest[k] = max(MARGIN * np.max((e - model.mean[k]) * np.sqrt(c)), 1.0)
    return model


def identify(text: Column, model: Model) -> Column:
    """struct<lang_pred, score, entropy, rejected, chars> of a text column.

    A null text, or one without a letter, is `und` with score 0 and is rejected; so is every text when
    nothing was learned. Equal entropies go to the language that comes first by code point.
    """
    shared = Shared(model)

    @F.arrow_udf(f"struct<{RESULT.replace(' ', ':').replace(',:', ',')},chars:double>")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.get()
        ids: dict[bytes, int] = {}
        logs, chars = np.zeros((0, len(own.langs)), np.float32), np.zeros(0, np.float32)
        for array, cuts in pieces(arrays):
            out = []
            for start, length in cuts:
                texts = array.slice(start, length).to_pylist()
                words = [words_of(t) if t and own.langs and has_letter(t) else [] for t in texts]
                flat = [w for ws in words for w in ws]
                new = [w for w in set(flat) if w not in ids]
                if len(ids) + len(new) > CACHE_WORDS:
                    ids, new = {}, list(set(flat))
                    logs, chars = logs[:0], chars[:0]
                if new:
                    ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
                    more = own.word_logs(new)
                    logs, chars = np.concatenate([logs, more[0]]), np.concatenate([chars, more[1]])
                out.append(_results(own, texts, words, np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat)), logs, chars))
            yield pa.concat_arrays(out) if out else pa.array([], _TYPE)

    return run(text)


_TYPE = pa.struct(
    [("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_()), ("chars", pa.float64())]
)


def _results(model: Model, texts: list, words: list, ids: np.ndarray, logs: np.ndarray, chars: np.ndarray) -> pa.Array:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    some = np.flatnonzero(lengths)
    n = len(texts)
    pred, score, entropy, rejected, size = [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, dtype=bool), np.zeros(n)
    if len(some):
        starts = (np.cumsum(lengths) - lengths)[some]
        total = np.add.reduceat(logs[ids].astype(np.float64), starts, axis=0)
        size[some] = np.add.reduceat(chars[ids], starts)
        best, s, e, r = model.decide(total, size[some])
        for place, b in zip(some.tolist(), best.tolist(), strict=True):
            pred[place] = model.langs[b]
        score[some], entropy[some], rejected[some] = s, e, r
    return pa.StructArray.from_arrays(
        [pa.array(pred, pa.string()), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)), pa.array(rejected), pa.array(size)],
        fields=list(_TYPE),
    )
