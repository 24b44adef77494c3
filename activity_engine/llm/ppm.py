"""Prediction by partial matching over bytes, and a word unigram as its base.

A text is read as its tokens: the words, each closed by a space, then one end symbol. The trie holds the
contexts of up to `ORDER` bytes, with the counts of the symbols that followed in the training texts.
Contexts run over spaces through the whole text (`through`), or else stay inside a word and its opening
space; a text starts behind a space that is not coded. A symbol's probability is looked up in the longest known context; each
escape to a shorter one costs the escape estimate, and symbols that the longer context has are left out
of the shorter one (symbol exclusion).

Counts come from all training texts and every counted node is kept. A symbol and the bytes its contexts
may hold are a window; the nodes of all orders are sums over windows. Windows are dealt into buckets by
the last `LOW + 1` bytes of the context, so that a bucket has all nodes of its longer contexts. The nodes
of the orders up to `LOW` are bounded by the alphabet of bytes and are sent to all. The number of buckets
grows with the input. Texts are coded by the bucket: what they need of it travels there in blocks, only
sums per text come back. Frequent windows and words are sent to all executors, again those above a share
of all, so that their number is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import BATCH_ROWS, Shared, cut, mix64, slices

ORDER = 6
HEAD_BITS = 20
# The same for windows, which are looked up in sorted arrays.
WINDOW_HEAD_BITS = 22
# Nodes up to this order are sent to all tasks.
LOW = 2
# Words counted in a task before the counts are passed on.
COUNTER_WORDS = 300_000
# Windows counted in a task before the counts are passed on, and those of one row.
COUNTER_WINDOWS = 1 << 21
ROW_WINDOWS = 1 << 14
# Windows of a bucket that are coded together.
CODED_TOGETHER = 1 << 16
# Windows that are looked up together, so that what is worked out for them stays near.
FOUND_TOGETHER = 1 << 15
# Words that travel in one row at most.
WORDS_TOGETHER = 20_000
# Bytes of text whose windows are made together; longer texts are read in pieces.
PIECE_BYTES = 1 << 20
# Tokens for each bucket of the model, and the least number of buckets.
BUCKET_TOKENS, BUCKETS = 1 << 23, 48

END = b"\n"  # no word has a line break
_SPACE = 0x20
_CODE = np.uint64(8)
_FREE = np.uint64((1 << 64) - 1)  # a place of a table without a window; no window is as large


def tokens_of(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case, and the end."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, and the place among them and the text of each word; ends are not counted."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = split.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at an edge splits off an empty one
    owner = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[some.to_numpy(zero_copy_only=False)]
    found = words.filter(some).dictionary_encode()
    return found.dictionary.cast(pa.binary()), found.indices.to_numpy(), owner


@dataclass
class Places:
    """The symbols of some tokens: `codes[k]` joins the k bytes in front of each symbol and the symbol."""

    codes: list[np.ndarray]
    depth: np.ndarray  # bytes in front of the symbol, inside its token
    token: np.ndarray


def places(tokens: list[bytes]) -> Places:
    raw = np.frombuffer(b" " + b" ".join(tokens) + b" ", dtype=np.uint8)
    space = raw == _SPACE
    at = np.arange(len(raw))
    last = np.maximum.accumulate(np.where(space, at, 0))  # the latest space up to here
    symbol = at[1:]
    symbol = symbol[raw[symbol - 1] != END[0]]  # the end is not closed by a space
    depth = symbol - last[symbol - 1]
    codes = [raw[symbol].astype(np.uint64)]
    for k in range(1, ORDER + 1):
        before = raw[np.maximum(symbol - k, 0)].astype(np.uint64)
        codes.append(codes[-1] | (before << np.uint64(8 * k)))
    return Places(codes, np.minimum(depth, ORDER), (np.cumsum(space) - 1)[symbol - 1])


def node_counts(tokens: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trie nodes of some tokens, as order << 56 | bytes, and their weighted counts."""
    p = places(tokens)
    weight = weights[p.token]
    keys, sums = [], []
    for k in range(ORDER + 1):
        fits = p.depth >= k
        found, inverse = np.unique(p.codes[k][fits], return_inverse=True)
        keys.append(found | np.uint64(k << 56))
        sums.append(np.bincount(inverse, weight[fits], len(found)))
    return np.concatenate(keys), np.concatenate(sums).astype(np.int64)


class Trie:
    """Kept nodes by order, with what each context needs for escapes and exclusion.

    `symbols` and `tokens` are the numbers of training symbols and tokens, kept or not.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, symbols: float = 0.0, tokens: float = 0.0) -> None:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.float64)
        level = (keys >> np.uint64(56)).astype(np.int64)
        low = keys & np.uint64((1 << 56) - 1)
        self.nodes = [low[level == k] for k in range(ORDER + 1)]
        self.counts = [counts[level == k] for k in range(ORDER + 1)]
        self.contexts, self.total, self.kinds, self.kept, self.excluded = [], [], [], [], []
        for k in range(ORDER + 1):
            context, owner = np.unique(self.nodes[k] >> _CODE, return_inverse=True)
            kept = np.bincount(owner, self.counts[k], len(context))
            if k == 0:
                total, shorter = np.maximum(kept, symbols), np.zeros(len(self.nodes[0]))
            else:
                # What follows a context is as frequent as the context itself, as a node one order below;
                # the opening space is followed by something once in each token.
                below, found = _find(self.nodes[k - 1], context)
                total = np.where(found, self.counts[k - 1][below] if len(below) else 0.0, kept)
                total = np.where(context == _SPACE, tokens, total)
                total = np.maximum(total, kept)
                drop = np.uint64((1 << (8 * k)) - 1)
                at, there = _find(self.nodes[k - 1], self.nodes[k] & drop)
                shorter = np.where(there, self.counts[k - 1][at] if len(at) else 0.0, 0.0)
            self.contexts.append(context), self.total.append(total), self.kept.append(kept)
            self.kinds.append(np.bincount(owner, minlength=len(context)).astype(np.float64))
            self.excluded.append(np.bincount(owner, shorter, len(context)))

    def log10(self, tokens: list[bytes]) -> np.ndarray:
        """log10 probability of each token, its closing space included."""
        p = places(tokens)
        return np.bincount(p.token, self.symbols_log10(p.codes, p.depth), len(tokens))

    def symbols_log10(self, codes: list[np.ndarray], depth: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol; see `Places` for `codes` and `depth`."""
        n = len(depth)
        out, mass, kinds = np.zeros(n), np.zeros(n), np.zeros(n)  # mass and kinds: what is excluded
        left = np.arange(n)
        for k in range(ORDER, -1, -1):
            if not len(self.nodes[k]):
                continue
            here = left[depth[left] >= k]
            context, known = _find(self.contexts[k], codes[k][here] >> _CODE)
            here, context = here[known], context[known]
            if not len(here):
                continue
            # Half a count of each kind goes to the escape, beside what the trie has left out.
            room = self.total[k][context] - mass[here]
            escape = room - (self.kept[k][context] - mass[here]) + 0.5 * (self.kinds[k][context] - kinds[here])
            node, hit = _find(self.nodes[k], codes[k][here])
            useful = (room > 1e-9) & (hit | (escape > 1e-9))
            share = np.where(hit, self.counts[k][node] - 0.5, escape)
            out[here[useful]] += np.log10(share[useful] / room[useful])
            mass[here], kinds[here] = self.excluded[k][context], self.kinds[k][context]
            done = np.zeros(n, dtype=bool)
            done[here[hit]] = True
            left = left[~done[left]]
        out[left] -= np.log10(np.maximum(1.0, 256.0 - kinds[left]))
        return out


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


class Head:
    """The log10 of some windows' symbols in a table with open addresses.

    Nearly every symbol of every text is looked up here: one or two places of the table are read for it, where a
    sorted array is halved some twenty times.
    """

    def __init__(self, keys: np.ndarray, logs: np.ndarray) -> None:
        self.mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, _FREE)
        self.logs = np.zeros(self.mask + 1)
        at, left = self._first(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == _FREE]
            self.keys[at[free]] = keys[free]  # of several that want a place one gets it
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask
        self.logs[at] = logs

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) & np.uint64(self.mask)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log10 of each window, 0 for one that is not here, and whether it is."""
        logs, hit = np.empty(len(wanted)), np.empty(len(wanted), dtype=bool)
        for start in range(0, len(wanted), FOUND_TOGETHER):
            part = slice(start, start + FOUND_TOGETHER)
            logs[part], hit[part] = self._find(wanted[part])
        return logs, hit

    def _find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self._first(wanted)
        there = self.keys[at]
        left = np.flatnonzero((there != wanted) & (there != _FREE))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there[left] = self.keys[at[left]]
            left = left[(there[left] != wanted[left]) & (there[left] != _FREE)]
        return self.logs[at], there == wanted


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (text, whether it is learned from) to tokens with their counts, a task's words at a time."""
    seen: list[pa.Table] = []
    for batch in slices(batches, BATCH_ROWS):
        learned = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        words, at, owner = words_of(batch.column(0))
        trained = np.bincount(at[learned[owner]], minlength=len(words))
        seen.append(pa.table({"token": words, "trained": trained, "n": np.bincount(at, minlength=len(words))}))
        # The end is a word of every text.
        seen.append(pa.table({"token": pa.array([END], pa.binary()), "trained": [int(learned.sum())], "n": [len(learned)]}))
        if sum(len(t) for t in seen) > 2 * COUNTER_WORDS:
            seen = [_summed(seen)]
            if len(seen[0]) > COUNTER_WORDS:
                yield from seen[0].to_batches()
                seen = []
    if seen:
        yield from _summed(seen).to_batches()


def _summed(counts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(counts).group_by("token").aggregate([("trained", "sum"), ("n", "sum")])
    return sums.select(["token", "trained_sum", "n_sum"]).rename_columns(["token", "trained", "n"])


def token_counts(documents: DataFrame, learned: Column, text: Column) -> DataFrame:
    """(token, trained, n): how often each token stands in the training texts, and in all."""
    rows = documents.select(text.alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    counted = rows.mapInArrow(_count_tokens, "token binary, trained bigint, n bigint")
    return cut(counted.groupBy("token").agg(F.sum("trained").alias("trained"), F.sum("n").alias("n")))


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, int]]]:
    """Groups of (text, bytes, how many of them only stand in front): tokens with their closing spaces."""
    group, size = [], 0
    for row, text in enumerate(texts):
        words = tokens_of(text)
        line = b" " + b" ".join(words)
        for start in range(0, len(line), PIECE_BYTES):
            front = min(ORDER, start) or 1
            piece = line[max(0, start - front) : start + PIECE_BYTES]
            group.append((row, piece, front))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def windows(group: list[tuple[int, bytes, int]], through: bool) -> tuple[np.ndarray, np.ndarray]:
    """The window of each symbol, as depth << 56 | bytes, and its text."""
    # Symbol and context are the eight bytes that end here, read at once.
    raw = np.frombuffer(b"".join([bytes(7), *(piece for _, piece, _ in group)]), dtype=np.uint8)
    keys = np.ndarray((len(raw) - 7,), ">u8", raw.data, 0, (1,)).astype(np.uint64) & _MASKS[ORDER]
    sizes = np.array([len(piece) for _, piece, _ in group])
    first, fronts = np.cumsum(sizes) - sizes, np.array([front for _, _, front in group])
    depth = np.full(len(keys), ORDER, dtype=np.uint8)
    symbol = np.ones(len(keys), dtype=bool)
    for k in range(ORDER):
        depth[first[sizes > k] + k] = k
        symbol[first[(sizes > k) & (fronts > k)] + k] = False
    if not through:
        raw, at = raw[7:], np.arange(len(keys))
        last = np.maximum.accumulate(np.where(raw == _SPACE, at, 0))
        depth = np.minimum(depth, at - np.concatenate([[0], last[:-1]])).astype(np.uint8)
    short = np.flatnonzero(depth < ORDER)
    keys[short] &= _MASKS[depth[short]]
    keys |= depth.astype(np.uint64) << np.uint64(56)
    return keys[symbol], np.repeat([row for row, _, _ in group], np.maximum(sizes - fronts, 0))


_MASKS = np.array([(1 << (8 * (k + 1))) - 1 for k in range(ORDER + 1)], dtype=np.uint64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the last LOW + 1 bytes of the context; shorter contexts need the low orders only."""
    context = (keys & _MASKS[ORDER]) >> _CODE
    return (mix64(context & _MASKS[LOW]) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with its places, in order."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, first[1:]), strict=True) if len(found) else ()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.concatenate([*keys, np.zeros(0, np.uint64)]), np.concatenate([*counts, np.zeros(0)])
    order = np.argsort(found, kind="stable")  # sorted runs are merged
    found = found[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[: len(found)])
    return found[first], np.add.reduceat(n[order], first) if len(first) else n


def window_nodes(keys: np.ndarray, counts: np.ndarray, orders: range) -> tuple[np.ndarray, np.ndarray]:
    """The trie nodes of some orders that the windows make up, as `node_counts` gives them."""
    depth = keys >> np.uint64(56)
    out = [(np.zeros(0, np.uint64), np.zeros(0))]
    for k in orders:
        fits = depth >= np.uint64(k)
        nodes, sums = _merged([keys[fits] & _MASKS[k]], [counts[fits]])
        out.append((nodes | np.uint64(k << 56), sums))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _coded(trie: Trie, keys: np.ndarray) -> np.ndarray:
    return trie.symbols_log10([keys & mask for mask in _MASKS], (keys >> np.uint64(56)).astype(np.int64))


# A row of the model (kind 0), of what texts need from a bucket (1), or of a text itself (2).
_TEXT_TYPE = pa.struct(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base", pa.float64()), ("log", pa.float64()),
    ]
)
_SUMS_TYPE = pa.schema([("key", pa.int64()), *_TEXT_TYPE])
_TEXT_ROW = "struct<doc_id:bigint,held_out:boolean,n_tokens:bigint,n_known:bigint,base:double,log:double>"
_BLOCK_TYPE = pa.schema(
    [
        ("bucket", pa.int32()), ("kind", pa.int32()), ("windows", pa.binary()), ("counts", pa.binary()),
        ("tokens", pa.list_(pa.binary())), ("k", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())),
        ("owners", pa.list_(pa.int64())), ("runs", pa.list_(pa.int64())), ("key", pa.int64()), ("text", _TEXT_TYPE),
    ]
)
_BLOCK_ROW = (
    "bucket int, kind int, windows binary, counts binary, tokens array<binary>, k array<bigint>, base array<double>, "
    f"owners array<bigint>, runs array<bigint>, key bigint, text {_TEXT_ROW}"
)


def _blocks(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _BLOCK_TYPE)


def _window_blocks(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    for bucket, places_ in _by_bucket(_bucket(keys, buckets)):
        for start in range(0, len(places_), ROW_WINDOWS):
            at = places_[start : start + ROW_WINDOWS]
            yield _blocks([{"bucket": bucket, "kind": 0, "windows": keys[at].tobytes(), "counts": counts[at].tobytes()}])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """The window blocks of each bucket; rows are in order of buckets."""
    last, keys, counts = None, [], []
    for batch in slices(batches, 64):
        for bucket, more, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "windows", "counts")), strict=True):
            if bucket != last and keys:
                yield last, keys, counts
                keys, counts = [], []
            last = bucket
            keys.append(np.frombuffer(more, np.uint64)), counts.append(np.frombuffer(n, np.float64))
    if keys:
        yield last, keys, counts


def _dealt(rows: DataFrame, *then: str) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", *then)


def window_model(documents: DataFrame, learned: Column, text: Column, buckets: int, through: bool) -> DataFrame:
    """The windows of the training texts with their counts, as blocks of one bucket; no window is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, new = [], [], 0
        for batch in slices(batches):
            for group in _pieces(batch.column(0).to_pylist()):
                found, n = np.unique(windows(group, through)[0], return_counts=True)
                keys.append(found), counts.append(n.astype(np.float64))
                new += len(found)
                if new > COUNTER_WINDOWS:
                    keys, counts = ([x] for x in _merged(keys, counts))
                    new = 0
                    if len(keys[0]) > COUNTER_WINDOWS:
                        yield from _window_blocks(keys[0], counts[0], buckets)
                        keys, counts = [], []
        yield from _window_blocks(*_merged(keys, counts), buckets)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, counts in _gathered(batches):
            yield from _window_blocks(*_merged(keys, counts), buckets)

    rows = documents.where(F.coalesce(learned, F.lit(False))).select(text.alias("text"))
    counted = rows.mapInArrow(count, _BLOCK_ROW).select("bucket", "windows", "counts")
    return cut(_dealt(counted).mapInArrow(merge, _BLOCK_ROW).select("bucket", "windows", "counts"))


def low_nodes(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the orders up to LOW; the bytes' alphabet bounds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, counts in _gathered(batches):
            nodes, sums = window_nodes(*_merged(keys, counts), range(LOW + 1))
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes.view(np.int64)), "n": pa.array(sums)})

    nodes = model.mapInArrow(run, "node bigint, n double").groupBy("node").agg(F.sum("n").alias("n")).toArrow()
    return nodes.column("node").to_numpy().view(np.uint64), nodes.column("n").to_numpy()


def _bucket_trie(low: tuple[np.ndarray, np.ndarray], keys: list[np.ndarray], counts: list[np.ndarray]) -> Trie:
    nodes, sums = window_nodes(*_merged(keys, counts), range(LOW + 1, ORDER + 1))
    return Trie(np.concatenate([low[0], nodes]), np.concatenate([low[1], sums]))


def head_windows(model: DataFrame, low: Shared, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The windows seen at least `least` times, sorted, and the log10 of their symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = low.get()
        for _, keys, counts in _gathered(batches):
            found, n = _merged(keys, counts)
            found, trie = found[n >= least], _bucket_trie(own, keys, counts)
            yield pa.RecordBatch.from_pydict({"window": pa.array(found.view(np.int64)), "log": pa.array(_coded(trie, found))})

    rows = _dealt(model).mapInArrow(run, "window bigint, log double").toArrow()
    keys, logs = rows.column("window").to_numpy().view(np.uint64), rows.column("log").to_numpy()
    order = np.argsort(keys)
    return keys[order], logs[order]


def _token_blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, WORDS_TOGETHER):
            tokens, known, base = (batch.column(k).to_pylist() for k in range(3))
            bucket = np.array([crc32(t) % buckets for t in tokens], dtype=np.int64)
            yield _blocks(
                [
                    {"bucket": b, "kind": 0, "tokens": [tokens[i] for i in at], "k": [known[i] for i in at], "base": [base[i] for i in at]}
                    for b, at in _by_bucket(bucket)
                ]
            )

    return run


def _wanted(words: pa.Array, pairs: np.ndarray, counts: np.ndarray, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket with the words that are wanted of it; a pair joins a text's place and a word's."""
    owner, at = np.divmod(pairs, len(words))
    kinds, at = np.unique(at, return_inverse=True)
    words = words.take(pa.array(kinds))
    bucket = np.array([crc32(t) % buckets for t in words.to_pylist()], dtype=np.int64)[at]
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    ends = pa.array(np.append(first, len(order)), pa.int32())
    columns = {
        "bucket": pa.array(found, pa.int32()), "kind": pa.array(np.ones(len(found)), pa.int32()),
        "tokens": pa.ListArray.from_arrays(ends, words.take(pa.array(at[order]))),
        "k": pa.ListArray.from_arrays(ends, pa.array(counts[order], pa.int64())),
        "owners": pa.ListArray.from_arrays(ends, pa.array(key[owner[order]], pa.int64())),
    }
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(found), f.type)) for f in _BLOCK_TYPE], schema=_BLOCK_TYPE)


def _needs(words: Shared, head: Shared, buckets: int, through: bool):
    """For each text one row with the sums over what is frequent; what else it needs, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known, base = words.get()
        frequent = pa.array(tokens, pa.binary())
        often = Head(*head.get())
        for batch in slices(batches, BATCH_ROWS):
            keys, ids, held, texts = (batch.column(k).to_pylist() for k in range(4))
            key = np.array(keys, dtype=np.int64)
            log = np.zeros(len(texts))
            for group in _pieces(texts):
                found, owner = windows(group, through)
                logs, hit = often.find(found)
                log += np.bincount(owner, logs, len(texts))
                found, owner = found[~hit], owner[~hit]
                rows = []
                for bucket, some in _by_bucket(_bucket(found, buckets)):
                    first = np.flatnonzero(np.diff(owner[some], prepend=-1))
                    rows.append(
                        {
                            "bucket": bucket, "kind": 1, "windows": found[some].tobytes(),
                            "owners": key[owner[some][first]], "runs": np.diff(first, append=len(some)),
                        }
                    )
                yield _blocks(rows)
            found, at, owner = words_of(batch.column(3))
            # The end is a word of every text.
            at, owner = np.append(at, np.full(len(texts), len(found))), np.append(owner, np.arange(len(texts)))
            found = pa.concat_arrays([found, pa.array([END], pa.binary())])
            place = pc.index_in(found, frequent).fill_null(-1).to_numpy().astype(np.int64)
            n_tokens, hit = np.bincount(owner, minlength=len(texts)), place[at] >= 0
            own = place[at[hit]]
            n_known = np.bincount(owner[hit], known[own], len(texts)).astype(np.int64)
            sums = np.bincount(owner[hit], base[own], len(texts))
            yield _blocks(
                [
                    {
                        "bucket": keys[row] % buckets, "kind": 2, "key": keys[row],
                        "text": {
                            "doc_id": ids[row], "held_out": held[row], "n_tokens": int(n_tokens[row]),
                            "n_known": int(n_known[row]), "base": float(sums[row]), "log": float(log[row]),
                        },
                    }
                    for row in range(len(texts))
                ]
            )
            yield _wanted(found, *np.unique(owner[~hit] * len(found) + at[~hit], return_counts=True), key, buckets)

    return run


def _sums(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _SUMS_TYPE], schema=_SUMS_TYPE)


def _settled(low: Shared):
    """Rows of each bucket, the model's first, to sums per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = low.get(), None
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        trie = None
        words: list[pa.Table] = []
        asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        wanted: list[pa.Table] = []
        size = 0

        def answers() -> pa.RecordBatch:
            nonlocal trie, keys, counts
            owners, known, base, log = [], [], [], []
            if asked:
                if trie is None:
                    trie = _bucket_trie(own, keys, counts)
                    keys, counts = [], []
                # A window that comes often is coded once.
                found, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
                runs = np.concatenate([a[2] for a in asked])
                log.append(np.add.reduceat(_coded(trie, found)[inverse], np.cumsum(runs) - runs))
                owners.append(np.concatenate([a[1] for a in asked]))
                known.append(np.zeros(len(runs))), base.append(np.zeros(len(runs)))
            if wanted:
                model, some = pa.concat_tables(words), pa.concat_tables(wanted)
                at = pc.index_in(some["token"], model["token"]).to_numpy()
                times = some["k"].to_numpy()
                owners.append(some["owner"].to_numpy())
                known.append(times * model["k"].to_numpy()[at]), base.append(times * model["base"].to_numpy()[at])
                log.append(np.zeros(len(some)))
            key, inverse = np.unique(np.concatenate(owners), return_inverse=True)
            known, base, log = (np.bincount(inverse, np.concatenate(x), len(key)) for x in (known, base, log))
            columns = {"key": key, "n_known": known.astype(np.int64), "base": base, "log": log}
            return _sums({k: pa.array(v) for k, v in columns.items()}, len(key))

        for batch in slices(batches, 64):
            texts = batch.filter(pc.equal(batch.column("kind"), 2))
            if texts.num_rows:
                fields = texts.column("text")
                columns = {f.name: fields.field(f.name) for f in _TEXT_TYPE}
                yield _sums({"key": texts.column("key"), **columns}, len(texts))
            places_ = zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), strict=True)
            for i, (bucket, kind) in enumerate(places_):
                row = {name: batch.column(name)[i] for name in ("windows", "tokens")} if kind < 2 else {}
                if bucket != last:
                    if size:
                        yield answers()
                    last, size = bucket, 0
                    keys, counts, trie, words, asked, wanted = [], [], None, [], [], []
                if kind == 2:
                    continue
                if row["tokens"].is_valid:
                    tokens = row["tokens"].values
                    k = batch.column("k")[i].values
                    if kind == 0:
                        part = pa.table({"token": tokens, "k": k, "base": batch.column("base")[i].values})
                        words.append(part.take(np.arange(len(part))))  # a copy, so that the batch with the windows can go
                    else:
                        wanted.append(pa.table({"token": tokens, "k": k, "owner": batch.column("owners")[i].values}))
                        size += len(tokens)
                else:
                    found = np.frombuffer(row["windows"].as_py(), np.uint64)
                    if kind == 0:
                        keys.append(found), counts.append(np.frombuffer(batch.column("counts")[i].as_py(), np.float64))
                    else:
                        asked.append((found, *(batch.column(c)[i].values.to_numpy() for c in ("owners", "runs"))))
                        size += len(found)
                if size >= CODED_TOGETHER:
                    yield answers()
                    asked, wanted, size = [], [], 0
        if size:
            yield answers()

    return run


def score_digest(
    documents: DataFrame,
    learned: Column,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    head_bits: int = HEAD_BITS,
    through: bool = False,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    `learned` says which rows the counts come from, `through` whether contexts run over spaces. Null and empty texts consist of the end alone.
    Without any training rows N, V and all counts are 0 and every symbol is equally likely. Repeated
    rows and ids are scored each for itself; further columns are not looked at.
    """
    counts = token_counts(documents, learned, F.col(text_col))
    total, kinds, everything = counts.agg(F.sum("trained"), F.count_if(F.col("trained") > 0), F.sum("n")).first()
    total, kinds, everything = total or 0, kinds or 0, everything or 0
    buckets = max(BUCKETS, everything // BUCKET_TOKENS)
    model = window_model(documents, learned, F.col(text_col), buckets, through)
    nodes = low_nodes(model)
    symbols = float(nodes[1][nodes[0] >> np.uint64(56) == 0].sum())
    low = Shared(nodes)
    head = Shared(head_windows(model, low, symbols / (1 << min(WINDOW_HEAD_BITS, head_bits + 2))))
    base = F.log10((F.col("trained") + 1) / F.lit(float(total + kinds + 1)))
    often = F.col("n") >= everything / (1 << head_bits)
    scores = counts.select("token", (F.col("trained") > 0).cast("bigint").alias("known"), base.alias("base"), often.alias("often"))
    top = scores.where("often").toArrow()
    words = Shared((top.column(0).to_pylist(), top.column(1).to_numpy(), top.column(2).to_numpy()))
    others = scores.where(~F.col("often")).select("token", "known", "base").mapInArrow(_token_blocks(buckets), _BLOCK_ROW)
    texts = documents.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("bigint").alias("doc_id"),
        held_out.alias("held_out"), F.col(text_col).alias("text"),
    )
    needs = texts.mapInArrow(_needs(words, head, buckets, through), _BLOCK_ROW)
    of_model = model.withColumn("kind", F.lit(0))
    rows = needs.unionByName(others).unionByName(of_model, allowMissingColumns=True)
    sums = _dealt(rows, "kind").mapInArrow(
        _settled(low), "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, log double"
    )
    found = sums.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("log").alias("score"),
    )
    return found.drop("key")
