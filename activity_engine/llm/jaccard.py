"""N-gram Jaccard join with rare-first prefix filtering, and the components of its links.

Texts with the same shingle set are one node. A node's shingles are ordered rare first; two sets of the
wanted similarity must share one of their first few shingles (prefix filter), so nodes meet on those.
Pairs whose lengths or whose places of the shared shingle rule the similarity out are never made. The
suffix filter cuts the space of shingles into ranges: the numbers of shingles that two sets have there
differ in sum by no more than the sets do. These numbers, 32 bytes a node, are joined to the pairs, so pairs
that share a shingle by chance end before a text is moved for them. Each pair left is verified once on the shingles of
both whole texts, behind a finer suffix filter.

A shingle that many near copies share does not make all pairs of them. First every node is paired only
with the shingle's leader, the node with the fewest rarer shingles (an unedited copy has the fewest).
After verification, pairs are made only between nodes that are not yet in one component, around the
nodes outside the shingle's largest component. A link within a component changes nothing, so the
components are exact. All links lie inside components: to have every one of them, a component's nodes
are dealt into blocks, and each pair of blocks tests all its pairs on the whole shingle sets.

Rarity is the shingle's count in a table of fixed size, filled from all rows. Shingles that share a
place count together: that can only change the order, which any fixed order would serve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, bound_batches, cut, slices
from activity_engine.llm.components import components
from activity_engine.llm.words import WordHasher, shingles

SHINGLE_WORDS = 3
PERCENT = 90
SKETCH_BITS = 20
# The filter that picks the texts to verify has this many bits at most.
FILTER_BITS = 25
# So has the filter that picks the prefix shingles that two nodes may have.
TOKEN_BITS = 26
# Ranges of the suffix filter on pairs.
RANGES = 32
# Nodes and shingles of one block of a component, about.
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 20
# Ranges whose counts travel together, and groups of tasks that are summed up first.
_COUNTS, _SHARES = 4096, 64
_BLOCK = 4096 * 8  # bits of one of Spark's bitmaps


def _needed(a: int | np.ndarray, b: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Least intersection of sets of sizes a and b that are `percent` similar."""
    return -(-(percent * (a + b)) // (100 + percent))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list, list[np.ndarray], list]]:
    """Ids, sorted shingle sets and texts of the rows, slice by slice; columns: id, text."""
    hasher = WordHasher()
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        yield batch.column(0).to_pylist(), [shingles(w, n) for w in hasher.texts(texts)], texts


def _node(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _spot(node: bytes) -> int:
    return int.from_bytes(node[:8], "little") >> (64 - FILTER_BITS)


def _spread(found: np.ndarray) -> bytes:
    """How many shingles of a set lie in each range, 255 at most: that can only bring two sets closer."""
    counts = np.bincount((found >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=RANGES)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def rarity(documents: DataFrame, n: int = SHINGLE_WORDS, bits: int = SKETCH_BITS) -> np.ndarray:
    """How many texts have a shingle of each of 2^bits hash ranges; counted by task, then summed up.

    Counts travel as blocks of neighbouring ranges, summed over a share of the tasks first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, dtype=np.uint32)
        task = 0
        for task, found, _ in _sets(batches, n):
            np.add.at(seen, np.concatenate([*found, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits), 1)
        size = min(_COUNTS, 1 << bits)
        parts = [(i // size, seen[i : i + size]) for i in range(0, len(seen), size) if seen[i : i + size].any()]
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([i for i, _ in parts], pa.int32()),
                "share": pa.array([task[0] % _SHARES if task else 0] * len(parts), pa.int32()),
                "counts": pa.array([c.tobytes() for _, c in parts], pa.binary()),
            }
        )

    def add(table: pa.Table) -> pa.Table:
        sums = np.zeros(0, dtype=np.uint64)
        for counts in table.column("counts").to_pylist():
            more = np.frombuffer(counts, np.uint32)
            sums = more.astype(np.uint64) if not len(sums) else sums + more
        sums = np.minimum(sums, np.iinfo(np.uint32).max).astype(np.uint32)
        first = table.slice(0, 1)
        return first.set_column(first.schema.get_field_index("counts"), "counts", pa.array([sums.tobytes()], pa.binary()))

    bound_batches(documents.sparkSession)
    schema = "block int, share int, counts binary"
    counted = documents.select(F.spark_partition_id().alias("id"), "text").mapInArrow(count, schema)
    summed = counted.groupBy("block", "share").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    out = np.zeros(1 << bits, dtype=np.uint32)
    for block, _, counts in summed.collect():
        found = np.frombuffer(bytes(counts), np.uint32)
        out[block * len(found) : (block + 1) * len(found)] = found
    return out


def _prefixes(documents: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """(doc_id, node, size, spread, prefix) of each row; the prefix is in rare-first order."""
    shared = Shared(counts)
    shift = np.uint64(64 - (len(counts).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.get()
        for ids, found, _ in _sets(batches, n):
            prefix = []
            for s in found:
                if not len(s):
                    prefix.append(None)
                    continue
                take = len(s) - -(-percent * len(s) // 100) + 1
                # Sorted by hash already; a stable sort by count keeps that among equals.
                order = np.argsort(common[(s >> shift).astype(np.int64)], kind="stable")[:take]
                prefix.append(s[order].view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "node": pa.array([_node(s) if len(s) else None for s in found], pa.binary()),
                    "size": pa.array([len(s) for s in found], pa.int64()),
                    "spread": pa.array([_spread(s) for s in found], pa.binary()),
                    "prefix": pa.array(prefix, pa.list_(pa.int64())),
                }
            )

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "doc_id bigint, node binary, size bigint, spread binary, prefix array<bigint>")


def _possible(percent: int) -> Column:
    """Length and positional filter for a pair that shares a shingle at places pos and pos2."""
    lengths = 100 * F.least("size", "size2") >= percent * F.greatest("size", "size2")
    needed = F.ceil(percent * (F.col("size") + F.col("size2")) / (100 + percent))
    return lengths & (F.least(F.col("size") - F.col("pos"), F.col("size2") - F.col("pos2")) >= needed)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.greatest("node", "node2").alias("a"), F.least("node", "node2").alias("b")).distinct()


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the suffix filter on the nodes' ranges does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spread, spread2 = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, RANGES) for k in (4, 5))
            size, size2 = (batch.column(k).to_numpy() for k in (2, 3))
            apart = np.abs(spread.astype(np.int16) - spread2.astype(np.int16)).sum(axis=1)
            kept = pa.array(np.flatnonzero(apart <= size + size2 - 2 * _needed(size, size2, percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    first = nodes.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("spread").alias("spread_a"))
    second = nodes.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("spread").alias("spread_b"))
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "size_a", "size_b", "spread_a", "spread_b")
    return rows.mapInArrow(run, "a binary, b binary")


def _bit_table(rows: DataFrame, spot: Column, bits: int) -> np.ndarray:
    """A table of 2^bits bits with the given places set; it is as large whatever the input's size."""
    spots = rows.select(spot.cast("bigint").alias("spot"))
    blocks = spots.groupBy(F.floor(F.col("spot") / _BLOCK).alias("block"))
    maps = blocks.agg(F.bitmap_construct_agg(F.col("spot") % _BLOCK).alias("bits")).toArrow()
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for block, found in zip(maps.column("block").to_pylist(), maps.column("bits").to_pylist(), strict=True):
        start = block * (_BLOCK // 8)
        table[start : start + _BLOCK // 8] = np.frombuffer(found, dtype=np.uint8)
    return table


def _distinct(placed: DataFrame) -> DataFrame:
    """(node, size, spread, prefix), one row for all texts with the same set."""
    rows = placed.where("node is not null").groupBy("node")
    return cut(rows.agg(*(F.first(c).alias(c) for c in ("size", "spread", "prefix"))))


def _members(nodes: DataFrame) -> DataFrame:
    """(token, node, size, pos): the prefix shingles that two nodes may have in common.

    All prefix shingles are counted. Those of two nodes go into a bit table that is sent to the tasks, as long
    as an eighth of it suffices for them; it lets some through that only one node has, which find no
    partner. If they are more, they are joined. A place is a shingle's low bits: of equally rare shingles the
    prefix takes the smallest, so their high bits crowd.
    """
    tokens = nodes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    twice = cut(tokens.where("k > 1").select("token"))
    if twice.count() > (1 << TOKEN_BITS) // 8:
        exploded = nodes.select("node", "size", F.posexplode("prefix").alias("pos", "token"))
        return cut(exploded.join(twice, "token", "left_semi").select("token", "node", "size", "pos"))
    shared = Shared(_bit_table(twice, F.col("token").bitwiseAND(F.lit((1 << TOKEN_BITS) - 1)), TOKEN_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.get()
        for batch in slices(batches, 4096):
            lists = batch.column(2)
            token = lists.flatten().to_numpy().view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = (token & np.uint64((1 << TOKEN_BITS) - 1)).astype(np.int64)
            kept = np.flatnonzero(wanted[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            found = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[kept].view(np.int64)), batch.column(0).take(found), batch.column(1).take(found), pa.array(pos[kept].astype(np.int32))],
                ["token", "node", "size", "pos"],
            )

    return cut(nodes.select("node", "size", "prefix").mapInArrow(run, "token bigint, node binary, size bigint, pos int"))


def _texts(documents: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, text), one text for each of `nodes`.

    A bit table of fixed size says which texts may be wanted, so that the others never move; the join
    leaves out those that it let through by chance.
    """
    # A node's first bytes are a uniform number; this is `_spot`, little end first.
    turned = F.concat(*(F.substring("node", k, 1) for k in range(8, 0, -1)))
    spot = F.shiftrightunsigned(F.conv(F.hex(turned), 16, -10).cast("bigint"), 64 - FILTER_BITS)
    shared = Shared(_bit_table(nodes, spot, FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, sent = shared.get(), set()
        for _, found, texts in _sets(batches, n):
            names, kept = [], []
            for s, text in zip(found, texts, strict=True):
                if not len(s) or (node := _node(s)) in sent:
                    continue
                spot = _spot(node)
                if wanted[spot >> 3] >> (spot & 7) & 1:
                    sent.add(node)
                    names.append(node), kept.append(text)
            yield pa.RecordBatch.from_pydict({"node": pa.array(names, pa.binary()), "text": pa.array(kept, pa.string())})

    rows = documents.select(F.lit(0).alias("id"), "text").mapInArrow(run, "node binary, text string")
    return cut(rows.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def suffix_apart(x: np.ndarray, y: np.ndarray, most: int, depth: int = 3) -> int:
    """A lower bound of the number of values that only one of two sorted sets has.

    The middle value of one set splits both; parts of different sizes differ at least by their sizes.
    """
    if not depth or not len(x) or not len(y):
        return abs(len(x) - len(y))
    pivot = y[len(y) // 2]
    i, j = int(np.searchsorted(x, pivot)), len(y) // 2
    if abs(i - j) + abs((len(x) - i) - (len(y) - j)) > most:
        return abs(i - j) + abs((len(x) - i) - (len(y) - j))
    left = suffix_apart(x[:i], y[:j], most, depth - 1)
    return left + suffix_apart(x[i:], y[j:], most - left, depth - 1) if left <= most else left


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    needed = _needed(len(x), len(y), percent)
    most = len(x) + len(y) - 2 * needed
    if suffix_apart(x, y, most) > most:
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        last, own = None, np.zeros(0, np.uint64)
        for batch in slices(batches):
            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            others = [shingles(w, n) for w in hasher.texts(tb)]
            kept = []
            for i, name in enumerate(a):
                if name != last:  # rows of one node stand together
                    last, own = name, shingles(next(iter(hasher.texts([ta[i]]))), n)
                if similar(own, others[i], percent):
                    kept.append(i)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a[i] for i in kept], pa.binary()), "b": pa.array([b[i] for i in kept], pa.binary())}
            )

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # The many rows of a leader come last, so that its text is joined to them and not moved with each.
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a binary, b binary")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def connections(documents: DataFrame, placed: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes that have the same components as all links together."""
    nodes = _distinct(placed)
    members = _members(nodes)
    leader = members.groupBy("token").agg(F.min(F.struct("pos", "size", "node")).alias("l"))
    led = [F.col(f"l.{c}").alias(f"{c}2") for c in ("node", "size", "pos")]
    stars = members.join(leader, "token").select("node", "size", "pos", *led)
    tested = cut(_near(_pairs(stars.where((F.col("node") != F.col("node2")) & _possible(percent))), nodes, percent))
    found = cut(_verified(tested, _texts(documents, _ends(tested), n), n, percent))
    groups = components(found)
    grouped = members.join(groups.withColumnRenamed("root", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
    sizes = grouped.groupBy("token", "group").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("k", "group")).alias("l"), F.count(F.lit(1)).alias("groups"))
    open_ = cut(grouped.join(largest.where("groups > 1").select("token", F.col("l.group").alias("main")), "token"))
    outside = open_.where("group != main").select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "size", "pos", "group")])
    rest = open_.join(outside, "token").where((F.col("group") != F.col("group2")) & _possible(percent))
    fresh = cut(_near(_pairs(rest), nodes, percent).join(tested, ["a", "b"], "left_anti"))
    if fresh.isEmpty():
        return found
    return cut(found.unionByName(_verified(fresh, _texts(documents, _ends(fresh), n), n, percent)))


def _cells(documents: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(root, i, j, side, node, copies, found) of `nodes` (node, root, size, copies): the block pairs i <= j.

    Side 0 of a cell is block i and side 1 block j; a cell of one block has side 0 only.
    """
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    large = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("members"), parts.alias("parts")).where("members > 1")
    rows = cut(nodes.join(large, "root"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches):
            found = [shingles(w, n).tobytes() for w in hasher.texts(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "found"])

    sets = _texts(documents, rows, n).mapInArrow(run, "node binary, found binary")
    block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = rows.join(sets, "node").withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "copies", "found",
    )


def _linked(table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a cell with the later rows that it is linked with, all pairs of the cell being tested."""
    sets = [np.frombuffer(found, np.uint64) for found in table.column("found").to_pylist()]
    side = table.column("side").to_numpy()
    sizes = np.array([len(s) for s in sets])
    kinds, spots = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(sizes) - sizes
    crossed = side.any()
    first = int((side == 0).sum())  # rows are in order of sides
    seen = np.zeros(len(kinds), dtype=np.int64)
    for k in range(first):
        after = first if crossed else k + 1
        if after == len(sets):
            break
        own = spots[start[k] : start[k] + sizes[k]]
        seen[own] = 1
        both = np.add.reduceat(seen[spots[start[after] :]], start[after:] - start[after])
        seen[own] = 0
        yield k, after + np.flatnonzero(100 * both >= percent * (sizes[k] + sizes[after:] - both))


def _copied(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, root, size, copies) of the nodes that are linked with others; copies are rows of equal sets."""
    nodes = placed.where("node is not null").groupBy("node").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    return nodes.join(groups, "node")


def links(documents: DataFrame, placed: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """All links (a, b) between different nodes, a being the greater."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("side")
        names = table.column("node").to_pylist()
        found = [(max(names[k], names[o]), min(names[k], names[o])) for k, others in _linked(table, percent) for o in others.tolist()]
        return pa.table({"a": pa.array([p[0] for p in found], pa.binary()), "b": pa.array([p[1] for p in found], pa.binary())})

    nodes = _copied(placed, components(connections(documents, placed, n, percent)))
    return _cells(documents, nodes, n).groupBy("root", "i", "j").applyInArrow(run, "a binary, b binary")


def link_counts(documents: DataFrame, placed: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, linked): the rows of the other nodes that each node is linked with, summed up cell by cell."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("side")
        copies = table.column("copies").to_numpy()
        linked = np.zeros(len(copies), dtype=np.int64)
        for k, others in _linked(table, percent):
            linked[k] += copies[others].sum()
            linked[others] += copies[k]
        return pa.table({"node": table.column("node"), "linked": pa.array(linked)})

    cells = _cells(documents, _copied(placed, groups), n).groupBy("root", "i", "j")
    return cells.applyInArrow(run, "node binary, linked bigint").groupBy("node").agg(F.sum("linked").alias("linked"))


def join_digest(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    n_links: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row, and `n_links` where asked for.

    `n_links` is the number of other rows that the row is linked with, copies each counted.

    Defined results: a text without words, and null, has no shingle, is linked with nothing and is its
    own component. Equal sets are always linked. The component's id is its smallest id that is not
    null; rows without an id still link others. Repeated rows and repeated ids each count as texts of
    their own. Further columns are not looked at.
    """
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    placed = cut(_prefixes(rows, rarity(rows, n), n, percent))
    groups = components(connections(rows, placed, n, percent))
    nodes = placed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    rooted = nodes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(lows, "root").select("node", "component_id", "copies")
    if n_links:
        of = of.join(link_counts(rows, placed, groups, n, percent), "node", "left")
    found = placed.select("doc_id", "node", "size").join(of, "node", "left")
    alone = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    columns = [F.col("doc_id"), F.col("size").alias("n_shingles"), alone.alias("component_id")]
    if n_links:
        others = F.coalesce(F.col("linked"), F.lit(0)) + F.col("copies") - 1
        columns.append(F.coalesce(others, F.lit(0)).alias("n_links"))
    return found.select(*columns)
