"""Vector codes by k-means over parts, with anchors-hierarchy metric trees.

Vectors become integers and are cut into equal parts; each part position has a codebook that a few rounds
of assigning and averaging settle. The rows are cut into blocks once. In a block each part position gets
a metric tree, built middle-out: about sqrt(n) anchors are chosen, each one the point farthest from the
anchor that owns it, and take from the others only points that the triangle inequality does not rule
out; large anchors are cut again in the same way; then the two balls whose union is smallest are merged
until one is left. Every ball caches the sum and the number of its points.

A round walks each tree with the codebook. A ball inherits the entries that its parent could not rule
out and rules out those that another entry is nearer than for every point of the ball. With one entry
left the ball is wholly owned: its cached sum and number count, and its points are not looked at. A leaf
with several entries left compares its points with these only. All sums and distances of points are whole
numbers, so the codebooks do not depend on how the rows were dealt out; only a few numbers per codebook
component come to the driver in a round.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Rows of a block, and points of a leaf at most (more if they are all equal).
BLOCK_ROWS, LEAF_POINTS = 4096, 48
# A component beyond this counts as this, so that squared distances stay whole 64-bit numbers.
LIMIT = 1 << 27


class Tree:
    """A metric tree over integer points; a node's points are `order[lo:hi]`."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_POINTS) -> None:
        order: list[np.ndarray] = []
        nodes: list[tuple] = []

        def place(node: tuple, at: int) -> int:
            """The subtree with its number; children follow their parent."""
            stack = [(node, -1)]
            while stack:
                (found, left, right), parent = stack.pop()
                number = len(nodes)
                if parent >= 0:
                    nodes[parent][2].append(number)
                nodes.append((at, len(found), []))
                if left is None:
                    order.append(found)
                    at += len(found)
                else:
                    stack += [(right, number), (left, number)]
            return at

        if len(points):
            place(_anchored(points, np.arange(len(points)), leaf), 0)
        self.order = np.concatenate([*order, np.zeros(0, np.int64)]).astype(np.int32)
        self.lo = np.array([n[0] for n in nodes], dtype=np.int32)
        self.hi = np.array([n[0] + n[1] for n in nodes], dtype=np.int32)
        self.child = np.array([n[2] or [-1, -1] for n in nodes], dtype=np.int32).reshape(-1, 2)
        sums = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
        np.cumsum(points[self.order], axis=0, out=sums[1:])
        self.sums = sums[self.hi] - sums[self.lo]
        self.center = self.sums / np.maximum(1, self.hi - self.lo)[:, None]
        self.radius = np.array(
            [np.sqrt(((points[self.order[a:b]] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(self.lo, self.hi, self.center, strict=True)]
        )

    def walk(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(node, entry, candidates) of the balls that settle: wholly owned ones (entry >= 0) and leaves."""
        entries = book.astype(np.float64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
        nodes = np.zeros(min(1, len(self.lo)), dtype=np.int64)
        open_ = np.ones((len(nodes), len(book)), dtype=bool)
        while len(nodes):
            d = ((self.center[nodes][:, None] - entries[None]) ** 2).sum(axis=2)
            d[~open_] = np.inf
            best = d.argmin(axis=1)
            least = d[np.arange(len(nodes)), best]
            # The most that a point of the ball can be farther from the best entry than from another.
            farther = least[:, None] - d + 2 * self.radius[nodes][:, None] * apart[best]
            slack = 0.5 + 1e-9 * (least + (2 * self.radius[nodes] * apart[best].max(axis=1)))
            open_ &= ~(farther < -slack[:, None])
            owned = open_.sum(axis=1) == 1
            leaf = self.child[nodes, 0] < 0
            done = owned | leaf
            yield nodes[done], np.where(owned, best, -1)[done], open_[done]
            nodes, open_ = self.child[nodes[~done]].reshape(-1).astype(np.int64), np.repeat(open_[~done], 2, axis=0)


def _anchored(points: np.ndarray, own: np.ndarray, leaf: int) -> tuple:
    """(points, left, right) of the ball of `own`; both are None for a leaf."""
    if len(own) <= leaf:
        return own, None, None
    x = points[own].astype(np.float64)
    pivots = [x[0]]
    owner = np.zeros(len(own), dtype=np.int64)
    away = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    for k in range(1, int(np.ceil(np.sqrt(len(own))))):
        far = int(away.argmax())
        if away[far] == 0:
            break
        pivot = x[far]
        between = np.sqrt(((np.array(pivots) - pivot) ** 2).sum(axis=1))
        # A point nearer to its anchor than half the way to the new one stays.
        maybe = np.flatnonzero(away > between[owner] / 2)
        d = np.sqrt(((x[maybe] - pivot) ** 2).sum(axis=1))
        moved = d < away[maybe]
        owner[maybe[moved]], away[maybe[moved]] = k, d[moved]
        pivots.append(pivot)
    if len(pivots) == 1:
        return own, None, None
    by = np.argsort(owner, kind="stable")
    groups = np.split(by, np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1])
    groups = [g for g in groups if len(g)]
    balls = [_anchored(points, own[g], leaf) for g in groups]
    if len(balls) == 1:
        return balls[0]
    return _merged(balls, np.array([x[g].mean(axis=0) for g in groups]), np.array([away[g].max() for g in groups]))


def _merged(balls: list[tuple], center: np.ndarray, radius: np.ndarray) -> tuple:
    """One ball of many: always the two whose common ball is smallest are put together."""
    size = np.array([len(b[0]) for b in balls], dtype=np.float64)

    def joint(i: int) -> np.ndarray:
        d = np.sqrt(((center - center[i]) ** 2).sum(axis=1))
        return np.maximum(np.maximum(radius, radius[i]), (d + radius + radius[i]) / 2)

    cost = np.stack([joint(i) for i in range(len(balls))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        i, j = sorted(divmod(int(cost.argmin()), len(balls)))
        radius[i] = cost[i, j]
        center[i] = (center[i] * size[i] + center[j] * size[j]) / (size[i] + size[j])
        size[i] += size[j]
        balls[i] = (np.concatenate([balls[i][0], balls[j][0]]), balls[i], balls[j])
        gone = np.isinf(cost[i])
        cost[i] = joint(i)
        cost[i, gone] = np.inf
        cost[i, i] = np.inf
        cost[:, i] = cost[i]
        cost[j], cost[:, j] = np.inf, np.inf
    return balls[i]


class Block:
    """Some rows: ids, labels, integer vectors [rows, parts, width] and a tree for each part position."""

    def __init__(self, ids: list, labels: list, vectors: np.ndarray, leaf: int = LEAF_POINTS) -> None:
        self.ids, self.labels = ids, labels
        reach = np.abs(vectors).max(initial=0)
        self.vectors = vectors.astype(np.int16 if reach < 1 << 15 else np.int64)
        self.trees = [Tree(vectors[:, p], leaf) for p in range(vectors.shape[1])]

    def dump(self) -> bytes:
        """The arrays only: the class is sent to the tasks by value, so it is another one in each."""
        return pickle.dumps((self.ids, self.labels, self.vectors, [t.__dict__ for t in self.trees]))

    @classmethod
    def load(cls, data: bytes) -> Block:
        block = cls.__new__(cls)
        block.ids, block.labels, block.vectors, trees = pickle.loads(data)
        block.trees = []
        for state in trees:
            tree = Tree.__new__(Tree)
            tree.__dict__.update(state)
            block.trees.append(tree)
        return block

    def sums(self, books: np.ndarray) -> np.ndarray:
        """[parts, entries, width + 1]: sums and, last, numbers of the parts nearest to each entry."""
        out = np.zeros((*books.shape[:2], books.shape[2] + 1), dtype=np.int64)
        for p, tree in enumerate(self.trees):
            for nodes, entry, open_ in tree.walk(books[p]):
                own = entry >= 0
                np.add.at(out[p, :, :-1], entry[own], tree.sums[nodes[own]])
                np.add.at(out[p, :, -1], entry[own], (tree.hi - tree.lo)[nodes[own]])
                for node, left in zip(nodes[~own].tolist(), open_[~own], strict=True):
                    x = self.vectors[tree.order[tree.lo[node] : tree.hi[node]], p].astype(np.int64)
                    nearest, _ = _nearest(x, books[p], np.flatnonzero(left))
                    np.add.at(out[p, :, :-1], nearest, x)
                    out[p, :, -1] += np.bincount(nearest, minlength=books.shape[1])
        return out

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[rows, parts]: the nearest entries; [rows]: the squared distances summed over parts."""
        codes = np.zeros(self.vectors.shape[:2], dtype=np.int64)
        errors = np.zeros(len(self.vectors), dtype=np.int64)
        for p, tree in enumerate(self.trees):
            for nodes, entry, open_ in tree.walk(books[p]):
                for node, owner, left in zip(nodes.tolist(), entry.tolist(), open_, strict=True):
                    rows = tree.order[tree.lo[node] : tree.hi[node]]
                    x = self.vectors[rows, p].astype(np.int64)
                    nearest, d = _nearest(x, books[p], np.array([owner]) if owner >= 0 else np.flatnonzero(left))
                    codes[rows, p] = nearest
                    errors[rows] += d
        return codes, errors


def _nearest(x: np.ndarray, book: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of some entries for each point, the lower index on a tie, and the squared distance."""
    d = ((x[:, None] - book[entries][None]) ** 2).sum(axis=2)
    best = d.argmin(axis=1)
    return entries[best], d[np.arange(len(x)), best]


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), within the limit."""
    return np.clip(np.floor(vectors.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int64)


def _usable(vector: Column) -> Column:
    inner = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(inner, F.lit(False))


class Coder:
    """Codebooks over the parts of a table's vectors.

    Defined results: rows whose vector is null or holds a null or non-finite component are left out. Shorter
    vectors, and lengths that the parts do not divide, are filled up with zeros. Repeated rows count each
    for itself; with fewer rows than entries each row is an entry; rows without an id come last in the order
    of the first entries; an empty table gives no rows. Components beyond LIMIT count as LIMIT. Further
    columns are not looked at.
    """

    def __init__(
        self,
        rows: DataFrame,
        id_col: str = "vec_id",
        vector_col: str = "embedding",
        label_col: str = "label",
        parts: int = PARTS,
        entries: int = ENTRIES,
        rounds: int = ROUNDS,
        scale: int = SCALE,
        block_rows: int = BLOCK_ROWS,
    ) -> None:
        self.parts, self.scale = parts, scale
        kept = rows.select(
            F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        ).where(_usable(F.col("vector")))
        length = kept.agg(F.max(F.size("vector"))).first()[0] or 0
        self.width = -(-length // parts)
        self.blocks = cut(self._blocks(kept, block_rows))
        first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
        start = np.zeros((len(first), parts * self.width), dtype=np.int64)
        for k, row in enumerate(first):
            start[k, : len(row.vector)] = whole(np.array(row.vector, dtype=np.float64), scale)
        self.books = start.reshape(len(first), parts, self.width).transpose(1, 0, 2).copy()
        for _ in range(rounds if len(first) else 0):
            self.books = self._averaged(self.books)

    def _blocks(self, kept: DataFrame, block_rows: int) -> DataFrame:
        parts, width, scale = self.parts, self.width, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
                rows = pa.Table.from_batches(held)
                lists = rows.column(2).combine_chunks()
                sizes = np.diff(lists.offsets.to_numpy())
                vectors = np.zeros((len(sizes), parts * width))
                at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                vectors[np.repeat(np.arange(len(sizes)), sizes), at] = lists.flatten().to_numpy()
                made = Block(rows.column(0).to_pylist(), rows.column(1).to_pylist(), whole(vectors, scale).reshape(-1, parts, width))
                return pa.RecordBatch.from_pydict({"block": pa.array([made.dump()], pa.binary())})

            held, size = [], 0
            for batch in batches:
                while batch.num_rows:
                    taken = batch.slice(0, block_rows - size)
                    batch = batch.slice(taken.num_rows)
                    held.append(taken)
                    size += taken.num_rows
                    if size == block_rows:
                        yield block(held)
                        held, size = [], 0
            if size:
                yield block(held)

        return kept.mapInArrow(run, "block binary")

    def _averaged(self, books: np.ndarray) -> np.ndarray:
        """The codebooks after one round; unused entries stay."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((*books.shape[:2], books.shape[2] + 1), dtype=np.int64)
            for batch in batches:
                for data in batch.column(0):
                    total += Block.load(data.as_py()).sums(books)
            yield pa.RecordBatch.from_pydict({"spot": pa.array(np.arange(total.size)), "amount": pa.array(total.reshape(-1))})

        found = self.blocks.mapInArrow(run, "spot bigint, amount bigint").groupBy("spot").agg(F.sum("amount").alias("amount"))
        sums = np.zeros((*books.shape[:2], books.shape[2] + 1), dtype=np.int64)
        for spot, amount in found.collect():  # one number for each component of the codebooks
            sums.reshape(-1)[spot] = amount
        used = sums[:, :, -1] > 0
        return np.where(used[:, :, None], sums[:, :, :-1] // np.maximum(1, sums[:, :, -1])[:, :, None], books)

    def encoded(self) -> DataFrame:
        """(vec_id, label, code array<int>, error) of each kept row."""
        books = self.books

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(0):
                    block = Block.load(data.as_py())
                    codes, errors = block.codes(books)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "vec_id": pa.array(block.ids, pa.int64()),
                            "label": pa.array(block.labels, pa.string()),
                            "code": pa.array(list(codes), pa.list_(pa.int32())),
                            "error": pa.array(errors),
                        }
                    )

        return self.blocks.mapInArrow(run, "vec_id bigint, label string, code array<int>, error bigint")

    def sha256(self) -> str:
        """Of all entries' components, by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def code_digest(embeddings: DataFrame, **settings: object) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept row; see `Coder`."""
    coder = Coder(embeddings, **settings)
    rows = cut(coder.encoded())
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("bigint"))), 2, "0")), "")
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(coder.sha256()).alias("codebooks_sha256"))
