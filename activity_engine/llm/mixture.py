"""Mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target number of words: shares of the whole by weight, with a ceiling per source
whose excess is shared out again among the others. A source has as many slots of equally many words as its
target needs, the last one cut at the target. The slots of all sources, one source after the other, are the
points of an even grid, and the van der Corput sequence (slot s takes the point whose bits are those of s
reversed) deals them out, so every stretch of the schedule holds each source close to its share. Points
behind the last source's are nobody's, and their slots are left out. The r-th slot of a source takes the
r-th block of that source's words, in an order shuffled by a hash, and a second pass over the source
follows the first. Which slot is the r-th among a range of points is worked out from r by halving, bit by
bit, so there is no table of slots to make, rank or join.

Only DataFrame functions are used. Orders within a source (which may hold a third of all rows) are
built in two levels: counts per chunk are summed up first and rows are ordered inside a chunk only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.llm.common import cut

# Words of a slot, and rows of a chunk on average.
BLOCK_WORDS = 64
CHUNK_ROWS = 4096

_RUNNING = (Window.unboundedPreceding, Window.currentRow)


def count_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    starts = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return starts.cast("bigint")


def source_targets(sizes: DataFrame, weights: list[float], share: float, ceiling: float) -> DataFrame:
    """(source, source_size) -> with target: `share` of all words, dealt by weight under a ceiling.

    Weights repeat over the sources in code-point order, null last. A target stops at `ceiling` times
    the source's size and what is cut off is shared out by weight among the rest until none is above:
    with sources ordered by ceiling per weight, the first ones are at their ceilings and the others get
    one common level per weight. Input: one row per source, so the single ordered window is small.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1
    dealt = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), n))
    dealt = dealt.withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    dealt = (
        dealt.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("open", F.col("most") / F.col("weight") > F.col("level"))
        .withColumn("common", F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), "level"))).over(everything)["level"])
    )
    target = F.when(F.col("open"), F.least("most", F.col("weight") * F.col("common"))).otherwise(F.col("most"))
    return dealt.select("source", "source_size", target.alias("target"))


def _shuffled(docs: DataFrame, seed: int) -> DataFrame:
    """Documents with the words before them in their source's shuffled order.

    A chunk is a range of the shuffle hash; its number of chunks follows the source's number of rows.
    """
    spot = F.xxhash64(F.lit(seed), "doc_id", "size")
    sizes = docs.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / CHUNK_ROWS)).alias("chunks"))
    unit = spot / F.lit(2.0**64) + F.lit(0.5)
    placed = (
        docs.join(sizes.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("spot", spot)
        .withColumn("chunk", F.least(F.floor(unit * F.col("chunks")), F.col("chunks") - 1))
        .drop("_s", "chunks")
    )
    return _with_start(placed, ["source"], "size", ["spot", "twin"])


def _with_start(rows: DataFrame, by: list[str], amount: str, order: list[str]) -> DataFrame:
    """`start`: the sum of `amount` over what stands before a row, by chunk and then by `order`."""
    sums = rows.groupBy(*by, "chunk").agg(F.sum(amount).alias("_sum"))
    chunks = Window.partitionBy(*by).orderBy("chunk").rowsBetween(*_RUNNING)
    bases = sums.select(*[F.col(c).alias(f"_{c}") for c in [*by, "chunk"]], (F.sum("_sum").over(chunks) - F.col("_sum")).alias("_base"))
    inside = Window.partitionBy(*by, "chunk").orderBy(*order).rowsBetween(*_RUNNING)
    rows = rows.withColumn("_in", F.sum(amount).over(inside) - F.col(amount))
    same = F.lit(True)
    for c in [*by, "chunk"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = rows.join(bases, same).withColumn("start", F.col("_base") + F.col("_in"))
    return joined.drop("_base", "_in", *[f"_{c}" for c in [*by, "chunk"]])


def slot_ranges(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`targets` with `most`, the whole words to take, and the grid points [lo, hi) of each source.

    Input: one row per source, so the single ordered window is small.
    """
    slots = F.ceil(F.floor("target") / block_words).cast("bigint")
    upto = F.sum("_slots").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(*_RUNNING))
    ranges = targets.withColumn("most", F.floor("target").cast("bigint")).withColumn("_slots", slots).withColumn("hi", upto)
    return ranges.withColumn("lo", F.col("hi") - F.col("_slots")).drop("_slots")


def slot_of(rank: Column, lo: Column, hi: Column, bits: int) -> Column:
    """The slot of the given rank among the points [lo, hi): the rank-th smallest of them with their bits reversed.

    A slot's highest bit is its point's lowest one. At each bit the points of the range that go on with a 0
    are counted, and the rank says whether the slot is one of them.
    """
    zero = F.lit(0).cast("bigint")
    start = F.struct(rank.cast("bigint").alias("rank"), zero.alias("low"), zero.alias("slot"), lo.alias("lo"), hi.alias("hi"))

    def step(state: Column, size: Column) -> Column:
        def below(end: Column) -> Column:
            """How many points under `end` have the low bits found so far and then a 0."""
            return F.greatest(zero, F.floor((end - state["low"] + 2 * size - 1) / (2 * size)))

        count = below(state["hi"]) - below(state["lo"])

        def next_(rank: Column, low: Column, bit: int) -> Column:
            return F.struct(rank.alias("rank"), low.alias("low"), (state["slot"] * 2 + bit).alias("slot"), state["lo"].alias("lo"), state["hi"].alias("hi"))

        return F.when(state["rank"] < count, next_(state["rank"], state["low"], 0)).otherwise(
            next_(state["rank"] - count, state["low"] + size, 1)
        )

    sizes = F.array(*(F.lit(1 << k).cast("bigint") for k in range(bits)))
    return F.aggregate(sizes, start, step, lambda s: s["slot"]) if bits else zero


def prepare(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(doc_id, source, size, twin), written once; `twin` tells rows apart whose id is null or repeated."""
    rows = documents.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size")
    )
    return cut(rows.withColumn("twin", F.monotonically_increasing_id()))


def mix(
    prepared: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    ceiling: float = 2.0,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The mix and the targets.

    The mix has (slot, rank, twin, doc_id, source, round, from_word, to_word): slot by slot, which words
    of which document to read; `round` counts the passes over the source. `prepared` is `prepare`'s.

    Defined results: documents without words take part in nothing; a null source is a source of its own
    and comes last; every source's words are its target without the fraction; an empty table gives an empty
    mix; repeated rows count each for itself.
    """
    sizes = prepared.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(slot_ranges(source_targets(sizes, list(weights), share, ceiling), block_words))
    slots = targets.agg(F.max("hi")).first()[0] or 0
    bits = max(0, slots - 1).bit_length()
    own = targets.select(F.col("source").alias("_s"), "source_size", "most", "lo", "hi")
    full = prepared.where("size > 0")
    rounds = None
    for number in range(int(-(-ceiling // 1))):
        placed = _shuffled(full, number).withColumn("round", F.lit(number))
        rounds = placed if rounds is None else rounds.unionByName(placed)
    spans = (
        rounds.join(own, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("a", F.col("start") + F.col("round") * F.col("source_size"))
        .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("most")))
        .where("b > a")
    )
    step = F.lit(block_words)
    blocks = F.sequence(F.floor(F.col("a") / step), F.floor((F.col("b") - 1) / step))
    cuts = spans.withColumn("rank", F.explode(blocks))
    cuts = cuts.withColumn("p", F.greatest("a", F.col("rank") * step)).withColumn("q", F.least("b", (F.col("rank") + 1) * step))
    mixed = cuts.select(
        slot_of(F.col("rank"), F.col("lo"), F.col("hi"), bits).alias("slot"), "rank", "twin", "doc_id", "source", "round",
        (F.col("p") - F.col("a")).alias("from_word"), (F.col("q") - F.col("a")).alias("to_word"),
    )
    return mixed, targets


def mix_digest(documents: DataFrame, **settings: object) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes), first_slot, n_slots.

    `first_slot` is the first slot of the schedule that reads the document (null if none does), `n_slots` the
    number of its pieces.
    """
    prepared = prepare(documents)
    mixed, targets = mix(prepared, **settings)
    taken = mixed.groupBy(F.col("twin").alias("_t")).agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots")
    )
    facts = targets.select(F.col("source").alias("_s"), "source_size", "target")
    none = F.lit(0).cast("bigint")
    return (
        prepared.join(taken, F.col("twin") == F.col("_t"), "left")
        .join(facts, F.col("source").eqNullSafe(F.col("_s")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), "first_slot", F.coalesce("n_slots", none).alias("n_slots"))
    )
