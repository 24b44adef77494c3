"""Document fingerprints by invertible Bloom lookup sketches, with DataFrame functions only.

A text is the set of the digests of its paragraphs (lines, and of long lines the sentences). Its sketch has
three tables of `width` cells; each digest is put into one cell of each table, and a cell holds the number
of its digests, their exclusive or and that of their check sums. Sketches subtract cell by cell, which
cancels what both texts have; what is left is peeled: a cell with one digest, which its check sum proves,
gives that digest away, which is then taken out of the other two tables. If nothing is left, exactly the
differing digests have come out. If something is, the pair is sketched again with twice the width and
other places, until it peels. The first width follows the number of digests of both texts.

The sketch of fixed width is the fingerprint of a text. All aggregations of a pair run where its row lies:
rows are dealt out once, by ranges of the id, together with the row that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.llm.common import cut

# Sentences of a line; what stands between line ends and closing marks, without leading spaces.
PARAGRAPH = r"[^\n.!? ][^\n.!?]*[.!?]*|[.!?]+"
WIDTH = 8
PRIME = (1 << 31) - 1
# Tables are peeled in turn, so many in all, before a pair counts as failed.
PEELS = 7
# Failed pairs that are sent to all tasks; more are joined.
BROADCAST_ROWS = 100_000
# Characters of a chunk of rows about, chunks of a task, chunks and quantiles of the id at most.
CHUNK_CHARS, TASK_CHUNKS, MOST_CHUNKS, QUANTILES = 1 << 19, 4, 1 << 16, 1024


def digests(text: Column, paragraph: str = PARAGRAPH) -> Column:
    """The distinct digests of a text's paragraphs, as whole numbers of 60 bits."""
    found = F.regexp_extract_all(text, F.lit(paragraph), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.conv(F.substring(F.md5(p.cast("binary")), 1, 15), 16, 10).cast("bigint")))


def multipliers(number: int, salt: int) -> tuple[int, int]:
    """Two factors for the number-th hash of a turn: powers of two primitive roots modulo the prime.

    Their ratio is another one for each hash, so digests that one hash puts together are parted by the next.
    """
    return pow(48271, 11 + 8 * salt + 2 * number, PRIME), pow(16807, 13 + 5 * salt + 3 * number, PRIME)


def _hash(key: Column, number: int, salt: int) -> Column:
    """A hash of a digest under the prime: a sum of its halves' multiples, which stays within 63 bits."""
    low, high = multipliers(number, salt)
    return (key % F.lit(1 << 30) * F.lit(low) + F.shiftright(key, 30) * F.lit(high)) % F.lit(PRIME)


def _check(key: Column, salt: int) -> Column:
    return _hash(key, 3, salt)


def _cell(key: Column, table: int, width: Column, salt: int) -> Column:
    return _hash(key, table, salt) % width


def sketch(rows: DataFrame, by: list[str], salt: int = 0, sign: Column | None = None) -> DataFrame:
    """(*by, width, part, place, n, key, sum): the cells that are not empty, of each group's digests.

    `rows` has `by`, `width` and `key`, one row a digest; `sign` is what a digest counts, 1 if not given.
    Summing the sketches of two texts with opposite signs subtracts them.
    """
    key, count = F.col("key"), (F.lit(1) if sign is None else sign).cast("bigint")
    places = F.array(*(F.struct(F.lit(t).alias("part"), _cell(key, t, F.col("width"), salt).alias("place")) for t in range(3)))
    put = rows.select(*by, "width", count.alias("n"), "key", _check(key, salt).alias("sum"), F.explode(places).alias("_c"))
    put = put.select(*by, "width", "_c.part", "_c.place", "n", "key", "sum")
    return _added(put, by)


def _added(cells: DataFrame, by: list[str]) -> DataFrame:
    added = cells.groupBy(*by, "width", "part", "place")
    return added.agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("sum").alias("sum"))


def peel(cells: DataFrame, by: list[str], salt: int = 0, peels: int = PEELS, listed: bool = False) -> DataFrame:
    """The cells of subtracted sketches after peeling; part 3 is what came out.

    With `listed` part 3 has a row for each digest that came out, n being 1 or -1 for the side that has it;
    else one row for each side with their number in n. Cells of parts 0 to 2 are left only if a sketch did
    not peel.
    """
    for turn in range(peels):
        part = turn % 3
        pure = (F.col("part") == part) & (F.abs("n") == 1) & (F.col("sum") == _check(F.col("key"), salt))
        out_place = F.col("key") if listed else F.when(F.col("n") > 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
        out_key = F.col("key") if listed else F.lit(0).cast("bigint")

        def row(part: Column, place: Column, n: Column, key: Column, check: Column) -> Column:
            return F.struct(part.alias("part"), place.alias("place"), n.alias("n"), key.alias("key"), check.alias("sum"))

        others = [t for t in range(3) if t != part]
        moved = F.array(
            row(F.lit(3), out_place, F.col("n"), out_key, F.lit(0).cast("bigint")),
            *(row(F.lit(t), _cell(F.col("key"), t, F.col("width"), salt), -F.col("n"), F.col("key"), F.col("sum")) for t in others),
        )
        stays = F.array(row(F.col("part"), F.col("place"), F.col("n"), F.col("key"), F.col("sum")))
        dealt = cells.select(*by, "width", F.explode(F.when(pure, moved).otherwise(stays)).alias("_c"))
        cells = _added(dealt.select(*by, "width", "_c.*"), by).where("part = 3 or n != 0 or key != 0 or sum != 0")
    return cells


def compare(rows: DataFrame, by: list[str], pairs: dict[str, tuple[str, str]], tasks: int | None = None, factor: float = 1.0, peels: int = PEELS) -> DataFrame:
    """(*by, pair, differing): how many digests only one side of each pair has, for every row and pair.

    `by` tells the rows apart and `pairs` names two columns of digests for each pair. The width is the power of
    two that holds `factor` times the digests of both sides; pairs that do not peel are tried again with
    twice the width and other places, and so on. Only the number of failed pairs comes to the driver. Rows are
    dealt out by the first of `by`, and all cells of a row stay where it is. Pairs without any difference
    may be missing.
    """
    columns = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    sides = F.array(*(F.struct(F.lit(p).alias("pair"), F.col(a).alias("a"), F.col(b).alias("b")) for p, (a, b) in pairs.items()))
    key, found, failed, salt = [*by, "pair"], None, None, 0
    while True:
        held = rows.select(*by, *columns)
        if failed is not None:
            again = failed.groupBy(*by).agg(F.collect_set("pair").alias("_open"))
            held = held.join(F.broadcast(again) if count <= BROADCAST_ROWS else again, by)
        held = held.repartition(tasks, by[0]) if tasks else held.repartition(by[0])
        every = held.select(*by, *([] if failed is None else ["_open"]), F.explode(sides).alias("_p"))
        every = every if failed is None else every.where(F.array_contains("_open", F.col("_p.pair")))
        digits = F.greatest(F.lit(2.0), (F.size("_p.a") + F.size("_p.b")) * F.lit(float(factor)))
        width = F.pow(F.lit(2.0), F.ceil(F.log2(digits)) + salt).cast("bigint")
        put = every.select(
            *by, "_p.pair", width.alias("width"), F.size("_p.a").alias("_a"), F.posexplode(F.concat("_p.a", "_p.b")).alias("_at", "key")
        )
        sign = F.when(F.col("_at") < F.col("_a"), F.lit(1)).otherwise(F.lit(-1))
        cells = sketch(put, key, salt, sign).where("n != 0 or key != 0 or sum != 0")
        came = F.coalesce(F.sum(F.when(F.col("part") == 3, F.abs("n"))), F.lit(0).cast("bigint"))
        state = peel(cells, key, salt, peels).groupBy(*key)
        done = cut(state.agg(came.alias("differing"), F.count_if(F.col("part") < 3).alias("left")))
        found = done if found is None else found.unionByName(done)
        failed, salt = done.where("left > 0"), salt + 1
        count = failed.count()
        if not count:
            return found.where("left = 0").drop("left")


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """What two sets share of all they have, from their sizes and the number of differing members; 1 if both are empty."""
    both = a + b
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def fingerprint(keys: Column, width: int = WIDTH) -> Column:
    """The sketch of fixed width of an array of digests, as text: `place:n:digests:check sums` in hexadecimal digits.

    Cells are in order and empty ones left out, so a text without paragraphs has an empty fingerprint. Every
    row is sketched by itself, cell by cell, in one pass over its digests for each cell.
    """

    def put(key: Column) -> Column:
        return F.struct(key.alias("key"), _check(key, 0).alias("sum"), *(_cell(key, t, F.lit(width), 0).alias(f"c{t}") for t in range(3)))

    def cell(members: Column, at: int) -> Column:
        none = F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("n", "key", "sum")))

        def add(held: Column, member: Column) -> Column:
            more = F.struct((held["n"] + 1).alias("n"), held["key"].bitwiseXOR(member["key"]).alias("key"), held["sum"].bitwiseXOR(member["sum"]).alias("sum"))
            return F.when(member[f"c{at // width}"] == at % width, more).otherwise(held)

        def text(held: Column) -> Column:
            return F.when(held["n"] > 0, F.concat_ws(":", F.lit(f"{at:x}"), *(F.lower(F.hex(held[c])) for c in ("n", "key", "sum"))))

        return F.aggregate(members, none, add, text)

    # The members are worked out once: an array of one array, taken apart by a lambda.
    whole = F.transform(F.array(F.transform(keys, put)), lambda members: F.concat_ws(";", *(cell(members, at) for at in range(3 * width))))
    return whole[0]


def _chunked(documents: DataFrame) -> tuple[DataFrame, int]:
    """The rows with `chunk`, a range of the ids that grows with them, and about how many there are.

    Ranges are quantiles of the id cut into equal widths, so the borders are bounded. Rows without an id come
    below all others, in ranges of their texts' hash.
    """
    facts = documents.agg(
        F.coalesce(F.sum(F.length("text") + 64), F.lit(0)).alias("chars"),
        F.percentile_approx("doc_id", F.array(*(F.lit(i / QUANTILES) for i in range(QUANTILES + 1))), 10_000).alias("borders"),
    ).first()
    chunks = max(1, min(MOST_CHUNKS, -(-int(facts.chars) // CHUNK_CHARS)))
    step = max(1, QUANTILES // chunks)
    borders = sorted({*(facts.borders or [0])[::step]})
    inner = -(-chunks // len(borders))
    at = F.aggregate(
        F.array(*(F.lit(QUANTILES * 2 >> i) for i in range(1, (QUANTILES * 2).bit_length()))),
        F.lit(0),
        lambda at, more: F.when((at + more <= len(borders)) & (F.try_element_at(F.lit(borders), at + more) <= F.col("doc_id")), at + more).otherwise(at),
    )
    placed = documents.withColumn("_q", at)
    low = F.coalesce(F.try_element_at(F.lit(borders), F.greatest(F.col("_q"), F.lit(1))), F.lit(0)).cast("double")
    high = F.coalesce(F.try_element_at(F.lit(borders), F.col("_q") + 1), F.lit(borders[-1] + 1)).cast("double")
    share = F.greatest(F.lit(0.0), F.least(F.lit(0.999999), (F.col("doc_id").cast("double") - low) / F.greatest(high - low, F.lit(1.0))))
    own = F.col("_q").cast("bigint") * inner + F.floor(share * inner)
    below = F.floor((F.lit(0.5) - F.col("_h") / F.lit(2.0**64)) * F.lit(float(chunks)))
    placed = placed.withColumn("chunk", F.when(F.col("doc_id").isNull(), -1 - below).otherwise(own))
    return placed.drop("_q"), chunks


def with_next(documents: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, rn, doc_id, text, next), and a number of tasks for as many rows: each row with the text that follows in descending order of the id.

    After the last row comes the first. Equal ids stand in the order of their texts' hash, rows without an
    id at the end. The whole table moves once: the first row of each chunk is sent to the chunk before it,
    too. (chunk, rn) tells rows apart. Rows of one id stand in one chunk.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed, chunks = _chunked(rows.withColumn("_h", F.xxhash64("text")))
    # One row a chunk, MOST_CHUNKS at most beside those of rows without an id, which are no more.
    firsts = placed.groupBy("chunk").agg(F.max(F.struct("doc_id", "_h")).alias("_f"))
    before = F.lag("chunk").over(Window.orderBy(F.col("chunk").desc()))
    firsts = firsts.select("chunk", "_f", F.coalesce(before, F.min("chunk").over(Window.partitionBy())).alias("_to"))
    marked = placed.join(F.broadcast(firsts), "chunk")
    is_first = F.col("doc_id").eqNullSafe(F.col("_f.doc_id")) & (F.col("_h") == F.col("_f._h"))
    here = F.struct("chunk", F.lit(False).alias("ghost"))
    there = F.struct(F.col("_to").alias("chunk"), F.lit(True).alias("ghost"))
    sent = marked.select("doc_id", "text", "_h", F.explode(F.when(is_first, F.array(here, there)).otherwise(F.array(here))).alias("_c"))
    tasks = -(-chunks // TASK_CHUNKS)
    sent = sent.select("_c.*", "doc_id", "text", "_h").repartition(tasks, "chunk")
    order = Window.partitionBy("chunk").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.col("_h").desc(), "text")
    rows = sent.withColumn("next", F.lead("text").over(order)).withColumn("rn", F.row_number().over(order))
    return rows.where("not ghost").select("chunk", "rn", "doc_id", "text", "next"), tasks


def fingerprint_digest(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the first characters of the next document (`with_next`).

    Defined results: a null text is an empty one; a text without paragraphs has an empty fingerprint, and two
    such texts are alike by 1; paragraphs that repeat in a text count once; equal texts have equal
    fingerprints; repeated rows count each for itself; a single row follows itself; an empty table gives no
    rows. Further columns are not looked at.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, tasks = with_next(docs)
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = cut(
        rows.select(
            "chunk", "rn", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next")).alias("after"),
        )
    )
    by = ["chunk", "rn"]
    found = compare(rows, by, {"edited": ("own", "changed"), "next": ("own", "after")}, tasks)
    found = found.groupBy(*by).agg(*(F.max(F.when(F.col("pair") == p, F.col("differing"))).alias(f"_{p}") for p in ("edited", "next")))
    sizes = [F.size(c).alias(f"_n_{c}") for c in ("own", "changed", "after")]
    out = rows.select(*by, "doc_id", "n_chars", "edited_sha256", "own", "changed", *sizes).join(found, by, "left")
    near = [
        likeness(F.col("_n_own"), F.col(f"_n_{other}"), F.coalesce(differing, F.lit(0))).alias(name)
        for other, differing, name in (("changed", "_edited", "near_edited"), ("after", "_next", "near_next"))
    ]
    prints = [fingerprint(F.col(c)).alias(name) for c, name in (("own", "fingerprint"), ("changed", "edited_fingerprint"))]
    return out.select("doc_id", "n_chars", "edited_sha256", *prints, *near)
