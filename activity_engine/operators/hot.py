"""Splitting of hot keys along an order column.

A window ordered by time (or by a measure) puts all rows of a key into one task. That is fine for
ordinary keys and ruinous for one that holds a third of the data. Keys with more than `hot_rows`
rows are therefore cut into chunks, contiguous ranges of the order column, and the window runs per
(key, chunk). What has to cross a chunk border (a next version, a version carried in, a count) is
worked out on one row per chunk. Without hot keys the plan stays a single window; the rows that come
out are the same either way.

The borders are quantiles of the key's own positions, worked out by Spark with partial sketches per
task and joined to the rows as a table, so neither rows nor borders pass through the driver. Only rows
with the very same position cannot be parted. A NULL key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = "_chunk"
HOT_ROWS = 500_000
# A hot key has at most so many chunks. This bounds the borders that a row of it carries for a moment;
# it leaves no key unsplit.
MAX_CHUNKS = 1024
SCATTERED = 4096


def position(order: str, dtype: str) -> Column:
    """The order column as a double, so that chunk borders can be computed."""
    c = F.col(order)
    if dtype == "timestamp_ntz":
        c = c.cast("timestamp")
    if dtype.startswith("timestamp"):
        return F.unix_micros(c).cast("double")
    if dtype == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _same_key(keys: Sequence[str]) -> tuple[list[Column], Column]:
    """The keys under names of their own, and the condition that joins them, NULL to NULL."""
    renamed = [F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)]
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_hot_{i}"))
    return renamed, same


def hot_keys(rows: DataFrame, keys: Sequence[str], order: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The chunk borders (`_borders`, ascending) of the keys with more than `hot_rows` rows, or None.

    One job counts the rows per key, before the shuffle; only its largest count comes to the driver.
    The borders are worked out from the rows of hot keys, and only if there are any.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most = counts.agg(F.max("_rows")).first()[0] or 0
    if most <= hot_rows:
        return None
    chunks = min(MAX_CHUNKS, -(-most // max(1, hot_rows)) + 1)
    renamed, same = _same_key(keys)
    hot = counts.where(F.col("_rows") > hot_rows).select(*renamed)
    spots = rows.select(*keys, position(order, dict(rows.dtypes)[order]).alias("_at")).join(hot, same, "left_semi")
    shares = F.array(*(F.lit(i / chunks) for i in range(1, chunks)))
    return spots.groupBy(*keys).agg(F.percentile_approx("_at", shares, 10_000).alias("_borders"))


def has_hot_key(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether any key has more than `hot_rows` rows; one job over the keys."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return not counts.where(F.col("_rows") > hot_rows).isEmpty()


def _chunk_of(spot: Column) -> Column:
    """How many borders are at or below the position (binary search); 0 for a NULL one."""
    steps = F.array(*(F.lit(MAX_CHUNKS >> i) for i in range(1, MAX_CHUNKS.bit_length())))

    def further(at: Column, step: Column) -> Column:
        reached = (at + step <= F.size("_borders")) & (F.try_element_at("_borders", at + step) <= spot)
        return F.when(reached, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further).cast("bigint")


def assign_chunks(
    rows: DataFrame,
    hot: DataFrame | None,
    keys: Sequence[str],
    order: str,
    only_hot: bool = False,
    scatter: bool = False,
) -> DataFrame:
    """Add the chunk; it never decreases as the order column grows within a key, NULLs first.

    `only_hot` keeps just the rows of hot keys, for the border pass. With `scatter`, rows with a NULL key
    or position, which then must match nothing, are spread over many chunks by a hash of their flat
    columns.
    """
    spot = position(order, dict(rows.dtypes)[order])
    flat = [c for c, t in rows.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    chunk = F.lit(0).cast("bigint")
    joined = rows
    if hot is not None:
        renamed, same = _same_key(keys)
        joined = rows.join(hot.select(*renamed, "_borders"), same, "inner" if only_hot else "left")
        chunk = F.when(F.col("_borders").isNull(), chunk).otherwise(_chunk_of(spot))
    if scatter:
        unmatched = spot.isNull()
        for key in keys:
            unmatched = unmatched | F.col(key).isNull()
        chunk = F.when(unmatched, -1 - F.pmod(F.xxhash64(*flat), F.lit(SCATTERED))).otherwise(chunk)
    return joined.select(*rows.columns, chunk.alias(CHUNK))
