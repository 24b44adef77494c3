"""As-of join on a validity interval (J-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.operators.hot import CHUNK, HOT_ROWS, assign_chunks, hot_keys

# More versions per key than this and a broadcast join would compare too many pairs.
BROADCAST_VERSIONS = 64


def asof_validity_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    ts: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Attach to each fact row the dimension version with `valid_from <= ts < valid_to`.

    The newest version that has begun decides, whichever way the join is made: where intervals of a key
    overlap, a version ends when the next one begins. Of versions that begin together the one that is
    greatest by its columns counts. A NULL `valid_to` is open.

    Written as a merge, not as an equi-join with a range condition: facts and versions of a key are
    sorted together once and the last version seen is carried forward. Work per key is linear, where
    the join would compare every fact with every version of its key. Only the dimension columns other
    than `on` are added; rename clashing ones first.

    With `broadcast_rows` set, the dimension is counted first (one small job). If it has no more rows
    than that and no key has more than BROADCAST_VERSIONS, it is broadcast and the facts stay put.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    added = [c for c in dim.columns if c not in on]
    clash = [c for c in added if c in fact.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")

    if broadcast_rows and is_small(dim, on, broadcast_rows):
        return _broadcast_join(fact, dim, on, ts, valid_from, valid_to, how)

    facts = fact.withColumn("_at", F.col(ts).cast("timestamp")).withColumn("_is_fact", F.lit(True))
    versions = (
        dim.where(F.col(valid_from).isNotNull())
        .select(
            *on,
            F.col(valid_from).cast("timestamp").alias("_at"),
            F.lit(False).alias("_is_fact"),
            F.struct(*added).alias("_version"),
        )
        .dropna(subset=list(on))
    )

    moments = facts.select(*on, "_at").unionByName(versions.select(*on, "_at"))
    hot = hot_keys(moments, on, "_at", hot_rows)
    merged = assign_chunks(facts.unionByName(versions, allowMissingColumns=True), hot, on, "_at", scatter=True)
    if hot is not None:
        carried = _carried_in(facts.select(*on, "_at"), versions, hot, on)
        merged = merged.unionByName(carried, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*on, CHUNK)
        .orderBy(F.col("_at").asc(), F.col("_is_fact").asc(), F.col("_version").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.last("_version", ignorenulls=True).over(so_far)
    seen = merged.withColumn("_version", last).where(F.col("_is_fact"))

    end = F.col(f"_version.{valid_to}")
    has_key = F.col("_at").isNotNull()
    for key in on:
        has_key = has_key & F.col(key).isNotNull()
    holds = has_key & F.col("_version").isNotNull() & (end.isNull() | (F.col("_at") < end.cast("timestamp")))
    if how == "inner":
        seen = seen.where(holds)
    return seen.select(
        *fact.columns, *(F.when(holds, F.col(f"_version.{c}")).alias(c) for c in added)
    )


def is_small(dim: DataFrame, on: Sequence[str], rows: int) -> bool:
    """Whether a dimension, counted now, may be broadcast."""
    per_key = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    total, most = per_key.agg(F.sum("n"), F.max("n")).first()
    return total is None or (total <= rows and most <= BROADCAST_VERSIONS)


def _broadcast_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], ts: str, valid_from: str, valid_to: str, how: str
) -> DataFrame:
    added = [c for c in dim.columns if c not in on]
    begins = Window.partitionBy(*on).orderBy(F.col(valid_from).cast("timestamp"), F.struct(*added))
    following = F.lead(F.col(valid_from).cast("timestamp")).over(begins)
    clipped = dim.where(F.col(valid_from).isNotNull()).withColumn("_until", F.least(F.col(valid_to).cast("timestamp"), following))
    f, d = fact.alias("f"), F.broadcast(clipped).alias("d")
    start, end, at = F.col(f"d.{valid_from}"), F.col("d._until"), F.col(f"f.{ts}").cast("timestamp")
    match = (at >= start.cast("timestamp")) & (end.isNull() | (at < end))
    for key in on:
        match = match & (F.col(f"f.{key}") == F.col(f"d.{key}"))
    return f.join(d, match, how).select("f.*", *(F.col(f"d.{c}") for c in added))


def _carried_in(facts: DataFrame, versions: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """For each chunk of a hot key: the version in force when the chunk begins."""
    rows = facts.unionByName(versions.drop("_is_fact"), allowMissingColumns=True)
    is_version = F.col("_version").isNotNull()
    newest = F.struct(F.col("_at"), F.col("_version"))
    per_chunk = (
        assign_chunks(rows, hot, on, "_at", only_hot=True)
        .groupBy(*on, CHUNK)
        .agg(F.max(F.when(is_version, newest)).alias("_newest"))
    )
    before = Window.partitionBy(*on).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_chunk.withColumn("_newest", F.last("_newest", ignorenulls=True).over(before))
        .where(F.col("_newest").isNotNull())
        .select(*on, CHUNK, "_newest._at", "_newest._version", F.lit(False).alias("_is_fact"))
    )
