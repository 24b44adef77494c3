"""Type-2 history: snapshots, one-pass history, current versions (V-1, V-2, V-4)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.operators.hot import CHUNK, HOT_ROWS, assign_chunks, hot_keys


def first_snapshot(current: DataFrame, updated_at: str) -> DataFrame:
    """Every row becomes an open version."""
    return current.withColumn("valid_from", F.col(updated_at)).withColumn(
        "valid_to", F.lit(None).cast(dict(current.dtypes)[updated_at])
    )


def snapshot_timestamp(history: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """One snapshot run: history plus what `current` (one row per key) changed.

    A newer row closes the open version at its own `updated_at` and opens another; an equal or older
    one changes nothing; a key missing from `current` stays open. Both join sides hold one row per key.
    """
    columns = history.columns
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(F.struct(*columns).alias("_old"), F.col(key).alias("_key"))
    new = first_snapshot(current, updated_at).select(F.struct(*columns).alias("_new"), F.col(key).alias("_key"))

    changed = F.col("_old").isNull() | (F.col("_new.valid_from") > F.col("_old.valid_from"))
    takes_new = F.col("_new").isNotNull() & changed
    old_after = F.when(
        F.col("_old").isNotNull(),
        F.when(takes_new, F.col("_old").withField("valid_to", F.col("_new.valid_from"))).otherwise(F.col("_old")),
    )
    after = F.array_compact(F.array(old_after, F.when(takes_new, F.col("_new"))))
    merged = old.join(new, "_key", "full_outer").select(F.explode(after).alias("_row")).select("_row.*")
    return history.where(~is_open).unionByName(merged)


def scd2_history(
    log: DataFrame, keys: Sequence[str], version: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every logged version with its validity, in one pass; (keys, version) must be unique.

    `valid_to` is the next version of the key, NULL on the last one. A NULL key is a key like any other.
    """
    hot = hot_keys(log, keys, version, hot_rows)
    if hot is None:
        versions = Window.partitionBy(*keys).orderBy(version)
        followed = log.withColumn("valid_to", F.lead(version).over(versions))
    else:
        followed = _followed_in_chunks(log, hot, keys, version)
    return followed.withColumn("valid_from", F.col(version)).select(*log.columns, "valid_from", "valid_to")


def _followed_in_chunks(log: DataFrame, hot: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """`valid_to` with hot keys split: the last version of a chunk is followed by the first one of the
    key's next chunk, which is put at its end as a border row."""
    plain = assign_chunks(log, hot, keys, version).withColumn("_border", F.lit(False))
    firsts = (
        assign_chunks(log.select(*keys, version), hot, keys, version, only_hot=True)
        .groupBy(*keys, CHUNK)
        .agg(F.min(version).alias("_first"))
    )
    chunks_in_order = Window.partitionBy(*keys).orderBy(CHUNK)
    borders = (
        firsts.withColumn("_next", F.lead("_first").over(chunks_in_order))
        .where(F.col("_next").isNotNull())
        .select(*keys, F.col("_next").alias(version), CHUNK, F.lit(True).alias("_border"))
    )
    versions = Window.partitionBy(*keys, CHUNK).orderBy(F.col(version).asc(), F.col("_border").asc())
    return (
        plain.unionByName(borders, allowMissingColumns=True)
        .withColumn("valid_to", F.lead(version).over(versions))
        .where(~F.col("_border"))
    )


def snapshots_at(
    log: DataFrame, keys: Sequence[str], version: str, moments: Sequence[datetime | str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """What snapshot runs at the given moments leave behind, in one pass over the log.

    A run sees the newest version of each key up to its moment. So a version is recorded if a moment lies
    between it and the next one, and it ends where the next recorded one begins. (keys, version) must be
    unique; versions after the last moment are not seen. Both windows share the key's one exchange, and hot
    keys are split as in `scd2_history`.
    """
    kind = dict(log.dtypes)[version]
    runs = F.array(*(F.lit(m).cast(kind) for m in sorted(moments, key=str)))
    seen = log.where(F.col(version) <= F.array_max(runs))
    followed = scd2_history(seen, keys, version, hot_rows)
    until = F.coalesce("valid_to", F.array_max(runs) + F.expr("interval 1 day"))
    caught = F.exists(runs, lambda m: (m >= F.col(version)) & (m < until))
    return scd2_history(followed.where(caught).drop("valid_from", "valid_to"), keys, version, hot_rows)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))
