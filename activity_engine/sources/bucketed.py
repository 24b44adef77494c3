"""Tables that are stored by key, so that dedupe, upsert and as-of join move no row (U-1, U-2, J-2).

Rows are dealt into buckets by a hash of the key once, when they are written, one sorted file a bucket. Spark
reads a bucket as one partition, so every later step that works per key starts where the rows are. A
bucket is a task: a key that holds a large share of the rows makes a large task, and belongs in the
operators that split hot keys instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write `df` under `path` as a table of the session's catalog, and read it back."""
    rows = df.repartition(buckets, *keys)  # one task, and so one file, a bucket
    writer = rows.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def upsert_colocated(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """`upsert_newest` of two tables with one row per key that are stored by it: a join in place, and no union.

    A source row replaces the target row only when its version is strictly higher. Keys are not NULL.
    """
    columns = target.columns
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = source.select(*keys, F.struct(*columns).alias("_new"))
    both = old.join(new, list(keys), "full_outer")
    wins = F.col("_old").isNull() | (F.col(f"_new.{version}") > F.col(f"_old.{version}"))
    return both.select(F.when(wins, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def asof_colocated(fact: DataFrame, dim: DataFrame, on: Sequence[str], ts: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """`asof_validity_join`, left, of tables that are stored by the same keys.

    The versions of a key are gathered into one sorted array where they lie, joined in place, and each fact takes
    the last one that has begun, if it still holds. Of versions that begin together the one that is greatest
    by its columns counts. The work for a fact grows with its key's versions, so the dimension has few a key.
    """
    added = [c for c in dim.columns if c not in on]
    version = F.struct(F.col(valid_from).alias("_from"), F.struct(*added).alias("_version"))
    gathered = dim.where(F.col(valid_from).isNotNull()).groupBy(*on).agg(F.array_sort(F.collect_list(version)).alias("_versions"))
    joined = fact.join(gathered, list(on), "left")
    begun = F.filter("_versions", lambda v: v["_from"] <= F.col(ts))
    joined = joined.withColumn("_last", F.try_element_at(begun, F.lit(-1))["_version"])
    holds = F.col("_last").isNotNull() & (F.col(f"_last.{valid_to}").isNull() | (F.col(ts) < F.col(f"_last.{valid_to}")))
    return joined.select(*fact.columns, *(F.when(holds, F.col(f"_last.{c}")).alias(c) for c in added))
