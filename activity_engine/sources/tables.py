"""Parquet tables that are replaced or merged (S-7, K-5 to K-7).

Folders of plain Parquet, written by Spark: a replace overwrites the folder, a merge overwrites only the
partitions that hold a touched key (dynamic partition overwrite stages the files of a job and puts them in
place when all tasks are done, so a table may be read by the job that rewrites part of it). Atomic commits,
writers at the same time, old states and clean-up are left to the table format a deployment runs; the
functions here are the place to plug one in.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.operators.dedupe import latest_per_key
from activity_engine.operators.upsert import upsert_newest
from activity_engine.schemas import Entity
from activity_engine.sources.files import exists, observed, remove

DAY = "dt"
# Column of a change feed: what a row is the image of.
CHANGE, BEFORE, AFTER = "_change", "before", "after"


def table_exists(spark: SparkSession, path: str) -> bool:
    return exists(spark, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table in the columns of the declared schema; an absent one is empty then."""
    if schema is None:
        return spark.read.parquet(path)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    if not exists(spark, path):
        return spark.createDataFrame([], nullable)
    return spark.read.schema(nullable).parquet(path).select(*nullable.names)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the whole table and read it back, which also cuts the lineage. `df` must not read the same table."""
    writer = df.hint("rebalance", *partition_by) if partition_by else df
    writer.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], touched: Iterable[str] | None = None) -> DataFrame:
    """Overwrite the partitions that `df` has rows of and leave the others; `df` may read the same table.

    With `touched`, values of a single partition column, those of them that no row is left of go. Which ones
    have rows is observed while they are written.
    """
    spark, written = df.sparkSession, Observation()
    rows = df.hint("rebalance", *partition_by)
    if touched is not None:
        rows = rows.observe(written, F.collect_set(F.col(partition_by[0]).cast("string")).alias("values"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    if touched is not None:
        for value in set(map(str, touched)) - set(observed(written, values=())["values"]):
            remove(spark, f"{path}/{partition_by[0]}={value}")
    return read_table(spark, path, df.schema)


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])


def read_entity(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """A raw table with its partition day `dt`."""
    return read_table(spark, path, _with_day(entity.schema))


def merge_table(spark: SparkSession, path: str, source: DataFrame, entity: Entity, feed: str | None = None) -> None:
    """Newest-wins upsert of `source` into the raw table, partitioned by the day of the version.

    The first pass reads only keys and versions and finds the days to rewrite. Days are few, so their
    list may come to the driver; rows never do. Of source rows with a key's same version the one that is
    greatest by its columns counts.

    With `feed`, a folder of this merge alone, the images of all changed rows before and after it are
    written there first, without their nested columns. A merge that is run again after it was done changes
    nothing and leaves the feed as it is.
    """
    keys, version = list(entity.keys), entity.version
    rest = [c for c in entity.columns if c not in (*keys, version)]
    fresh = latest_per_key(source.select(*entity.columns), keys, version, rest)
    # Read several times below; kept on disk, and worked out again where an executor is lost.
    fresh = fresh.withColumn(DAY, F.date_format(version, "yyyy-MM-dd")).persist(StorageLevel.DISK_ONLY)
    try:
        _merge(spark, path, fresh, entity, feed)
    finally:
        fresh.unpersist()


def _merge(spark: SparkSession, path: str, fresh: DataFrame, entity: Entity, feed: str | None) -> None:
    keys, version = list(entity.keys), entity.version
    target = read_entity(spark, path, entity)

    # The batch's keys thin out the target before anything is joined to it; Spark broadcasts few keys.
    found = target.select(*keys, F.col(version).alias("_old"), F.col(DAY).alias("_old_day"))
    found = found.join(fresh.select(*keys), keys, "left_semi")
    # Rows that are not newer than the target change nothing.
    news = fresh.select(*keys, version, DAY).join(found, keys, "left")
    newer = news.where(F.col("_old").isNull() | (F.col(version) > F.col("_old"))).select(*keys, DAY, "_old_day")
    # The keys that count are looked for in the target once and kept for all three passes.
    newer = newer.persist(StorageLevel.DISK_ONLY)
    try:
        _apply(spark, path, fresh, newer, target, entity, feed)
    finally:
        newer.unpersist()


def _apply(spark: SparkSession, path: str, fresh: DataFrame, newer: DataFrame, target: DataFrame, entity: Entity, feed: str | None) -> None:
    keys, version = list(entity.keys), entity.version
    moved = newer.select(F.explode(F.array_compact(F.array(DAY, "_old_day"))).alias(DAY))
    days = [r[0] for r in moved.distinct().collect()]
    flat = [f.name for f in entity.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if not days:
        if feed is not None and not exists(spark, feed):
            fresh.select(*flat, F.lit(AFTER).alias(CHANGE)).where(F.lit(False)).write.parquet(feed)
        return

    touched = target.where(F.col(DAY).isin(days)).drop(DAY)
    # A stale source row must not come in again beside its newer target row on an untouched day.
    applied = fresh.join(newer.select(*keys), keys, "left_semi").drop(DAY)
    if feed is not None:
        before = touched.join(newer.select(*keys), keys, "left_semi").select(*flat, F.lit(BEFORE).alias(CHANGE))
        images = before.unionByName(applied.select(*flat, F.lit(AFTER).alias(CHANGE)))
        images.write.mode("overwrite").parquet(feed)
    merged = upsert_newest(touched, applied, keys, version)
    replace_partitions(merged.withColumn(DAY, F.date_format(version, "yyyy-MM-dd")), path, [DAY], days)
