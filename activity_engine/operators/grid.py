"""Dense key-by-day grids (S-6, J-5, J-6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def days_between(lo: Column, hi: Column) -> Column:
    """Array of days, both ends included; empty when `lo` is after `hi`, NULL when either is."""
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day"))).when(
        lo > hi, F.array().cast("array<date>")
    )


def date_scan(spark: SparkSession, lo: Column, hi: Column, name: str = "date_day") -> DataFrame:
    return spark.range(1).select(F.explode(days_between(lo, hi)).alias(name))


def key_days(keys: DataFrame, lo: Column, hi: Column, day: str = "date_day") -> DataFrame:
    """Every key row times every day. The days are made in place, so there is no join."""
    return keys.select("*", F.explode(days_between(lo, hi)).alias(day))


def densify(
    facts: DataFrame,
    keys: DataFrame,
    key: str,
    lo: Column,
    hi: Column,
    fill: Mapping[str, object],
    day: str = "date_day",
) -> DataFrame:
    """One row per key and day in [lo, hi]: the fact of that day where there is one, else `fill`.

    `facts` has at most one row per key and day, `keys` one row per key; facts of other keys or days
    drop out. NULL measures are filled too.

    No grid is joined or shuffled. An opening row per key is put before its facts, and each row is
    repeated up to the day before the key's next one. Only active days travel, partitioned by key
    alone, which is also what the per-key windows on the result need.
    """
    attributes = [c for c in keys.columns if c != key]
    opening = keys.select("*", lo.alias(day), F.lit(True).alias("_opening"))
    active = facts.where(F.col(day).between(lo, hi)).select(key, day, *fill, F.lit(False).alias("_opening"))

    in_order = Window.partitionBy(key).orderBy(F.col(day).asc(), F.col("_opening").desc())
    start = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead(day).over(in_order), 1), hi)
    spans = (
        opening.unionByName(active, allowMissingColumns=True)
        .withColumn("_until", until)
        .withColumn("_known", F.first("_opening").over(start))
        .withColumns({a: F.first(a).over(start) for a in attributes})
        .where("_known")
    )
    is_fact = (~F.col("_opening")) & (F.col("_pos") == 0)
    measures = [
        F.coalesce(F.when(is_fact, F.col(c)), F.lit(v)).cast(facts.schema[c].dataType).alias(c)
        for c, v in fill.items()
    ]
    days = days_between(F.col(day), F.col("_until"))
    return spans.select(
        key, *attributes, *fill, "_opening", F.posexplode(days).alias("_pos", "_day")
    ).select(key, *attributes, F.col("_day").alias(day), *measures)
