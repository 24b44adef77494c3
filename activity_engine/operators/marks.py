"""High-water marks, bounded windows, backfill and batch statistics (S-8, W-1 to W-7)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.operators.upsert import upsert_newest
from activity_engine.schemas import SUPPORT


def bound(value: Column | datetime | str | None) -> Column | None:
    """A window bound as an instant; text without an offset is UTC."""
    if value is None or isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def window_scan(
    df: DataFrame,
    version: str,
    since: Column | datetime | str | None = None,
    until: Column | datetime | str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Rows with `since < version <= until`; either bound may be open.

    `day` names a column that holds the version's day as text, such as a partition `dt`: the bounds' own days
    then bound it too, so that the folders of other days are not read.
    """
    lo, hi = bound(since), bound(until)
    if lo is not None:
        df = df.where(F.col(version) > lo)
        df = df if day is None else df.where(F.col(day) >= F.date_format(lo, "yyyy-MM-dd"))
    if hi is not None:
        df = df.where(F.col(version) <= hi)
        df = df if day is None else df.where(F.col(day) <= F.date_format(hi, "yyyy-MM-dd"))
    return df


def backfill_bounds(start: date, end: date) -> tuple[datetime, datetime]:
    """The union of the daily replay windows from `start` to `end`, as one window."""
    midnight = datetime.min.time()
    return datetime.combine(start, midnight), datetime.combine(end + timedelta(days=1), midnight)


def offered(source: Column, entity: Column) -> Column:
    """Whether a source offers an entity (W-5), row by row."""
    found = F.lit(False)
    for name, sources in SUPPORT.items():
        found = found | ((entity == name) & source.isin(*sorted(sources)))
    return F.coalesce(found, F.lit(False))


def read_mark(marks: DataFrame, source: str, entity: str) -> datetime | None:
    """The mark of one source and entity, or None when it has never run."""
    row = marks.where((F.col("source") == source) & (F.col("entity") == entity)).agg(F.max("mark")).first()
    return row[0]


def high_water(df: DataFrame, version: str, by: Sequence[str] = ()) -> DataFrame:
    """Highest version seen; feed it valid and rejected records alike."""
    return df.groupBy(*by).agg(F.max(version).alias("mark"))


def mark_row(spark: SparkSession, source: str, entity: str, mark: datetime | None) -> DataFrame:
    """A mark that a batch was observed to reach, as a table of one row."""
    row = spark.createDataFrame([(source, entity, None if mark is None else mark.isoformat())], "source string, entity string, mark string")
    return row.withColumn("mark", F.col("mark").cast("timestamp"))


def advance_mark(marks: DataFrame, seen: DataFrame) -> DataFrame:
    """Marks after a live run; a mark never moves back, and a run that saw nothing moves none.

    `seen` has the columns source, entity, mark.
    """
    return upsert_newest(marks, seen.where(F.col("mark").isNotNull()), ["source", "entity"], "mark")


def late_rows(df: DataFrame, event_time: str, version: str, days: int = 1) -> DataFrame:
    """Rows that arrived more than `days` after the event. They are reported, never dropped."""
    delay = F.col(version).cast("timestamp") - F.col(event_time).cast("timestamp")
    return df.where(delay > F.expr(f"interval {days} day"))


def batch_stats(rows: DataFrame, keys: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """One row of counts: rows, repeated deliveries of a key, and rows for which each flag holds.

    Counted per key first, with partial sums, so the distinct count needs no second shuffle of the rows.
    """
    known = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        known = known & F.col(k).isNotNull()
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *(F.count_if(c).alias(name) for name, c in flags.items())
    )
    repeats = F.sum(F.when(known, F.col("_n") - 1).otherwise(F.lit(0)))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(repeats, F.lit(0)).alias("duplicate"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags),
    )
