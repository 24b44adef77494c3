"""Per-key metrics over calendar days (X-3 to X-8).

All builders take the same key and day, so Spark plans one exchange and one sort for all of them.
Frames are ranges over the day number: sparse input gives right results too. Input is one row per
key and day, so a partition is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from activity_engine.functions.scalars import ratio_change


def by_day(key: str, day: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(F.unix_date(F.col(day)))


def rolling_avg(measure: str, key: str, day: str, days: int = 7) -> Column:
    return F.avg(measure).over(by_day(key, day).rangeBetween(1 - days, 0))


def period_over_period(measure: str, key: str, day: str, days: int = 7) -> Column:
    """Change of the last `days` days against the `days` before, as a fraction.

    NULL when there is no earlier day or its total is zero.
    """
    total = F.sum(measure)
    this = total.over(by_day(key, day).rangeBetween(1 - days, 0))
    before = total.over(by_day(key, day).rangeBetween(1 - 2 * days, -days))
    return ratio_change(this, before)


def days_since_active(count: str, key: str, day: str) -> Column:
    """On an active day, days since the previous active one; else NULL."""
    active = F.col(count) > 0
    earlier = by_day(key, day).rowsBetween(Window.unboundedPreceding, -1)
    previous = F.max(F.when(active, F.col(day))).over(earlier)
    return F.when(active, F.date_diff(F.col(day), previous).cast("bigint"))


def sparse_rolling_sums(facts: DataFrame, key: str, day: str, sums: Mapping[str, str], days: int = 7) -> DataFrame:
    """(key, from_day, to_day, sums): the sums over the trailing `days` days, as far as any is active.

    Without a dense grid: a total changes when an active day comes in and when it leaves `days` days later,
    so there is a row for each such day, which holds up to the day before the next one; stretches without an
    active day in the window have no row. `facts` has at most one row per key and day. The frame adds the
    days anew instead of taking out what left, so fractions do not drift.
    """
    measures = {name: F.col(column) for name, column in sums.items()}
    comes = facts.select(key, F.col(day).alias("from_day"), *(c.alias(name) for name, c in measures.items()), F.lit(1).alias("_active"))
    leaves = facts.select(key, F.date_add(day, days).alias("from_day"))
    steps = comes.unionByName(leaves, allowMissingColumns=True).groupBy(key, "from_day")
    steps = steps.agg(*(F.sum(name).alias(name) for name in sums), F.sum("_active").alias("_active"))
    window = by_day(key, "from_day").rangeBetween(1 - days, 0)
    until = F.date_sub(F.lead("from_day").over(by_day(key, "from_day")), 1)
    rows = steps.withColumns({"to_day": until, "_active": F.sum("_active").over(window), **{name: F.sum(name).over(window) for name in sums}})
    return rows.where(F.col("_active") > 0).select(key, "from_day", "to_day", *sums)


def rolling_at(rolling: DataFrame, day: Column) -> DataFrame:
    """The rows of `sparse_rolling_sums` that hold on a day: one per key with an active day in its window."""
    return rolling.where((F.col("from_day") <= day) & (F.col("to_day") >= day)).drop("from_day", "to_day")
