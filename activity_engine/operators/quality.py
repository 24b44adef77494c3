"""Data-quality checks (Q-1 to Q-7). Each gives a DataFrame; only `gate` runs a job and raises."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.functions.scalars import hours_between

STALE_HOURS = 48
MIN_RATIO = 0.5
MIN_TRAILING_DAYS = 3
LOOKBACK_DAYS = 8


@dataclass(frozen=True)
class TableChecks:
    """Declared tests of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    # column -> (parent table, parent column)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # column -> highest allowed value
    at_most: Mapping[str, float] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.relationships) + len(self.at_most)


def _result(name: Column | str, column: Column, test: Column, failing: Column) -> list[Column]:
    table = F.lit(name) if isinstance(name, str) else name
    return [table.alias("table"), column.alias("column"), test.alias("test"), failing.alias("failing_rows")]


def check_rows(df: DataFrame, table: str, not_null: Sequence[str], at_most: Mapping[str, float]) -> DataFrame:
    """All row-local tests of a table in one aggregation pass."""
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("at_most", c, F.col(c) > F.lit(limit)) for c, limit in at_most.items()]
    counts = df.agg(*(F.count_if(failed).alias(f"_{i}") for i, (_, _, failed) in enumerate(tests)))
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.lit(test).alias("test"), F.col(f"_{i}").alias("n"))
            for i, (test, c, _) in enumerate(tests)
        )
    )
    r = counts.select(F.explode(rows).alias("r"))
    return r.select(*_result(table, F.col("r.column"), F.col("r.test"), F.col("r.n")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once; a NULL key is not a value."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    failing = duplicate_keys(df, [column]).agg(F.count(F.lit(1)).alias("n"))
    return failing.select(*_result(table, F.lit(column), F.lit("unique"), F.col("n")))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign keys without a parent and how many rows hold each; NULL keys pass.

    Child rows are counted per key first, so a key held by very many rows travels once per task.
    """
    child = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_column).alias(column))
    return child.join(keys, column, "left_anti")


def check_relationship(df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    failing = orphans(df, column, parent, parent_column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return failing.select(*_result(table, F.lit(column), F.lit("relationships"), F.col("n")))


def check_keys(
    df: DataFrame, table: str, unique: Sequence[str], parents: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """All unique and relationship tests of a table in one pass.

    Every tested value becomes a (column, value) pair; pairs are counted before the shuffle, and the keys
    of all parents are joined to the counts at once. NULL is no value and passes.
    """
    columns = list(dict.fromkeys([*unique, *parents]))
    named = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = df.select(F.explode(F.array(*named)).alias("p")).select("p.*").where("value is not null")
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = [
        parent.select(F.lit(c).alias("column"), F.col(key).cast("string").alias("value")).distinct()
        for c, (parent, key) in parents.items()
    ]
    if known:
        counts = counts.join(reduce(DataFrame.unionByName, known).withColumn("known", F.lit(True)), ["column", "value"], "left")
    else:
        counts = counts.withColumn("known", F.lit(None).cast("boolean"))
    failing = counts.groupBy("column").agg(
        F.count_if(F.col("n") > 1).alias("unique"), F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("relationships")
    )
    tests = [F.struct(F.lit(c).alias("column"), F.lit("unique").alias("test")) for c in unique]
    tests += [F.struct(F.lit(c).alias("column"), F.lit("relationships").alias("test")) for c in parents]
    wanted = df.sparkSession.range(1).select(F.inline(F.array(*tests)))
    found = F.when(F.col("test") == "unique", F.col("unique")).otherwise(F.col("relationships"))
    return wanted.join(failing, "column", "left").select(
        *_result(table, F.col("column"), F.col("test"), F.coalesce(found, F.lit(0)))
    )


def run_checks(tables: Mapping[str, DataFrame], spec: Mapping[str, TableChecks]) -> DataFrame:
    """`table, column, test, failing_rows, passed`, one row per declared test of the given tables."""
    parts: list[DataFrame] = []
    for name, checks in spec.items():
        if name not in tables:
            continue
        df = tables[name]
        if checks.not_null or checks.at_most:
            parts.append(check_rows(df, name, checks.not_null, checks.at_most))
        parents = {c: (tables[p], key) for c, (p, key) in checks.relationships.items() if p in tables}
        if checks.unique or parents:
            parts.append(check_keys(df, name, checks.unique, parents))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failing_rows") == 0)


def check_max(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows above the limit; the limit itself and NULL pass."""
    return df.where(F.col(column) > F.lit(limit))


def duration_under_hours(df: DataFrame, column: str, max_hours: int = 24) -> DataFrame:
    """Rows whose minutes exceed `max_hours`."""
    return check_max(df, column, max_hours * 60)


def business_anomalies(
    df: DataFrame, start: str = "start_time", end: str = "end_time", distance: str = "distance_meters"
) -> DataFrame:
    """Valid rows that no workout can have: longer than a day, or a negative distance."""
    length = F.col(end).cast("timestamp") - F.col(start).cast("timestamp")
    too_long = length > F.expr("interval 24 hour")
    negative = F.col(distance) < 0
    reason = F.array_compact(
        F.array(F.when(too_long, F.lit("long_duration")), F.when(negative, F.lit("negative_distance")))
    )
    return df.where(too_long | negative).withColumn("reason", F.array_join(reason, ","))


def table_freshness(
    df: DataFrame, table: str, loaded_at: str, as_of: Column, warn_hours: int | None, error_hours: int | None
) -> DataFrame:
    """One row: newest load, its age in hours and `pass`, `warn` or `error`."""
    newest = df.agg(F.max(loaded_at).cast("timestamp").alias("newest"))
    now = as_of.cast("timestamp")
    age = now - F.col("newest")
    status = F.lit("pass")
    if warn_hours is not None:
        status = F.when(age > F.make_dt_interval(hours=F.lit(warn_hours)), F.lit("warn")).otherwise(status)
    if error_hours is not None:
        status = F.when(age > F.make_dt_interval(hours=F.lit(error_hours)), F.lit("error")).otherwise(status)
    return newest.select(
        F.lit(table).alias("table"),
        "newest",
        hours_between("newest", now).alias("age_hours"),
        F.when(F.col("newest").isNull(), F.lit("error")).otherwise(status).alias("status"),
    )


def stale_keys(df: DataFrame, key: str, version: str, as_of: Column, hours: int = STALE_HOURS) -> DataFrame:
    """Keys whose last sync is more than `hours` whole hours ago, most stale first when shown."""
    last = df.groupBy(key).agg(F.max(version).cast("timestamp").alias("last_synced_at"))
    age = hours_between("last_synced_at", as_of.cast("timestamp"))
    return last.withColumn("hours_since_sync", age).where(F.col("hours_since_sync") > hours)


def volume_anomaly(
    df: DataFrame,
    version: str,
    as_of: Column,
    min_ratio: float = MIN_RATIO,
    min_days: int = MIN_TRAILING_DAYS,
    lookback: int = LOOKBACK_DAYS,
    dense: bool = False,
) -> DataFrame:
    """One row if the newest day has fewer rows than `min_ratio` of the trailing mean, else none.

    The newest day is the latest one present and the mean is over the other days present. With `dense`
    it is `as_of` and the mean is over all days of the window, so that an outage counts as zero.
    """
    today = as_of.cast("date")
    day = F.to_date(version)
    per_day = (
        df.select(day.alias("day"))
        .where(F.col("day").between(F.date_sub(today, lookback), today))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if dense:
        head = F.coalesce(F.sum(F.when(F.col("day") == today, F.col("n"))), F.lit(0))
        summary = per_day.agg(
            today.alias("date"), head.alias("today_count"), F.sum("n").alias("_sum"), F.lit(lookback + 1).alias("_days")
        )
    else:
        summary = per_day.agg(
            F.max("day").alias("date"),
            F.max_by("n", "day").alias("today_count"),
            F.sum("n").alias("_sum"),
            F.count(F.lit(1)).alias("_days"),
        )
    trailing = F.col("_days") - 1
    mean = F.try_divide(F.col("_sum") - F.col("today_count"), trailing)
    ratio = F.try_divide(F.col("today_count"), mean)
    return summary.where((trailing >= min_days) & (ratio < min_ratio)).select(
        "date",
        F.col("today_count").cast("bigint").alias("today_count"),
        F.bround(mean, 1).alias("trailing_avg"),
        trailing.cast("bigint").alias("trailing_days"),
        F.bround(ratio, 3).alias("ratio"),
    )


def asymmetric_edges(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges whose reverse is missing, and self edges, with the reason."""
    pairs = edges.select(a, b).distinct()
    reverse = pairs.select(F.col(b).alias(a), F.col(a).alias(b))
    one_way = pairs.join(reverse, [a, b], "left_anti").withColumn("problem", F.lit("no_reverse"))
    selfish = pairs.where(F.col(a) == F.col(b)).withColumn("problem", F.lit("self_edge"))
    return one_way.unionByName(selfish)


class ChecksFailed(RuntimeError):
    """Data failed a check. Running again does not help, so it must not be retried."""


def gate(failures: DataFrame, what: str, show: int = 20) -> None:
    """Raise when there is any failing row; a few are put in the message."""
    rows = failures.take(show)
    if rows:
        listed = "; ".join(str(r.asDict()) for r in rows)
        raise ChecksFailed(f"{what}: {listed}")


def gate_all(checks: Iterable[tuple[str, DataFrame]]) -> None:
    for what, failures in checks:
        gate(failures, what)
