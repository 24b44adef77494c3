"""Models kept up from one batch to the next, instead of built anew (M-5, M-7 over A-1, A-3).

A merge writes a feed of the rows it changed. From it follow the user days whose totals change; they are
logged as partial aggregates (`operators.partials`). The dense user-by-day fact changes on these days, on the
thirteen after each (the widest window), on the user's next active day (its gap), and where the calendar or
the users change; only these rows are worked out, from the totals of the days they look at, and only the
months that hold one are rewritten. Records of a user and type are raised by what a batch brings, or
worked out again from their days where the batch corrected something.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.functions.scalars import minutes_between, or_zero, ratio_change, surrogate_key
from activity_engine.operators.partials import BASE, COUNT, LOST, RUN, Partials, among
from activity_engine.operators.scd2 import current_versions
from activity_engine.plans.dims import SPINE_START
from activity_engine.schemas import ENTITIES
from activity_engine.sources.files import list_names, remove
from activity_engine.sources.tables import CHANGE, read_table, replace_partitions, replace_table, table_exists

WINDOW_DAYS = 7
RECORD_BUCKETS = 32

#: Everything the daily fact and the records need of a user's workouts of one type on one day.
DAY_TOTALS = Partials(
    keys=("user_id", "workout_type", "date_day"),
    sums={"total_duration_minutes": "duration_minutes", "total_distance_meters": "distance_meters", "total_calories": "calories"},
    maxima={"best_distance_meters": "distance_meters", "longest_duration_minutes": "duration_minutes", "most_calories_burned": "calories"},
    minima={"best_pace_min_per_km": "case when distance_meters > 0 then duration_minutes / (distance_meters / 1000.0D) end"},
)
RECORDS = [*DAY_TOTALS.maxima, *DAY_TOTALS.minima]
_METRIC_TYPES = {
    "user_id": T.StringType(), "date_day": T.DateType(), "workout_count": T.LongType(), "total_duration_minutes": T.LongType(),
    "total_distance_meters": T.DoubleType(), "total_calories": T.DoubleType(), "rolling_7d_avg_duration_minutes": T.DoubleType(),
    "week_over_week_duration_pct_change": T.DoubleType(), "days_since_previous_workout": T.LongType(), "month": T.StringType(),
}
METRICS_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in _METRIC_TYPES.items()])
# Which folders of the feed a run takes in.
_BEGUN = T.StructType([T.StructField(RUN, T.LongType()), T.StructField("name", T.StringType())])
METRICS = METRICS_SCHEMA.names[:-1]


def workout_days(workouts: DataFrame) -> DataFrame:
    """Typed workouts, or images of raw ones, with the day and the whole minutes that the totals use."""
    rows = workouts.withColumn("date_day", F.to_date("start_time"))
    if "duration_minutes" in workouts.columns:
        return rows
    return rows.withColumn("duration_minutes", minutes_between(F.col("start_time"), F.col("end_time")))


def totals_by_day(log: DataFrame) -> DataFrame:
    """Totals per user and active day, in the names of the daily fact.

    The log is dealt out by user, whose rows are bounded by days, types and runs; nothing is moved after that.
    """
    days = DAY_TOTALS.state(log.repartition("user_id"), ("user_id", "date_day"))
    return days.select("user_id", "date_day", F.col(COUNT).alias("workout_count"), *DAY_TOTALS.sums)


def affected_days(touched: DataFrame, totals: DataFrame, last: Column) -> DataFrame:
    """(user_id, date_day): the days whose metrics look at a touched (user_id, date_day), up to `last`.

    Every window ends on its own day, so these are the touched day, the days up to the end of the widest
    window, and the next active day, whose gap counts from a touched day or used to.
    """
    days = touched.where(F.col("user_id").isNotNull() & F.col("date_day").isNotNull()).select("user_id", "date_day").distinct()
    of_user = Window.partitionBy("user_id").orderBy(F.col("date_day").desc(), F.col("_touched").desc()).rowsBetween(Window.unboundedPreceding, -1)
    active = totals.join(days.select("user_id").distinct(), "user_id", "left_semi")
    both = active.select("user_id", "date_day", F.lit(False).alias("_touched")).unionByName(days.withColumn("_touched", F.lit(True)))
    # Going back in time, the last active day seen before a touched day is the next one after it.
    following = F.last(F.when(~F.col("_touched"), F.col("date_day")), ignorenulls=True).over(of_user)
    ahead = F.sequence("date_day", F.least(F.date_add("date_day", 2 * WINDOW_DAYS - 1), F.greatest(last, "date_day")))
    # All days of a user are made where its rows already are, so telling them apart moves nothing.
    looking = both.withColumn("_next", following).where("_touched").select("user_id", F.explode(F.array_append(ahead, F.col("_next"))).alias("date_day"))
    return looking.where(F.col("date_day") <= last).distinct()


def metric_rows(days: DataFrame, totals: DataFrame, first: Column) -> DataFrame:
    """The daily fact's rows of the given (user_id, date_day), without the user's version.

    Each asked day looks back over the active days of its windows, so nothing is made dense, and rows move once, by
    user. `first` is the first day of the calendar.
    """
    known = among(totals, days.select("user_id").distinct(), ["user_id"]).where(F.col("date_day") >= first)
    asked = days.select("user_id", "date_day", F.lit(True).alias("_asked"))
    rows = known.unionByName(asked, allowMissingColumns=True).repartition("user_id")
    rows = rows.groupBy("user_id", "date_day").agg(F.max("_asked").alias("_asked"), *(F.max(c).alias(f"_{c}") for c in METRICS[2:6]))
    in_time = Window.partitionBy("user_id").orderBy(F.unix_date("date_day"))
    minutes = F.sum("_total_duration_minutes")
    earlier = F.last(F.when(F.col("_workout_count").isNotNull(), F.col("date_day")), ignorenulls=True)
    rows = rows.select(
        "user_id", "date_day", "_asked",
        *(or_zero(F.col(f"_{c}")).alias(c) for c in METRICS[2:6]),
        or_zero(minutes.over(in_time.rangeBetween(1 - WINDOW_DAYS, 0))).alias("_week"),
        or_zero(minutes.over(in_time.rangeBetween(1 - 2 * WINDOW_DAYS, -WINDOW_DAYS))).alias("_before"),
        earlier.over(in_time.rowsBetween(Window.unboundedPreceding, -1)).alias("_previous"),
    )
    width = F.least(F.lit(WINDOW_DAYS), F.date_diff(F.col("date_day"), first) + 1)
    return rows.where("_asked").select(
        *METRICS[:6],
        (F.col("_week") / width).alias("rolling_7d_avg_duration_minutes"),
        ratio_change(F.col("_week"), F.col("_before")).alias("week_over_week_duration_pct_change"),
        F.when(F.col("workout_count") > 0, F.date_diff("date_day", "_previous").cast("bigint")).alias("days_since_previous_workout"),
    )


class DailyModels:
    """The log of day totals, the daily fact and the records under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.log_path, self.metrics_path = f"{root}/day_totals", f"{root}/metrics"
        self.records_path, self.calendar_path = f"{root}/records", f"{root}/calendar"

    def log(self) -> DataFrame:
        return self.spark.read.parquet(self.log_path).withColumn(RUN, F.col(RUN).cast("bigint"))

    def runs(self) -> list[int]:
        return sorted(int(n.removeprefix(f"{RUN}=")) for n in list_names(self.spark, self.log_path) if n.startswith(f"{RUN}="))

    def refresh(self, workouts: DataFrame, users: DataFrame, as_of: datetime, run: int, changes: DataFrame | None = None) -> list[str]:
        """Take one batch in and return the months of the daily fact that were rewritten.

        `workouts` are the typed workouts as they are now, `users` one row per current user, `changes` the
        feed of the batch; without it, and the first time, everything counts as new. Batches are numbered
        upwards; the same batch again gives the same tables.
        """
        touched = self.log_batch(workouts, run, changes)
        months = self.refresh_metrics(users, as_of, touched)
        self.refresh_records(touched)
        if touched is not None:
            touched.unpersist()
        return months

    def log_batch(self, workouts: DataFrame, run: int, changes: DataFrame | None = None) -> DataFrame | None:
        """Log a batch's partial rows; the groups it touched, with the number of rows each lost, or None for all."""
        rows = workout_days(workouts)
        new = not self.runs()
        if new or changes is None:
            delta, touched = DAY_TOTALS.of(rows).withColumn(BASE, F.lit(True)), None
        else:
            touched = DAY_TOTALS.changed(workout_days(changes)).persist()
            delta = DAY_TOTALS.delta_of(touched, rows)
        if touched is None and not new:
            # All groups anew: those that are gone need an empty base row.
            gone = among(DAY_TOTALS.state(self.log().where(F.col(RUN) < run)), delta, DAY_TOTALS.keys, "left_anti")
            gone = gone.withColumns({m: F.lit(0 if m == COUNT else None).cast(dict(gone.dtypes)[m]) for m in DAY_TOTALS.measures})
            delta = delta.unionByName(gone.withColumn(BASE, F.lit(True)))
        replace_partitions(delta.withColumn(RUN, F.lit(run)), self.log_path, [RUN])
        return touched

    def compact(self) -> None:
        """Log all groups as base rows of the last run, in place of its own rows, and let the earlier runs go."""
        before = self.runs()
        state = DAY_TOTALS.state(self.log()).withColumn(BASE, F.lit(True)).withColumn(RUN, F.lit(before[-1]))
        replace_partitions(state, self.log_path, [RUN])
        for run in before[:-1]:
            remove(self.spark, f"{self.log_path}/{RUN}={run}")

    def _calendar(self) -> tuple | None:
        rows = self.spark.read.parquet(self.calendar_path).collect() if table_exists(self.spark, self.calendar_path) else []
        return (rows[0].first_day, rows[0].last_day) if rows else None

    def refresh_metrics(self, users: DataFrame, as_of: datetime, touched: DataFrame | None) -> list[str]:
        """Work out the rows of the daily fact that a batch changed and rewrite their months, which are returned."""
        known = table_exists(self.spark, self.metrics_path)
        # Looked at for the calendar, the affected days and their metrics; the log is summed up once.
        totals = totals_by_day(self.log()).persist()
        try:
            return self._refresh_metrics(users, as_of, touched, totals, known)
        finally:
            totals.unpersist()

    def _refresh_metrics(self, users: DataFrame, as_of: datetime, touched: DataFrame | None, totals: DataFrame, known: bool) -> list[str]:
        spark, last_day = self.spark, as_of.date()
        first_day = totals.agg(F.greatest(F.min("date_day"), F.lit(SPINE_START).cast("date"))).first()[0]
        if first_day is None:
            return []
        first, last = F.lit(first_day), F.lit(last_day)
        members = users.select("user_id").distinct()
        calendar = self._calendar()
        every = lambda of, lo, hi: of.select("user_id", F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias("date_day"))
        if not known or calendar is None or touched is None:
            days = every(members, first, last)
        else:
            old_first, old_last = calendar
            days = affected_days(touched.select("user_id", "date_day").join(members, "user_id", "left_semi"), totals, last)
            stored = read_table(spark, self.metrics_path, METRICS_SCHEMA).select("user_id").distinct()
            days = days.unionByName(every(members.join(stored, "user_id", "left_anti"), first, last))
            if last_day > old_last:
                days = days.unionByName(every(members, F.date_add(F.lit(old_last), 1), last))
            if first_day != old_first:
                # The calendar begins elsewhere: windows of its first days have another width.
                edge = F.date_add(F.greatest(first, F.lit(old_first)), 2 * WINDOW_DAYS - 1)
                days = days.unionByName(every(members, F.least(first, F.lit(old_first)), F.least(edge, last)))
            days = days.distinct()
        month = F.date_format("date_day", "yyyy-MM")
        days = days.withColumn("month", month).persist()
        months = sorted(r[0] for r in days.select("month").distinct().collect())  # a dozen for each year
        fresh = metric_rows(days.where(F.col("date_day").between(first, last)).drop("month"), totals, first).withColumn("month", month)
        if known:
            stored = read_table(spark, self.metrics_path, METRICS_SCHEMA).where(F.col("month").isin(months))
            fresh = fresh.unionByName(stored.join(days.drop("month"), ["user_id", "date_day"], "left_anti").select(*fresh.columns))
        if months:
            replace_partitions(fresh, self.metrics_path, ["month"], months)
        days.unpersist()
        replace_table(spark.createDataFrame([(first_day, last_day)], "first_day date, last_day date"), self.calendar_path)
        return months

    def refresh_records(self, touched: DataFrame | None) -> None:
        """Raise the records of the groups a batch touched, or work them out again where it corrected one."""
        keys = ["user_id", "workout_type"]
        log = self.log()
        bucket = F.pmod(F.xxhash64(*keys), F.lit(RECORD_BUCKETS)).cast("int")
        if touched is None or not table_exists(self.spark, self.records_path):
            best = DAY_TOTALS.state(log, keys).select(*keys, *RECORDS)
            replace_table(best.withColumn("bucket", bucket), self.records_path, ["bucket"])
            return
        stored = self.spark.read.parquet(self.records_path)
        corrected = touched.where(F.col(LOST) > 0).select(*keys).distinct()
        grown = among(touched.select(*DAY_TOTALS.keys), corrected, keys, "left_anti")
        # Raised by the days a batch brought, or, where it corrected one, worked out from all their days.
        brought = DAY_TOTALS.state(among(log, grown, DAY_TOTALS.keys)).select(*keys, *RECORDS)
        redone = DAY_TOTALS.state(among(log, corrected, keys), keys).select(*keys, *RECORDS)
        raised = among(stored, corrected, keys, "left_anti").select(*keys, *RECORDS).unionByName(brought).groupBy(*keys)
        raised = raised.agg(*(F.max(c).alias(c) for c in DAY_TOTALS.maxima), *(F.min(c).alias(c) for c in DAY_TOTALS.minima))
        buckets = [r[0] for r in touched.select(bucket.alias("b")).distinct().collect()]  # RECORD_BUCKETS at most
        after = raised.unionByName(redone).withColumn("bucket", bucket).where(F.col("bucket").isin(buckets))
        replace_partitions(after, self.records_path, ["bucket"], map(str, buckets))

    def daily_metrics(self, dim_user: DataFrame, since: date | None = None) -> DataFrame:
        """The daily fact with its keys; the user's version is looked up here, so a new one rewrites no day.

        With `since` only the days from then on, and only their months are read.
        """
        users = current_versions(dim_user).select("user_id", "user_sk")
        stored = read_table(self.spark, self.metrics_path, METRICS_SCHEMA)
        if since is not None:
            stored = stored.where((F.col("month") >= f"{since:%Y-%m}") & (F.col("date_day") >= F.lit(since)))
        stored = stored.select(*METRICS)
        sk = surrogate_key("user_id", "date_day").alias("daily_metric_sk")
        return stored.join(users, "user_id").select(sk, "user_id", "user_sk", *METRICS[1:])

    def consume(self, feed: str, workouts: DataFrame, users: DataFrame, as_of: datetime) -> list[str]:
        """Take in what merges have left in the feed since the last time.

        Which folders of the feed belong to a run is written down before the run begins, and that it ended
        after it, so a run that broke off is done again with the same folders under the same number.
        """
        spark, begun, ended = self.spark, f"{self.root}/begun", f"{self.root}/ended"
        recorded = [tuple(r) for r in read_table(spark, begun, _BEGUN).collect()]  # names of folders, a few a run
        done = {int(n.removeprefix(f"{RUN}=")) for n in list_names(spark, ended)}
        run = max((r for r, _ in recorded), default=-1)
        if run < 0 or run in done:
            run += 1
            names = sorted(set(list_names(spark, feed)) - {n for _, n in recorded})
            rows = spark.createDataFrame([(run, n) for n in names or [""]], _BEGUN)
            replace_partitions(rows, begun, [RUN])
        else:
            names = sorted(n for r, n in recorded if r == run and n)
        changes = None
        if self.runs() and self.runs() != [run]:
            paths = [f"{feed}/{n}" for n in names if n]
            flat = T.StructType([f for f in ENTITIES["workouts"].schema.fields if not isinstance(f.dataType, T.ArrayType)] + [T.StructField(CHANGE, T.StringType())])
            changes = spark.read.parquet(*paths) if paths else spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in flat.fields]))
        months = self.refresh(workouts, users, as_of, run, changes)
        spark.range(1).write.mode("overwrite").parquet(f"{ended}/{RUN}={run}")
        for name in filter(None, names):
            remove(spark, f"{feed}/{name}")
        return months

    def personal_records(self) -> DataFrame:
        return read_table(self.spark, self.records_path).select("user_id", "workout_type", *RECORDS)
