"""Facts (M-4, M-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.functions.nested import sample_stats
from activity_engine.functions.scalars import surrogate_key
from activity_engine.operators.asof import asof_validity_join, is_small
from activity_engine.operators.grid import densify
from activity_engine.operators.hot import HOT_ROWS
from activity_engine.operators.rolling import days_since_active, period_over_period, rolling_avg
from activity_engine.operators.scd2 import current_versions
from activity_engine.plans.dims import SPINE_START

FACT_WORKOUT = [
    "workout_sk",
    "workout_id",
    "user_id",
    "user_sk",
    "exercise_type_sk",
    "workout_date_sk",
    "workout_type",
    "source_system",
    "start_time",
    "end_time",
    "duration_minutes",
    "device_id",
    "distance_meters",
    "calories",
    "avg_heart_rate_bpm",
    "max_heart_rate_bpm",
    "min_heart_rate_bpm",
    "sample_count",
    "samples",
]


def fact_workout(
    workouts: DataFrame,
    dim_user: DataFrame,
    dim_exercise_type: DataFrame,
    dim_date: DataFrame,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = 0,
) -> DataFrame:
    """One row per workout, with the user version that held when it started; `workout_id` is unique.

    Heart-rate measures come from the nested samples in place. The samples are nearly all of the bytes,
    so they stay out of the as-of join: it runs on three narrow columns and is joined back on
    `workout_id`, by which staging has the workouts partitioned and sorted already. When the user
    dimension proves small it is broadcast instead and nothing moves.
    """
    measured = workouts.withColumns(sample_stats("samples"))
    versions = dim_user.select("user_id", "user_sk", "valid_from", "valid_to")
    if broadcast_rows and is_small(versions, ["user_id"], broadcast_rows):
        with_user = asof_validity_join(
            measured, versions, ["user_id"], "start_time", hot_rows=hot_rows, broadcast_rows=broadcast_rows
        )
    else:
        moments = workouts.select("workout_id", "user_id", "start_time")
        linked = asof_validity_join(moments, versions, ["user_id"], "start_time", hot_rows=hot_rows)
        with_user = measured.join(linked.select("workout_id", "user_sk"), "workout_id", "left")
    types = dim_exercise_type.select("workout_type", "exercise_type_sk")
    days = dim_date.select(F.col("date_day").alias("_day"), F.col("date_sk").alias("workout_date_sk"))
    return (
        with_user.withColumn("_day", F.to_date("start_time"))
        .join(types, "workout_type", "left")
        .join(days, "_day", "left")
        .withColumn("workout_sk", surrogate_key("workout_id"))
        .select(*FACT_WORKOUT)
    )


def daily_activity(workouts: DataFrame, day: str = "date_day") -> DataFrame:
    """Count and totals per user and active day."""
    return workouts.groupBy("user_id", F.to_date("start_time").alias(day)).agg(
        F.count(F.lit(1)).alias("workout_count"),
        F.sum("duration_minutes").alias("total_duration_minutes"),
        F.sum("distance_meters").alias("total_distance_meters"),
        F.sum("calories").alias("total_calories"),
    )


def fact_daily_metrics(
    workouts: DataFrame, dim_user: DataFrame, as_of: Column, first_day: Column | None = None
) -> DataFrame:
    """One row per current user and calendar day up to `as_of`, idle days included.

    The calendar begins on the first day with a workout, but not before the date dimension does.
    """
    if first_day is None:
        first_day = workouts.select(F.min(F.to_date("start_time"))).scalar()
    lo = F.greatest(first_day, F.lit(SPINE_START).cast("date"))
    users = current_versions(dim_user).select("user_id", "user_sk")
    fill = {
        "workout_count": 0,
        "total_duration_minutes": 0,
        "total_distance_meters": 0.0,
        "total_calories": 0.0,
    }
    dense = densify(daily_activity(workouts), users, "user_id", lo, as_of.cast("date"), fill)
    minutes, day = "total_duration_minutes", "date_day"
    return dense.select(
        surrogate_key("user_id", day).alias("daily_metric_sk"),
        "user_id",
        "user_sk",
        day,
        *fill,
        rolling_avg(minutes, "user_id", day).alias("rolling_7d_avg_duration_minutes"),
        period_over_period(minutes, "user_id", day).alias("week_over_week_duration_pct_change"),
        days_since_active("workout_count", "user_id", day).alias("days_since_previous_workout"),
    )
