"""Dimensions (M-1 to M-3, V-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.functions.scalars import OPEN_END, surrogate_key, timestamp_text, week_of_year_sunday
from activity_engine.operators.grid import date_scan

# First day of the calendar, and its runway past today.
SPINE_START = "2024-01-01"
RUNWAY_MONTHS = 12


def calendar(days: DataFrame, today: Column, day: str = "date_day") -> DataFrame:
    """Calendar attributes of a day column."""
    d = F.col(day)
    return days.select(
        surrogate_key(day).alias("date_sk"),
        d,
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        week_of_year_sunday(d).alias("week_of_year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == today).alias("is_today"),
    )


def dim_date(spark: SparkSession, as_of: Column, start: Column | None = None) -> DataFrame:
    """Every day from the start of the calendar to a year past `as_of`."""
    today = as_of.cast("date")
    first = F.lit(SPINE_START).cast("date") if start is None else start
    return calendar(date_scan(spark, first, F.add_months(today, RUNWAY_MONTHS)), today)


def dim_exercise_type(seed: DataFrame) -> DataFrame:
    return seed.select(
        surrogate_key("workout_type").alias("exercise_type_sk"), "workout_type", "category", "is_cardio", "met_value"
    )


def dim_user(snapshot: DataFrame) -> DataFrame:
    """User versions with a far-future end on the open one, so that joins need no NULL case."""
    return snapshot.select(
        surrogate_key("user_id", timestamp_text("valid_from")).alias("user_sk"),
        "user_id",
        "source_system",
        "display_name",
        "email",
        "age",
        "weight_kg",
        "height_cm",
        "fitness_goal",
        "valid_from",
        F.coalesce("valid_to", F.lit(OPEN_END).cast("timestamp")).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )
