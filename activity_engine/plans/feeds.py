"""Dashboard feeds (D-1 to D-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trend(daily: DataFrame) -> DataFrame:
    """Totals per day over all users."""
    return daily.groupBy("date_day").agg(
        F.sum("workout_count").alias("workouts"),
        F.sum("total_duration_minutes").alias("duration_minutes"),
        F.sum("total_distance_meters").alias("distance_meters"),
    )


def kpis(daily: DataFrame) -> DataFrame:
    """Totals and active days per user."""
    return daily.groupBy("user_id").agg(
        F.sum("workout_count").alias("workouts"),
        F.sum("total_duration_minutes").alias("duration_minutes"),
        F.sum("total_distance_meters").alias("distance_meters"),
        F.sum("total_calories").alias("calories"),
        F.count_if(F.col("workout_count") > 0).alias("active_days"),
    )


def session_mix(workouts: DataFrame) -> DataFrame:
    """Sessions per user and type, and the type's share of the user's sessions."""
    counts = workouts.groupBy("user_id", "workout_type").agg(F.count(F.lit(1)).alias("sessions"))
    total = F.sum("sessions").over(Window.partitionBy("user_id"))
    return counts.withColumn("share", F.col("sessions") / total)


def heart_rate_trend(workouts: DataFrame) -> DataFrame:
    """Mean heart rate per user and day, workouts weighted by their sample count."""
    measured = workouts.where(F.col("avg_heart_rate_bpm").isNotNull())
    weighted = F.sum(F.col("avg_heart_rate_bpm") * F.col("sample_count"))
    return measured.groupBy("user_id", F.to_date("start_time").alias("date_day")).agg(
        F.try_divide(weighted, F.sum("sample_count")).alias("avg_heart_rate_bpm"),
        F.sum("sample_count").alias("sample_count"),
    )


def ingestion_volume(valid: DataFrame, rejects: DataFrame) -> DataFrame:
    """Valid and rejected rows per source and sync day. Both inputs have `source` and `dt`."""
    both = valid.select("source", "dt", F.lit(True).alias("ok")).unionByName(
        rejects.select("source", "dt", F.lit(False).alias("ok"))
    )
    return both.groupBy("source", "dt").agg(
        F.count_if(F.col("ok")).alias("valid"), F.count_if(~F.col("ok")).alias("rejected")
    )
