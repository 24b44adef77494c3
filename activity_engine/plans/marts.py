"""Marts (M-6, M-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.functions.scalars import or_zero
from activity_engine.operators.hot import HOT_ROWS
from activity_engine.operators.ranking import best_per_group, rank_desc
from activity_engine.operators.scd2 import current_versions

WEEK_DAYS = 7


def weekly_metrics(daily: DataFrame, as_of: Column, days: int = WEEK_DAYS) -> DataFrame:
    """Totals per user over the trailing days, today included."""
    today = as_of.cast("date")
    recent = daily.where(F.col("date_day").between(F.date_sub(today, days - 1), today))
    return recent.groupBy("user_id").agg(
        F.sum("total_distance_meters").alias("distance_7d"), F.sum("workout_count").alias("workouts_7d")
    )


def leaderboard(
    friendships: DataFrame, dim_user: DataFrame, daily: DataFrame, as_of: Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each user's friends and themself, ranked by distance over the last week.

    Names and totals, one row per member, are joined first, so the edges are joined only once.
    """
    users = current_versions(dim_user)
    totals = weekly_metrics(daily, as_of)
    members = (
        users.select("user_id", "display_name")
        .join(totals, "user_id", "left")
        .select(
            F.col("user_id").alias("member_user_id"),
            F.col("display_name").alias("member_name"),
            or_zero("distance_7d").alias("distance_7d"),
            or_zero("workouts_7d").alias("workouts_7d"),
        )
    )
    friends = friendships.select("user_id", F.col("friend_user_id").alias("member_user_id"))
    themselves = users.select("user_id", F.col("user_id").alias("member_user_id"))
    edges = friends.unionByName(themselves)
    groups = edges.join(members, "member_user_id", "inner")
    return rank_desc(
        groups.select("user_id", "member_user_id", "member_name", "distance_7d", "workouts_7d"),
        ["user_id"],
        "distance_7d",
        "rank_by_distance",
        hot_rows,
        sized_by=edges,
    )


def personal_records(workouts: DataFrame) -> DataFrame:
    """All-time bests per user and workout type; a pace needs a positive distance."""
    kilometres = F.col("distance_meters") / F.lit(1000.0)
    pace = F.when(F.col("distance_meters") > 0, F.col("duration_minutes") / kilometres)
    return best_per_group(
        workouts,
        ["user_id", "workout_type"],
        {
            "best_distance_meters": "distance_meters",
            "longest_duration_minutes": "duration_minutes",
            "most_calories_burned": "calories",
        },
        {"best_pace_min_per_km": pace},
    )
