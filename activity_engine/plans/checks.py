"""The declared tests (Q-1) and source freshness limits (Q-2) of the concrete tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from activity_engine.operators.quality import TableChecks, table_freshness

# Which column must satisfy which test.
DECLARED = {
    "raw_workouts": TableChecks(not_null=["workout_id", "user_id", "synced_at"]),
    "raw_users": TableChecks(not_null=["user_id", "updated_at"]),
    "raw_friendships": TableChecks(not_null=["user_id", "friend_user_id"]),
    "stg_workouts": TableChecks(not_null=["workout_id", "user_id", "start_time", "end_time"], unique=["workout_id"]),
    "stg_users": TableChecks(not_null=["user_id", "source_system", "updated_at"]),
    "stg_friendships": TableChecks(not_null=["user_id", "friend_user_id"]),
    "dim_user": TableChecks(not_null=["user_sk", "user_id", "valid_from", "valid_to"], unique=["user_sk"]),
    "dim_date": TableChecks(not_null=["date_sk", "date_day"], unique=["date_sk", "date_day"]),
    "dim_exercise_type": TableChecks(
        not_null=["exercise_type_sk", "workout_type"], unique=["exercise_type_sk", "workout_type"]
    ),
    "fact_workout": TableChecks(
        not_null=["workout_sk", "workout_id", "user_id", "duration_minutes"],
        unique=["workout_sk", "workout_id"],
        relationships={
            "user_sk": ("dim_user", "user_sk"),
            "exercise_type_sk": ("dim_exercise_type", "exercise_type_sk"),
            "workout_date_sk": ("dim_date", "date_sk"),
        },
        at_most={"duration_minutes": 24 * 60},
    ),
    "leaderboard": TableChecks(not_null=["user_id", "member_user_id", "rank_by_distance"]),
    "personal_records": TableChecks(not_null=["user_id", "workout_type"]),
    "fact_daily_metrics": TableChecks(
        not_null=["daily_metric_sk", "user_id", "date_day"],
        unique=["daily_metric_sk"],
        relationships={"user_sk": ("dim_user", "user_sk")},
    ),
}

# Table -> (load column, warn after hours, error after hours).
FRESHNESS = {
    "raw_workouts": ("synced_at", 24, 48),
    "raw_users": ("updated_at", 48, 96),
}


def source_freshness(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Freshness of every source table that has limits."""
    parts = [
        table_freshness(tables[name], name, column, as_of, warn, error)
        for name, (column, warn, error) in FRESHNESS.items()
        if name in tables
    ]
    result, *rest = parts
    for part in rest:
        result = result.unionByName(part)
    return result
