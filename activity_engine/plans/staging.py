"""Staging models (U-4 to U-6): latest version per key, typed and renamed. Lazy, never stored.

`unique` says that the input is a merged table, which holds one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.functions.scalars import minutes_between
from activity_engine.operators.dedupe import latest_per_key
from activity_engine.schemas import ENTITIES


def _latest(raw: DataFrame, entity: str, tie: Sequence[str], unique: bool) -> DataFrame:
    """One row per key; a merged table has one already, and moving its rows again would change nothing."""
    spec = ENTITIES[entity]
    if unique:
        return raw.withColumnRenamed("source", "source_system")
    # Without a tie-break of the caller's, equal versions go by the remaining columns.
    tie = tie or [c for c in spec.columns if c not in (*spec.keys, spec.version)]
    return latest_per_key(raw, spec.keys, spec.version, tie).withColumnRenamed("source", "source_system")


def stg_workouts(raw: DataFrame, tie: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """One row per workout. Samples stay nested."""
    return _latest(raw, "workouts", tie, unique).select(
        "workout_id",
        "user_id",
        "source_system",
        "workout_type",
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.col("end_time").cast("timestamp").alias("end_time"),
        minutes_between(F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp")).alias(
            "duration_minutes"
        ),
        "device_id",
        F.col("synced_at").cast("timestamp").alias("synced_at"),
        "distance_meters",
        "calories",
        "samples",
    )


def stg_users(raw: DataFrame, tie: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """One row per user and source system."""
    names = ["user_id", "source_system", "display_name", "email", "age", "weight_kg", "height_cm", "fitness_goal"]
    return _latest(raw, "users", tie, unique).select(*names, F.col("updated_at").cast("timestamp").alias("updated_at"))


def stg_friendships(raw: DataFrame, tie: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """One row per directed edge; no reverse edge is made up."""
    return _latest(raw, "friendships", tie, unique).select(
        "user_id", "friend_user_id", "source_system", F.col("created_at").cast("timestamp").alias("created_at")
    )
