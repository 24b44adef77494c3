"""Declared schemas and per-entity settings. Nothing in the engine infers a schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, not required)


SAMPLE = T.StructType(
    [
        _field("ts", T.TimestampType()),
        _field("heart_rate_bpm", T.LongType()),
        _field("lat", T.DoubleType()),
        _field("lon", T.DoubleType()),
        _field("elevation_m", T.DoubleType()),
    ]
)

WORKOUT = T.StructType(
    [
        _field("workout_id", T.StringType(), required=True),
        _field("user_id", T.StringType(), required=True),
        _field("source", T.StringType(), required=True),
        _field("workout_type", T.StringType()),
        _field("start_time", T.TimestampType()),
        _field("end_time", T.TimestampType()),
        _field("device_id", T.StringType()),
        _field("synced_at", T.TimestampType(), required=True),
        _field("distance_meters", T.DoubleType()),
        _field("calories", T.DoubleType()),
        _field("samples", T.ArrayType(SAMPLE)),
    ]
)

USER = T.StructType(
    [
        _field("user_id", T.StringType(), required=True),
        _field("source", T.StringType(), required=True),
        _field("display_name", T.StringType()),
        _field("email", T.StringType()),
        _field("age", T.LongType()),
        _field("weight_kg", T.DoubleType()),
        _field("height_cm", T.DoubleType()),
        _field("fitness_goal", T.StringType()),
        _field("updated_at", T.TimestampType(), required=True),
    ]
)

FRIENDSHIP = T.StructType(
    [
        _field("user_id", T.StringType(), required=True),
        _field("friend_user_id", T.StringType(), required=True),
        _field("source", T.StringType(), required=True),
        _field("created_at", T.TimestampType(), required=True),
    ]
)

REJECT = T.StructType([_field("error", T.StringType()), _field("raw", T.StringType())])

# One row per (source, entity): everything up to `mark` has been seen.
MARKS = T.StructType(
    [
        _field("source", T.StringType(), required=True),
        _field("entity", T.StringType(), required=True),
        _field("mark", T.TimestampType()),
    ]
)

# Columns that the landing layout adds as directories.
LANDING_PARTITIONS = ("source", "dt", "run")


@dataclass(frozen=True)
class Entity:
    """How one kind of record is keyed and versioned."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: str

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


ENTITIES = {
    "workouts": Entity("workouts", WORKOUT, ("workout_id",), "synced_at"),
    "users": Entity("users", USER, ("user_id", "source"), "updated_at"),
    "friendships": Entity("friendships", FRIENDSHIP, ("user_id", "friend_user_id"), "created_at"),
}

# The two sources, which entities each one offers, and what "all" means.
CANONICAL_SOURCE = "synthetic"
THIRD_PARTY_SOURCE = "strava"
SUPPORT = {
    "users": {CANONICAL_SOURCE, THIRD_PARTY_SOURCE},
    "workouts": {CANONICAL_SOURCE, THIRD_PARTY_SOURCE},
    "friendships": {CANONICAL_SOURCE},
}
DEFAULT_ENTITIES = ("users", "workouts")


def entities_for(source: str, wanted: str = "all") -> tuple[str, ...]:
    """Entities to run for one source; an unsupported pair is an error."""
    names = DEFAULT_ENTITIES if wanted == "all" else (wanted,)
    bad = [n for n in names if source not in SUPPORT.get(n, set())]
    if bad:
        raise ValueError(f"source {source!r} does not offer {bad}")
    return names
