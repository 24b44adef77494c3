"""Static reference data (S-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "workout_type string, category string, is_cardio boolean, met_value double"

# Workout types with their energy cost.
EXERCISE_TYPES = [
    ("run", "cardio", True, 9.8),
    ("ride", "cardio", True, 7.5),
    ("swim", "cardio", True, 8.3),
    ("walk", "cardio", True, 3.5),
    ("hike", "cardio", True, 6.0),
    ("strength", "strength", False, 5.0),
    ("rower", "cardio", True, 7.0),
]


def exercise_types(spark: SparkSession) -> DataFrame:
    """The seed as literals, whose size the optimizer knows: joins with it are broadcast joins."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in EXERCISE_TYPES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def read_seed(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """A seed kept as CSV with a header."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
