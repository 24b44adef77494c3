"""Raw JSON records to typed rows, with a reason for every reject (I-1 to I-12).

Input is one JSON object per row in a text column. Fields that are text in any case are read as text,
the others as VARIANT, because any of them may hold a wrong type and must then reject its own record
only. Each record is parsed once and no Python runs per row.

A normaliser returns the columns `raw, dt, mark, error, record`: `error` is NULL exactly for valid
rows, `record` is the typed struct, `mark` the version read from the raw record (also of rejects) and
`dt` its first ten characters.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.functions.nested import EMPTY_SAMPLES, zip_streams
from activity_engine.functions.scalars import plus_seconds
from activity_engine.schemas import CANONICAL_SOURCE, ENTITIES, THIRD_PARTY_SOURCE

# The parsed record, and the member that holds the text of a record that is no JSON object.
PARSED = "_record"
BROKEN = "_broken"

# The third-party activity vocabulary and ours.
TYPE_MAP = {
    "Run": "run",
    "TrailRun": "run",
    "VirtualRun": "run",
    "Ride": "ride",
    "VirtualRide": "ride",
    "MountainBikeRide": "ride",
    "Swim": "swim",
    "Walk": "walk",
    "Hike": "hike",
    "WeightTraining": "strength",
    "Workout": "strength",
    "Rowing": "rower",
}

# Fields that must be present and not null.
REQUIRED = {
    "users": [
        "user_id",
        "display_name",
        "email",
        "age",
        "weight_kg",
        "height_cm",
        "fitness_goal",
        "updated_at",
    ],
    "friendships": ["user_id", "friend_user_id", "created_at"],
    "workouts": [
        "workout_id",
        "user_id",
        "workout_type",
        "start_time",
        "end_time",
        "device_id",
        "synced_at",
    ],
    "athletes": ["id"],
    "activities": ["id", "athlete", "type", "start_date", "elapsed_time"],
}

# How the fields of a raw record are read.
RAW_SCHEMA = {
    "users": "user_id string, display_name string, email string, age variant, weight_kg variant, "
    "height_cm variant, fitness_goal string, updated_at string",
    "friendships": "user_id string, friend_user_id string, created_at string",
    "workouts": "workout_id string, user_id string, workout_type string, start_time string, end_time string, "
    "device_id string, synced_at string, distance_meters variant, calories variant, samples variant",
    "athletes": "id string, firstname string, lastname string, email string, weight variant, updated_at string",
    "activities": "id string, athlete variant, type string, start_date string, elapsed_time variant, "
    "distance variant, calories variant, device_name string, _synced_at string, _streams variant",
}

INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def field(name: str) -> Column:
    return F.col(f"{PARSED}.{name}")


def inside(name: str, path: str, dtype: str) -> Column:
    """Part of a VARIANT field, or NULL where it is absent or of another type."""
    return F.try_variant_get(field(name), path, dtype)


def number(name: str) -> Column:
    return inside(name, "$", "double")


def whole_number(name: str) -> Column:
    """Numbers are cut to whole ones; text must hold an integer."""
    is_text = F.coalesce(F.schema_of_variant(field(name)) == "STRING", F.lit(False))
    return F.when(~is_text | inside(name, "$", "string").rlike(INTEGER_TEXT), inside(name, "$", "bigint"))


def instant(name: str) -> Column:
    """ISO-8601 text to a UTC instant; no offset means UTC, text that is no timestamp gives NULL."""
    return field(name).try_cast("timestamp")


def is_given(name: str, raw: str) -> Column:
    """Present and not null, for a field of the raw record kind `raw`."""
    present = field(name).isNotNull()
    return present & ~F.is_variant_null(field(name)) if f"{name} variant" in RAW_SCHEMA[raw] else present


def missing_fields(raw: str) -> Column:
    """Quoted names of the required fields that are absent or null; empty when none is."""
    return F.concat_ws(", ", *(F.when(~is_given(n, raw), F.lit(f"'{n}'")) for n in REQUIRED[raw]))


def first_error(*problems: tuple[Column, Column]) -> Column:
    """Message of the first condition that holds, else NULL."""
    message = F.lit(None).cast("string")
    for condition, text in reversed(problems):
        message = F.when(F.coalesce(condition, F.lit(False)), text).otherwise(message)
    return message


def _problems(raw: str, subject: Column, missing_word: str, checks: Sequence[tuple[Column, str]]) -> Column:
    missing = missing_fields(raw)
    return first_error(
        (field(BROKEN).isNotNull(), F.lit("not a JSON object")),
        (missing != "", F.concat(subject, F.lit(f": {missing_word} ["), missing, F.lit("]"))),
        *((condition, F.concat(subject, F.lit(f": {text}"))) for condition, text in checks),
    )


def _unreadable(raw: str, name: str, value: Column) -> tuple[Column, str]:
    """Given, but not convertible to the declared type."""
    return is_given(name, raw) & value.isNull(), f"bad {name} value"


def _given(part: Column) -> Column:
    """Whether a VARIANT is there and no JSON null."""
    return part.isNotNull() & ~F.is_variant_null(part)


def _bad_samples(raw: Column, typed: Column) -> Column:
    """Whether a list of samples has an element that is no object, or a member that its type cannot hold.

    The cast makes NULLs of both; here they are told apart from members that are absent or null.
    """
    members = ("ts", "heart_rate_bpm", "lat", "lon", "elevation_m")

    def bad(sample: Column, cast: Column) -> Column:
        lost = ~_given(sample) | cast.isNull()
        for name in members:
            lost = lost | (_given(F.try_variant_get(sample, f"$.{name}", "variant")) & cast[name].isNull())
        return F.coalesce(lost, F.lit(True))

    return F.exists(F.zip_with(raw, typed, bad), lambda x: x)


def _bad_stream(path: str, nested: bool = False) -> Column:
    """Whether a third-party stream is given but is no list, or has an element that is no number."""
    given = _given(inside("_streams", path, "variant"))
    raw = inside("_streams", path, "array<variant>")
    lists = inside("_streams", path, "array<array<variant>>")

    def no_number(x: Column) -> Column:
        return _given(x) & F.try_variant_get(x, "$", "double").isNull()

    if nested:
        # A place is a list of numbers, or missing.
        pairs = F.zip_with(raw, lists, lambda x, xs: (_given(x) & xs.isNull()) | F.coalesce(F.exists(xs, no_number), F.lit(False)))
        wrong = F.exists(pairs, lambda x: x)
    else:
        wrong = F.exists(raw, no_number)
    return given & (raw.isNull() | F.coalesce(wrong, F.lit(False)))


def _subject(what: str, name: str, quote: str = "'") -> Column:
    shown = F.concat(F.lit(quote), field(name), F.lit(quote))
    return F.concat(F.lit(f"malformed {what} record "), F.coalesce(shown, F.lit("None")))


def _shape(
    records: DataFrame,
    text: str,
    raw: str,
    entity: str,
    error: Column,
    values: dict[str, Column],
    version: str,
    version_default: Column | None = None,
    once: dict[str, Column] | None = None,
) -> DataFrame:
    """`once` names columns of the parsed record that `error` and `values` look at more than once."""
    record = F.struct(*(values[f.name].cast(f.dataType).alias(f.name) for f in ENTITIES[entity].schema.fields))
    given = F.nullif(field(version), F.lit(""))
    day, mark = F.substring(given, 1, 10), given.try_cast("timestamp")
    if version_default is not None:
        day = F.coalesce(day, F.date_format(version_default, "yyyy-MM-dd"))
        mark = F.when(given.isNull(), version_default.cast("timestamp")).otherwise(mark)
    schema = f"{RAW_SCHEMA[raw]}, {BROKEN} string"
    parsed = F.from_json(F.col(text), schema, {"columnNameOfCorruptRecord": BROKEN})
    fields = _fenced(records.select(F.col(text).alias("raw"), parsed.alias(PARSED))).withColumns(once or {})
    shaped = fields.select("raw", day.alias("dt"), mark.alias("mark"), error.alias("error"), record.alias("record"))
    return _fenced(shaped.withColumn("record", F.when(F.col("error").isNull(), F.col("record"))))


def _fenced(df: DataFrame) -> DataFrame:
    """The same rows, with the columns worked out exactly once.

    A filter on a computed column is pushed below the projection as a copy of its expression. Here
    that would parse each record again for every field the error message looks at. The optimizer does
    not push filters through a generator, so the columns pass through one of a single element.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def normalize_users(records: DataFrame, source: str = CANONICAL_SOURCE, text: str = "value") -> DataFrame:
    numbers = {"age": whole_number("age"), "weight_kg": number("weight_kg"), "height_cm": number("height_cm")}
    checks = [_unreadable("users", name, value) for name, value in numbers.items()]
    checks.append(_unreadable("users", "updated_at", instant("updated_at")))
    values = {
        "user_id": field("user_id"),
        "source": F.lit(source),
        "display_name": field("display_name"),
        "email": field("email"),
        **numbers,
        "fitness_goal": field("fitness_goal"),
        "updated_at": instant("updated_at"),
    }
    error = _problems("users", _subject("user", "user_id"), "missing/null", checks)
    return _shape(records, text, "users", "users", error, values, "updated_at")


def normalize_friendships(records: DataFrame, source: str = CANONICAL_SOURCE, text: str = "value") -> DataFrame:
    values = {
        "user_id": field("user_id"),
        "friend_user_id": field("friend_user_id"),
        "source": F.lit(source),
        "created_at": instant("created_at"),
    }
    checks = [_unreadable("friendships", "created_at", instant("created_at"))]
    error = _problems("friendships", F.lit("malformed friendship record"), "missing/null", checks)
    return _shape(records, text, "friendships", "friendships", error, values, "created_at")


def normalize_workouts(records: DataFrame, source: str = CANONICAL_SOURCE, text: str = "value") -> DataFrame:
    """An absent sample list becomes an empty one; an explicit null or anything else is a reject.

    So is a list with a sample that is no object, or one of whose members cannot be read.
    """
    once = {
        "_listed": inside("samples", "$", "array<variant>"),
        "_typed": inside("samples", "$", EMPTY_SAMPLES),
        **{f"_{name}": number(name) for name in ("calories", "distance_meters")},
        **{f"_{name}": instant(name) for name in ("start_time", "end_time", "synced_at")},
    }
    listed, typed = F.col("_listed"), F.col("_typed")
    not_a_list = field("samples").isNotNull() & listed.isNull()
    checks = [
        (not_a_list, "samples is not a list"),
        (listed.isNotNull() & F.coalesce(_bad_samples(listed, typed), F.lit(True)), "bad samples value"),
        *(
            _unreadable("workouts", name, F.col(f"_{name}"))
            for name in ("calories", "distance_meters", "start_time", "end_time", "synced_at")
        ),
    ]
    values = {
        "workout_id": field("workout_id"),
        "user_id": field("user_id"),
        "source": F.lit(source),
        "workout_type": field("workout_type"),
        "start_time": F.col("_start_time"),
        "end_time": F.col("_end_time"),
        "device_id": field("device_id"),
        "synced_at": F.col("_synced_at"),
        "distance_meters": F.col("_distance_meters"),
        "calories": F.col("_calories"),
        "samples": F.coalesce(typed, F.array().cast(EMPTY_SAMPLES)),
    }
    error = _problems("workouts", _subject("workout", "workout_id"), "missing/null", checks)
    return _shape(records, text, "workouts", "workouts", error, values, "synced_at", once=once)


def map_type(activity_type: Column) -> Column:
    """Third-party activity type to ours; an unknown one is lower-cased."""
    pairs = [F.lit(x) for pair in TYPE_MAP.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), activity_type), F.lower(activity_type))


def athlete_values(
    athlete_id: Column, first: Column, last: Column, email: Column, weight: Column, updated_at: Column, source: str
) -> dict[str, Column]:
    """User columns of a third-party athlete; only the id is certain."""
    prefixed = F.concat(F.lit(f"{source}-"), athlete_id)
    full_name = F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))
    return {
        "user_id": prefixed,
        "source": F.lit(source),
        "display_name": F.coalesce(F.nullif(full_name, F.lit("")), F.concat(F.lit("Athlete "), athlete_id)),
        "email": F.coalesce(F.nullif(email, F.lit("")), F.concat(prefixed, F.lit("@unknown.example"))),
        "age": F.lit(None),
        "weight_kg": F.nullif(weight, F.lit(0.0)),
        "height_cm": F.lit(None),
        "fitness_goal": F.lit(None),
        "updated_at": updated_at,
    }


def _or_as_of(name: str, as_of: Column) -> Column:
    """A version instant; absent or empty text means `as_of`."""
    return F.when(F.coalesce(field(name), F.lit("")) == "", as_of.cast("timestamp")).otherwise(instant(name))


def normalize_athletes(
    records: DataFrame, as_of: Column, source: str = THIRD_PARTY_SOURCE, text: str = "value"
) -> DataFrame:
    """`as_of` stands in for an absent `updated_at`."""
    weight, updated = number("weight"), _or_as_of("updated_at", as_of)
    values = athlete_values(
        field("id"), field("firstname"), field("lastname"), field("email"), weight, updated, source
    )
    weight_text = inside("weight", "$", "string")
    checks = [
        ((weight_text != "") & weight.isNull(), "bad weight value"),
        (updated.isNull(), "bad updated_at value"),
    ]
    error = _problems("athletes", _subject("athlete", "id", ""), "missing", checks)
    return _shape(records, text, "athletes", "users", error, values, "updated_at", as_of)


def activity_values(
    activity_id: Column, athlete_id: Column, activity_type: Column, start: Column, elapsed: Column, synced_at: Column,
    distance: Column, calories: Column, device: Column, samples: Column, source: str,
) -> dict[str, Column]:
    """Workout columns of a third-party activity; it ends `elapsed` seconds after its start."""
    return {
        "workout_id": F.concat(F.lit(f"{source}-"), activity_id),
        "user_id": F.concat(F.lit(f"{source}-"), athlete_id),
        "source": F.lit(source),
        "workout_type": map_type(activity_type),
        "start_time": start,
        "end_time": plus_seconds(start, elapsed),
        "device_id": F.coalesce(F.nullif(device, F.lit("")), F.lit(f"{source}-unknown-device")),
        "synced_at": synced_at,
        "distance_meters": distance,
        "calories": calories,
        "samples": samples,
    }


def normalize_activities(
    records: DataFrame, as_of: Column, source: str = THIRD_PARTY_SOURCE, text: str = "value"
) -> DataFrame:
    """`as_of` stands in for an absent sync time."""
    start, synced = instant("start_date"), _or_as_of("_synced_at", as_of)
    athlete_id = inside("athlete", "$.id", "string")
    elapsed, distance, calories = number("elapsed_time"), number("distance"), number("calories")
    samples = zip_streams(
        inside("_streams", "$.time.data", "array<double>"),
        inside("_streams", "$.heartrate.data", "array<bigint>"),
        inside("_streams", "$.latlng.data", "array<array<double>>"),
        inside("_streams", "$.altitude.data", "array<double>"),
        start,
    )
    values = activity_values(
        field("id"), athlete_id, field("type"), start, elapsed, synced,
        distance, calories, field("device_name"), samples, source,
    )
    checks = [
        (athlete_id.isNull(), "athlete has no id"),
        _unreadable("activities", "start_date", start),
        _unreadable("activities", "elapsed_time", elapsed),
        _unreadable("activities", "distance", distance),
        _unreadable("activities", "calories", calories),
        (synced.isNull(), "bad _synced_at value"),
        *(
            (_bad_stream(f"$.{name}.data", name == "latlng"), f"bad {name} stream")
            for name in ("time", "heartrate", "latlng", "altitude")
        ),
    ]
    error = _problems("activities", _subject("activity", "id", ""), "missing", checks)
    return _shape(records, text, "activities", "workouts", error, values, "_synced_at", as_of)


def normalizer(entity: str, source: str, as_of: Column) -> Callable[[DataFrame], DataFrame]:
    """The normaliser of one entity of one source."""
    if source == THIRD_PARTY_SOURCE:
        shaped = {"users": normalize_athletes, "workouts": normalize_activities}
        return lambda raw: shaped[entity](raw, as_of, source)
    shaped = {"users": normalize_users, "workouts": normalize_workouts, "friendships": normalize_friendships}
    return lambda raw: shaped[entity](raw, source)


def valid_rows(shaped: DataFrame) -> DataFrame:
    """Typed records and their landing day."""
    return shaped.where(F.col("error").isNull()).select("record.*", "dt")


def reject_rows(shaped: DataFrame, as_of: Column) -> DataFrame:
    """Raw text, message and day; without a version the day is that of `as_of`."""
    day = F.coalesce(F.col("dt"), F.date_format(as_of, "yyyy-MM-dd"))
    return shaped.where(F.col("error").isNotNull()).select("error", "raw", day.alias("dt"))


def conform(*parts: DataFrame) -> DataFrame:
    """All sources share one shape, so they are one union."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def enforce_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail the job when a required column is NULL (file sources drop NOT NULL)."""
    for name in required:
        if isinstance(df.schema[name].dataType, T.NullType):
            raise ValueError(f"required column {name} is all null")
        problem = F.raise_error(F.lit(f"required column {name} is null")).cast(df.schema[name].dataType)
        df = df.withColumn(name, F.coalesce(F.col(name), problem))
    return df
