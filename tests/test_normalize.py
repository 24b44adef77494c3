"""Normalising: each known fault, the forgiving cases, and the third-party shapes."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from records import T0, friends, iso, texts, user, without, workout

from activity_engine.operators import normalize as nz
from activity_engine.schemas import ENTITIES, entities_for

def now():
    return F.lit("2024-03-09 12:00:00").cast("timestamp")


def split(shaped):
    valid = [r.asDict(recursive=True) for r in nz.valid_rows(shaped).collect()]
    rejects = [r.asDict() for r in nz.reject_rows(shaped, now()).collect()]
    return valid, rejects


MALFORMED = [
    (without(workout(1), "device_id"), "missing/null ['device_id']"),
    (workout(1, user_id=None), "missing/null ['user_id']"),
    (workout(1, calories="unknown"), "bad calories value"),
    (workout(1, samples="not-a-list"), "samples is not a list"),
    (without(workout(1), "workout_type"), "missing/null ['workout_type']"),
    (workout(1, samples=None), "samples is not a list"),
    (workout(1, samples={"a": 1}), "samples is not a list"),
    (workout(1, samples=[{"ts": "oops", "heart_rate_bpm": 1}]), "bad samples value"),
    (workout(1, samples=[{"heart_rate_bpm": "abc"}]), "bad samples value"),
    (workout(1, samples=[1, 2]), "bad samples value"),
    (workout(1, samples=[{"lat": 1.5}, None]), "bad samples value"),
    (workout(1, distance_meters=[]), "bad distance_meters value"),
    (workout(1, start_time="soon"), "bad start_time value"),
    (without(workout(1, device_id=None), "workout_type"), "missing/null ['workout_type', 'device_id']"),
    ('{"workout_id": "w-1"', "not a JSON object"),
    ("[1, 2]", "not a JSON object"),
]


@pytest.mark.parametrize("record,message", MALFORMED)
def test_malformed_workouts_are_rejected(spark, record, message):
    valid, rejects = split(nz.normalize_workouts(texts(spark, [record]), "app"))
    assert valid == [] and len(rejects) == 1
    assert rejects[0]["error"].endswith(message)
    assert rejects[0]["dt"] == ("2024-03-09" if "JSON" in message else "2024-03-01")


def test_good_workouts(spark):
    records = [
        workout(1),
        without(workout(2, calories=None, distance_meters="12.5"), "samples"),
        workout(3, calories="99.5", samples=[], start_time="2024-03-01", end_time="2024-03-01T00:30:00.250Z"),
        workout(4, samples=[{"ts": iso(T0), "heart_rate_bpm": None}, {}]),
    ]
    valid, rejects = split(nz.normalize_workouts(texts(spark, records), "app"))
    assert rejects == []
    one, two, three, four = sorted(valid, key=lambda r: r["workout_id"])
    assert one["samples"] == [{"ts": T0, "heart_rate_bpm": 140, "lat": 1.5, "lon": None, "elevation_m": 10.0}]
    assert (one["source"], one["synced_at"], one["dt"]) == ("app", T0 + timedelta(hours=1), "2024-03-01")
    assert (two["calories"], two["distance_meters"], two["samples"]) == (None, 12.5, [])
    assert (three["calories"], three["samples"], three["start_time"]) == (99.5, [], datetime(2024, 3, 1))
    assert three["end_time"] == datetime(2024, 3, 1, 0, 30, 0, 250000)
    assert len(four["samples"]) == 2
    assert list(one) == [*ENTITIES["workouts"].columns, "dt"]


def test_every_record_goes_to_one_side_and_rejects_keep_their_text(spark):
    records = [workout(i) for i in range(5)] + [r for r, _ in MALFORMED]
    raw = texts(spark, records)
    shaped = nz.normalize_workouts(raw, "app")
    valid, rejects = split(shaped)
    assert len(valid) == 5 and len(rejects) == len(MALFORMED)
    assert {r["raw"] for r in rejects} <= {r.value for r in raw.collect()}


def test_anomalies_are_valid(spark):
    records = [workout(1, minutes=60 * 40), workout(2, distance_meters=-10)]
    valid, rejects = split(nz.normalize_workouts(texts(spark, records), "app"))
    assert len(valid) == 2 and rejects == []


def test_users(spark):
    records = [
        user("a", age=35.9, weight_kg="61"),
        user("b", age="35"),
        user("c", age="35.5"),
        user("d", height_cm="tall"),
        without(user("e", email=None), "age"),
        user("f", updated_at="yesterday"),
        user("g", user_id=7),
    ]
    valid, rejects = split(nz.normalize_users(texts(spark, records), "app"))
    got = {r["user_id"]: r for r in valid}
    assert sorted(got) == ["7", "a", "b"]
    assert (got["a"]["age"], got["a"]["weight_kg"], got["b"]["age"]) == (35, 61.0, 35)
    assert sorted(r["error"] for r in rejects) == [
        "malformed user record 'c': bad age value",
        "malformed user record 'd': bad height_cm value",
        "malformed user record 'e': missing/null ['email', 'age']",
        "malformed user record 'f': bad updated_at value",
    ]


def test_friendships(spark):
    records = [*friends("a", "b"), without(friends("a", "c")[0], "friend_user_id")]
    valid, rejects = split(nz.normalize_friendships(texts(spark, records), "app"))
    assert {(r["user_id"], r["friend_user_id"]) for r in valid} == {("a", "b"), ("b", "a")}
    assert rejects[0]["error"] == "malformed friendship record: missing/null ['friend_user_id']"


def test_athletes(spark):
    records = [
        {"id": 9, "firstname": "Ann", "lastname": "", "weight": 0, "updated_at": "2024-03-02T00:00:00Z"},
        {"id": 10, "email": "", "weight": "70"},
        {"id": 11, "firstname": "A", "lastname": "B", "email": "x@y", "weight": "heavy"},
        {"firstname": "nobody"},
    ]
    valid, rejects = split(nz.normalize_athletes(texts(spark, records), now()))
    nine, ten = sorted(valid, key=lambda r: r["email"], reverse=True)
    assert (nine["user_id"], nine["display_name"], nine["weight_kg"], nine["dt"]) == ("strava-9", "Ann", None, "2024-03-02")
    assert (ten["display_name"], ten["email"], ten["weight_kg"]) == ("Athlete 10", "strava-10@unknown.example", 70.0)
    assert ten["updated_at"] == datetime(2024, 3, 9, 12) and ten["dt"] == "2024-03-09"
    assert sorted(r["error"] for r in rejects) == [
        "malformed athlete record 11: bad weight value",
        "malformed athlete record None: missing ['id']",
    ]


def test_activities(spark):
    streams = {"time": {"data": [0, 60]}, "heartrate": {"data": [120]}, "latlng": {"data": [[1.0, 2.0]]}}
    good = {"id": 5, "athlete": {"id": 9}, "type": "TrailRun", "start_date": "2024-03-01T06:00:00Z", "elapsed_time": 90.5}
    records = [
        {**good, "_streams": streams, "_synced_at": iso(T0)},
        {**good, "id": 6, "type": "Kitesurf", "device_name": "watch", "_streams": {}},
        {**good, "id": 7, "athlete": {}},
        without({**good, "id": 8}, "type"),
    ]
    shaped = nz.normalize_activities(texts(spark, records), now())
    valid, rejects = split(shaped)
    five, six = sorted(valid, key=lambda r: r["workout_id"])
    assert (five["user_id"], five["workout_type"], five["device_id"]) == ("strava-9", "run", "strava-unknown-device")
    assert five["end_time"] == T0 + timedelta(seconds=90.5)
    assert [(s["ts"], s["heart_rate_bpm"], s["lon"]) for s in five["samples"]] == [
        (T0, 120, 2.0), (T0 + timedelta(minutes=1), None, None),
    ]
    assert (six["workout_type"], six["samples"], six["device_id"]) == ("kitesurf", [], "watch")
    assert six["synced_at"] == datetime(2024, 3, 9, 12)
    # The mark follows the version that was filled in, so it moves for this source too.
    assert shaped.agg(F.max("mark")).first()[0] == datetime(2024, 3, 9, 12)
    assert len(rejects) == 2


@pytest.mark.parametrize(
    "name,data",
    [("time", ["x"]), ("time", 5), ("heartrate", [90, "fast"]), ("latlng", [["a", 2]]), ("latlng", [3]), ("altitude", [{}])],
)
def test_bad_streams_are_rejected(spark, name, data):
    record = {"id": 5, "athlete": {"id": 9}, "type": "Run", "start_date": "2024-03-01T06:00:00Z", "elapsed_time": 90}
    fine = {"time": {"data": [0, None]}, "heartrate": {"data": [None, 99.5]}, "latlng": {"data": [None, [1, None]]}, "altitude": None}
    records = [{**record, "_streams": fine}, {**record, "_streams": {**fine, name: {"data": data}}}]
    valid, rejects = split(nz.normalize_activities(texts(spark, records), now()))
    assert len(valid) == 1 and [r["error"] for r in rejects] == [f"malformed activity record 5: bad {name} stream"]


def test_records_are_parsed_once(spark):
    shaped = nz.normalize_workouts(texts(spark, [workout(1)]), "app")
    plan = nz.valid_rows(shaped)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_required_columns_fail_the_job(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert nz.enforce_required(df, ["x"]).count() == 1
    with pytest.raises(Exception, match="required column y"):
        nz.enforce_required(df, ["x", "y"]).collect()


def test_source_support():
    assert entities_for("strava") == ("users", "workouts")
    assert entities_for("synthetic", "friendships") == ("friendships",)
    with pytest.raises(ValueError):
        entities_for("strava", "friendships")
