"""Raw records for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1, 6)


def iso(ts: datetime) -> str:
    return ts.isoformat() + "+00:00"


def workout(i: int, user: str = "u-1", start: datetime = T0, minutes: float = 30, **changes) -> dict:
    base = {
        "workout_id": f"w-{i}",
        "user_id": user,
        "workout_type": "run",
        "start_time": iso(start),
        "end_time": iso(start + timedelta(minutes=minutes)),
        "device_id": "device-1",
        "synced_at": iso(start + timedelta(hours=1)),
        "distance_meters": 5000.0,
        "calories": 300.5,
        "samples": [{"ts": iso(start), "heart_rate_bpm": 140, "lat": 1.5, "lon": None, "elevation_m": 10}],
    }
    base.update(changes)
    return base


def user(name: str = "u-1", updated: datetime = T0, **changes) -> dict:
    base = {
        "user_id": name,
        "display_name": name.upper(),
        "email": f"{name}@example.com",
        "age": 30,
        "weight_kg": 70.5,
        "height_cm": 170,
        "fitness_goal": "maintain",
        "updated_at": iso(updated),
    }
    base.update(changes)
    return base


def friends(a: str, b: str, when: datetime = T0) -> list[dict]:
    return [{"user_id": x, "friend_user_id": y, "created_at": iso(when)} for x, y in ((a, b), (b, a))]


def without(record: dict, *names: str) -> dict:
    return {k: v for k, v in record.items() if k not in names}


def texts(spark, records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(lines, "value string")
