"""Partial aggregates and incremental models against building everything anew."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from activity_engine.operators.partials import Partials
from activity_engine.plans.facts import fact_daily_metrics
from activity_engine.plans.marts import personal_records
from activity_engine.plans.refresh import METRICS, RECORDS, DailyModels, affected_days, metric_rows
from activity_engine.plans.staging import stg_workouts
from activity_engine.schemas import ENTITIES
from activity_engine.sources.tables import merge_table, read_entity

SPEC = ENTITIES["workouts"]
DAY0 = datetime(2024, 2, 20)


def raw(spark, rows):
    """(id, user, type, day, minutes, metres, version)"""
    made = []
    for i, user, kind, day, minutes, metres, version in rows:
        start = DAY0 + timedelta(days=day, hours=i % 24)
        made.append((f"w{i}", user, "app", kind, start, start + timedelta(minutes=minutes), "d", DAY0 + timedelta(hours=version), metres, None if i % 5 == 0 else float(i), []))
    return spark.createDataFrame(made, SPEC.schema)


def dim(spark, users):
    return spark.createDataFrame([(u, f"sk-{u}", True) for u in users], "user_id string, user_sk string, is_current boolean")


def expected(spark, path, users, as_of):
    workouts = stg_workouts(read_entity(spark, path, SPEC).drop("dt"), unique=True)
    daily = fact_daily_metrics(workouts, users, F.lit(as_of).cast("timestamp"))
    return daily, personal_records(workouts)


def text(df, columns):
    out = [F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes if c in columns]
    return sorted(map(str, df.select(*sorted(columns)).select(*sorted(out, key=str)).collect()))


def take(spark, root, models, rows, users, as_of, run):
    feed = f"{root}/feed/{run}"
    merge_table(spark, f"{root}/raw", raw(spark, rows), SPEC, feed)
    workouts = stg_workouts(read_entity(spark, f"{root}/raw", SPEC).drop("dt"), unique=True)
    return models.refresh(workouts, users.select("user_id"), as_of, run, spark.read.parquet(feed) if run else None)


def files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_random_batches_equal_a_full_build(spark, tmp_path):
    rng = random.Random(1)
    root, users = str(tmp_path), ["a", "b", "c"]
    models = DailyModels(spark, f"{root}/models")
    for run in range(4):
        rows = [
            (rng.randrange(40), rng.choice(["a", "b", "c", "x"]), rng.choice(["run", None, "ride"]), rng.randrange(-8 if run > 1 else 0, 70), rng.randrange(90), rng.choice([None, 0.0, 10.0 * rng.random()]), 10 * run + rng.randrange(12))
            for _ in range(25 if run == 0 else 7)
        ]
        known, as_of = dim(spark, users[: 2 + (run > 0)]), DAY0 + timedelta(days=60 + 6 * (run > 1))
        take(spark, root, models, rows, known, as_of, run)
        daily, best = expected(spark, f"{root}/raw", known, as_of)
        assert text(models.daily_metrics(known), METRICS) == text(daily, METRICS), run
        assert text(models.personal_records(), RECORDS + ["user_id", "workout_type"]) == text(best, RECORDS + ["user_id", "workout_type"]), run
    # The last batch again, and a compacted log: nothing changes.
    before = text(models.daily_metrics(known), METRICS)
    take(spark, root, models, rows, known, as_of, 3)
    models.compact()
    assert len(models.runs()) == 1
    take(spark, root, models, [], known, as_of, 5)
    assert text(models.daily_metrics(known), METRICS) == before


def test_a_late_workout_rewrites_its_months_only(spark, tmp_path):
    root, users = str(tmp_path), dim(spark, ["a", "b"])
    models, as_of = DailyModels(spark, f"{root}/models"), DAY0 + timedelta(days=200)
    rows = [(i, "ab"[i % 2], "run", 3 * i, 30, 100.0, 0) for i in range(60)]
    take(spark, root, models, rows, users, as_of, 0)
    before = files(models.metrics_path)
    months = take(spark, root, models, [(900, "a", "run", 43, 55, 9.0, 50)], users, as_of, 1)
    assert months == ["2024-04"]  # 3 April, and thirteen days on
    kept = {f for f in before if "month=2024-04" not in f}
    assert kept == {f for f in files(models.metrics_path) if "month=2024-04" not in f} and len(kept) >= 6
    assert text(models.daily_metrics(users), METRICS) == text(expected(spark, f"{root}/raw", users, as_of)[0], METRICS)


def test_a_correction_lowers_only_its_group(spark):
    spec = Partials(("k",), sums={"s": "v"}, maxima={"hi": "v"}, minima={"lo": "v"})
    now = spark.createDataFrame([("x", 1), ("x", 5), ("y", 7), (None, 2)], "k string, v int")
    log = spec.of(spark.createDataFrame([("x", 9), ("x", 5), ("y", 7), (None, 2), ("z", 3)], "k string, v int"))
    log = log.withColumn("base", F.lit(True)).withColumn("run", F.lit(0))
    changes = spark.createDataFrame([("x", 9, "before"), ("x", 1, "after"), ("z", 3, "before"), (None, 4, "after"), ("n", 8, "after")], "k string, v int, _change string")
    now = now.unionByName(spark.createDataFrame([(None, 4), ("n", 8)], "k string, v int"))
    delta = spec.delta(changes, now)
    assert {(r.k, r.n, r.base) for r in delta.collect()} == {("x", 2, True), ("z", 0, True), (None, 1, False), ("n", 1, False)}
    state = spec.state(log.unionByName(delta.withColumn("run", F.lit(1))))
    assert sorted(map(tuple, state.collect()), key=str) == sorted(map(tuple, spec.of(now).collect()), key=str)


def moves(df):
    """Exchanges of the plan as it is before the run."""
    spark = df.sparkSession
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    return plan


def test_metrics_of_asked_days_move_by_user_only(spark):
    """Windows look back in place: active days are not copied to the thirteen days after them, nor moved by day."""
    rng = random.Random(4)
    first, day = date(2024, 2, 1), lambda i: date(2024, 2, 1) + timedelta(days=i)
    made = {(u, d): (rng.randrange(1, 4), rng.choice([None, rng.randrange(90)])) for u in ("a", "b", None) for d in rng.sample(range(-3, 50), 18)}
    rows = [(u, day(d), n, m, None, float(n)) for (u, d), (n, m) in made.items()]
    totals = spark.createDataFrame(rows, "user_id string, date_day date, workout_count long, total_duration_minutes long, total_distance_meters double, total_calories double")
    days = [(u, d) for u in ("a", None, "new") for d in range(55) if rng.random() < 0.6]
    asked = spark.createDataFrame([(u, day(d)) for u, d in days], "user_id string, date_day date")
    found = metric_rows(asked, totals, F.lit(first))
    plan = moves(found)
    assert "Exchange hashpartitioning(user_id" in plan and "date_day" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    assert "Generate explode" not in plan
    got = {(r.user_id, (r.date_day - first).days): r for r in found.collect()}
    assert sorted(got, key=str) == sorted(days, key=str)
    for (u, d), r in got.items():
        minutes = lambda lo, hi: sum(made.get((u, e), (0, 0))[1] or 0 for e in range(max(0, d - lo), d - hi + 1))  # noqa: B023, E731
        week, before = minutes(6, 0), minutes(13, 7)
        last = [e for v, e in made if v == u and 0 <= e < d]
        assert r.workout_count == made.get((u, d), (0,))[0] and r.total_duration_minutes == (made.get((u, d), (0, 0))[1] or 0)
        assert abs(r.rolling_7d_avg_duration_minutes - week / min(7, d + 1)) < 1e-9
        assert r.week_over_week_duration_pct_change == ((week - before) / before if before else None)
        assert r.days_since_previous_workout == (d - max(last) if last and (u, d) in made else None)
    touched = spark.createDataFrame([("a", day(5)), ("b", day(20)), ("b", day(48)), (None, day(3))], "user_id string, date_day date")
    looking = affected_days(touched, totals, F.lit(day(54)))
    # Touched days, their users, and both kinds of days by user: four moves, none of the days that are made.
    assert sum("Exchange hashpartitioning" in line for line in moves(looking).splitlines()) <= 5
    wanted = set()
    for u, d in (("a", 5), ("b", 20), ("b", 48)):
        later = [e for v, e in made if v == u and e > d]
        wanted |= {(u, e) for e in [*range(d, min(d + 13, 54) + 1), *([min(later)] if later else [])]}
    assert sorted((r.user_id, (r.date_day - first).days) for r in looking.collect()) == sorted(wanted)


def test_images_of_a_batch_are_summed_up_once(spark):
    """The groups a batch changed are kept, and its partial rows come from them without its images."""
    spec = Partials(("k",), sums={"s": "v"})
    changes = spark.createDataFrame([("x", 9, "before"), ("x", 1, "after"), (None, 4, "after"), ("z", 3, "before")], "k string, v int, _change string")
    now = spark.createDataFrame([("x", 1), ("x", 5), (None, 4)], "k string, v int")
    groups = spec.changed(changes).persist()
    assert {(r.k, r._lost) for r in groups.collect()} == {("x", 1), (None, 0), ("z", 1)}
    delta = spec.delta_of(groups, now)
    assert "InMemoryTableScan" in moves(delta)
    assert {(r.k, r.n, r.s, r.base) for r in delta.collect()} == {("x", 2, 6, True), ("z", 0, None, True), (None, 1, 4, False)}
    groups.unpersist()
