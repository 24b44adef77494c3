"""Landing, stored tables, streaming, and the full run."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from records import T0, friends, iso, texts, user, without, workout

from activity_engine.operators.normalize import normalize_workouts
from activity_engine.operators.quality import ChecksFailed
from activity_engine.plans import pipeline as pl
from activity_engine.schemas import ENTITIES, MARKS
from activity_engine.sources import landing, tables
from activity_engine.sources.seeds import EXERCISE_TYPES, exercise_types, read_seed
from activity_engine.sources.tables import merge_table, read_entity, read_table, replace_partitions, replace_table
from activity_engine.streaming.ingest import stream_ingest

NOW = datetime(2024, 3, 2, 0, 0)
WORKOUTS = ENTITIES["workouts"]


def now(ts=NOW):
    return F.lit(ts).cast("timestamp")


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- landing -----------------------------------------------------------------------------------


def test_landing_round_trip_and_pruning(spark, tmp_path):
    base = str(tmp_path)
    batch = normalize_workouts(
        texts(spark, [workout(1), workout(2, start=T0 + timedelta(days=1, microseconds=7)), workout(3, user_id=None)]), "app"
    )
    assert landing.read_landing(spark, base, "workouts").count() == 0
    landing.land(batch, base, "workouts", "app", now(), "r1")
    back = landing.read_landing(spark, base, "workouts", "app")
    expected = batch.where("error is null").select("record.*")
    assert rows(back.drop("dt", "run")) == rows(expected)
    one_day = landing.read_landing(spark, base, "workouts", dt="2024-03-02")
    assert [r.workout_id for r in one_day.collect()] == ["w-2"]
    assert "PartitionFilters: [isnotnull(dt" in one_day._jdf.queryExecution().executedPlan().toString()
    (reject,) = landing.read_rejects(spark, base, "workouts").collect()
    assert "user_id" in reject.error and json.loads(reject.raw)["workout_id"] == "w-3" and reject.dt == "2024-03-01"


def test_live_runs_add_and_replays_replace(spark, tmp_path):
    base = str(tmp_path)
    batch = normalize_workouts(texts(spark, [workout(1), workout(2)]), "app")
    for run, replay in (("live-1", False), ("live-2", False), ("window", True), ("window", True)):
        landing.land(batch, base, "workouts", "app", now(), run, replay)
    counts = landing.read_landing(spark, base, "workouts").groupBy("run").count()
    assert rows(counts) == [("live-1", 2), ("live-2", 2), ("window", 2)]


def test_run_ids():
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 2)
    assert landing.run_id(a, b) == landing.run_id(a, b) == ("backfill-2024-01-01T000000-2024-01-02T000000", True)
    assert landing.run_id(None, b)[0].startswith("backfill-epoch-")
    assert landing.run_id()[0] != landing.run_id()[0] and landing.run_id(a)[1] is False


def test_missing_required_column_stops_the_load(spark, tmp_path):
    put(tmp_path / "workouts/source=app/dt=2024-03-01/run=x", "part.json", [without(workout(1), "user_id")])
    with pytest.raises(Exception, match="required column user_id"):
        landing.read_landing(spark, str(tmp_path), "workouts").collect()


# --- tables ------------------------------------------------------------------------------------


def table_rows(spark, path):
    return rows(read_entity(spark, path, WORKOUTS).select("workout_id", "synced_at", "calories", "dt"))


def valid(spark, records):
    return normalize_workouts(texts(spark, records), "app").select("record.*")


def test_merge_moves_days_and_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert table_rows(spark, path) == []
    day1, day2 = T0, T0 + timedelta(days=1)
    merge_table(spark, path, valid(spark, [workout(1), workout(2), workout(3, start=day2)]), WORKOUTS)
    untouched = {p.name for p in (tmp_path / "t").rglob("dt=2024-03-02/*.parquet")}
    # w-1 moves to a third day; w-2 is stale; w-3 has an equal version and another payload.
    news = [
        workout(1, synced_at=iso(day1 + timedelta(days=3)), calories=1),
        workout(2, synced_at=iso(day1), calories=2),
        workout(3, start=day2, calories=3),
    ]
    merge_table(spark, path, valid(spark, news), WORKOUTS)
    hour = timedelta(hours=1)
    after = [
        ("w-1", day1 + timedelta(days=3), 1.0, "2024-03-04"),
        ("w-2", day1 + hour, 300.5, "2024-03-01"),
        ("w-3", day2 + hour, 300.5, "2024-03-02"),
    ]
    assert table_rows(spark, path) == after
    assert {p.name for p in (tmp_path / "t").rglob("dt=2024-03-02/*.parquet")} == untouched
    merge_table(spark, path, valid(spark, news), WORKOUTS)
    assert table_rows(spark, path) == after
    # The last row of a day leaves: the day is gone.
    merge_table(spark, path, valid(spark, [workout(3, synced_at=iso(day2 + timedelta(days=5)))]), WORKOUTS)
    assert [r[3] for r in table_rows(spark, path)] == ["2024-03-04", "2024-03-01", "2024-03-07"]


def test_tables_are_replaced_whole_or_in_part(spark, tmp_path):
    path = str(tmp_path / "t")
    parts = lambda df, n: df.select("id", (F.col("id") % n).alias("p"))
    replace_table(parts(spark.range(9), 3), path, ["p"])
    kept = {p.name for p in (tmp_path / "t").rglob("p=0/*.parquet")}
    # The job reads the partition that it rewrites; the other one that it touches has no row left.
    again = read_table(spark, path).where("p = 1 and id > 1")
    assert rows(replace_partitions(again, path, ["p"], ["1", "2"]).select("id")) == [(0,), (3,), (4,), (6,), (7,)]
    assert {p.name for p in (tmp_path / "t").rglob("p=0/*.parquet")} == kept
    assert rows(replace_table(spark.range(2), path)) == [(0,), (1,)]
    assert read_table(spark, str(tmp_path / "none"), WORKOUTS.schema).isEmpty()


def test_a_merge_writes_what_it_changed(spark, tmp_path):
    path, feed = str(tmp_path / "t"), str(tmp_path / "feed")
    merge_table(spark, path, valid(spark, [workout(1), workout(2)]), WORKOUTS, f"{feed}/a")
    news = valid(spark, [workout(1, synced_at=iso(T0 + timedelta(days=3)), calories=1), workout(2, synced_at=iso(T0)), workout(3)])
    for _ in range(2):  # the second time nothing is newer, and the feed stays
        merge_table(spark, path, news, WORKOUTS, f"{feed}/b")
    seen = {r: rows(spark.read.parquet(f"{feed}/{r}").select("_change", "workout_id", "calories")) for r in "ab"}
    assert seen["a"] == [("after", "w-1", 300.5), ("after", "w-2", 300.5)]
    assert seen["b"] == [("after", "w-1", 1.0), ("after", "w-3", 300.5), ("before", "w-1", 300.5)]


def test_a_merge_looks_for_its_keys_once(spark, tmp_path, monkeypatch):
    """What the batch changes is kept for the days, the feed and the rewrite, and let go afterwards."""
    kept, apply = [], tables._apply

    def watched(*args):
        kept.append(args[3])
        apply(*args)
        assert args[3].storageLevel.useDisk

    monkeypatch.setattr(tables, "_apply", watched)
    one = lambda i, hour: (f"u{i}", "app", None, None, None, None, None, None, datetime(2024, 3, 1, hour))
    spec = ENTITIES["users"]
    for run, sent in enumerate([[one(1, 1), one(2, 1)], [one(1, 2), one(2, 0), one(3, 2)]]):
        merge_table(spark, f"{tmp_path}/t", spark.createDataFrame(sent, spec.schema), spec, f"{tmp_path}/feed/{run}")
    images = spark.read.parquet(f"{tmp_path}/feed/1").select("user_id", "_change").collect()
    assert sorted(map(tuple, images)) == [("u1", "after"), ("u1", "before"), ("u3", "after")]
    assert len(kept) == 2 and not any(newer.storageLevel.useDisk for newer in kept)


def test_equal_versions_go_by_the_other_columns(spark, tmp_path):
    same = [workout(1, calories=c) for c in (5, 9, 7)]
    for order in (same, same[::-1]):
        path = str(tmp_path / f"t{order[0]['calories']}")
        merge_table(spark, path, valid(spark, order), WORKOUTS)
        assert [r[2] for r in table_rows(spark, path)] == [9.0]


def test_seed_file(spark, tmp_path):
    lines = ["workout_type,category,is_cardio,met_value"] + [f"{a},{b},{str(c).lower()},{d}" for a, b, c, d in EXERCISE_TYPES]
    (tmp_path / "seed.csv").write_text("\n".join(lines))
    assert rows(read_seed(spark, str(tmp_path / "seed.csv"))) == rows(exercise_types(spark))


# --- streaming ---------------------------------------------------------------------------------


def test_stream_equals_batch_and_takes_files_once(spark, tmp_path):
    raw = tmp_path / "raw"
    first = [workout(1), workout(2), workout(1, synced_at=iso(T0 + timedelta(hours=5)), calories=9), "broken"]
    second = [workout(2, synced_at=iso(T0)), workout(3), workout(4, user_id=None)]
    put(raw, "a.jsonl", first)
    put(raw, "b.jsonl", second[:1])
    base, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def run():
        done = stream_ingest(spark, str(raw), base, table, "workouts", "app", now(), str(tmp_path / "state"), 1)
        done.awaitTermination()
        return done

    run()
    put(raw, "c.jsonl", second[1:])
    run()
    streamed = table_rows(spark, table)
    merge_table(spark, str(tmp_path / "batch"), valid(spark, first + second), WORKOUTS)
    assert streamed == table_rows(spark, str(tmp_path / "batch")) and len(streamed) == 3
    assert landing.read_rejects(spark, base, "workouts").count() == 2
    assert run().lastProgress is None or run().lastProgress["numInputRows"] == 0
    assert table_rows(spark, table) == streamed


# --- full run ----------------------------------------------------------------------------------


def raw_records(tmp_path):
    days = [T0 - timedelta(days=i) for i in range(10, -1, -1)]
    workouts = [workout(i, "u-1", d, minutes=20 + i) for i, d in enumerate(days)]
    workouts += [workout(100, "u-2", days[-1], distance_meters=9000.0), workout(101, "u-2", days[-1], workout_type="yoga", samples=[])]
    workouts += [workout(0, "u-1", days[0], synced_at=iso(T0 + timedelta(hours=2)), calories=1.0)]  # delivered again
    workouts += [without(workout(200), "device_id"), "broken"]
    return {
        "synthetic": {
            "users": put(tmp_path / "raw/users", "1.jsonl", [user("u-1", T0 - timedelta(days=20)), user("u-2", T0 - timedelta(hours=1))]),
            "workouts": put(tmp_path / "raw/workouts", "1.jsonl", workouts),
            "friendships": put(tmp_path / "raw/friends", "1.jsonl", friends("u-1", "u-2")),
        }
    }


MARTS = ["dim_user", "fact_workout", "fact_daily_metrics", "leaderboard", "personal_records"]


def test_full_run_and_rerun(spark, tmp_path):
    paths = raw_records(tmp_path)
    root = str(tmp_path / "wh")
    tables = pl.run_pipeline(spark, root, paths, NOW)
    first = {n: rows(tables[n]) for n in MARTS}
    assert len(first["fact_workout"]) == 13
    fact = {r.workout_id: r for r in tables["fact_workout"].collect()}
    assert fact["w-0"].calories == 1.0  # the later delivery won
    assert fact["w-101"].exercise_type_sk is None and fact["w-101"].sample_count is None
    assert fact["w-0"].user_sk is not None and fact["w-0"].workout_date_sk is not None
    assert fact["w-0"].avg_heart_rate_bpm == 140.0
    daily = tables["fact_daily_metrics"]
    n_days = (NOW.date() - (T0 - timedelta(days=10)).date()).days + 1
    assert daily.count() == 2 * n_days
    board = {(r.user_id, r.member_user_id): r for r in tables["leaderboard"].collect()}
    assert len(board) == 4
    assert board["u-1", "u-1"].rank_by_distance == 1 and board["u-1", "u-2"].rank_by_distance == 2
    best = {(r.user_id, r.workout_type): r for r in tables["personal_records"].collect()}
    assert best["u-1", "run"].longest_duration_minutes == 30
    wh = pl.Warehouse(root)
    marks = read_table(spark, wh.marks, MARKS)
    assert {(r.entity, r.mark) for r in marks.collect()} == {
        ("users", T0 - timedelta(hours=1)), ("workouts", T0 + timedelta(hours=2)), ("friendships", T0),
    }

    # Nothing new: the same marts, and no record is landed again.
    landed = landing.read_landing(spark, wh.landing, "workouts").count()
    again = pl.run_pipeline(spark, root, paths, NOW)
    assert {n: rows(again[n]) for n in MARTS} == first
    assert landing.read_landing(spark, wh.landing, "workouts").count() == landed

    # A user moves on: a new version, and later workouts attach to it.
    put(tmp_path / "raw/users", "2.jsonl", [user("u-1", T0 + timedelta(hours=3), weight_kg=65)])
    put(tmp_path / "raw/workouts", "2.jsonl", [workout(300, "u-1", T0 + timedelta(hours=3))])
    tables = pl.run_pipeline(spark, root, paths, NOW)
    versions = {(r.valid_from, r.is_current): r.user_sk for r in tables["dim_user"].where("user_id = 'u-1'").collect()}
    assert len(versions) == 2
    fact = {r.workout_id: r for r in tables["fact_workout"].collect()}
    assert fact["w-300"].user_sk == versions[T0 + timedelta(hours=3), True]
    assert fact["w-5"].user_sk == versions[T0 - timedelta(days=20), False]


def test_an_incremental_run_gives_the_same_marts(spark, tmp_path):
    paths = raw_records(tmp_path)
    roots = {kept: str(tmp_path / f"wh-{kept}") for kept in (True, False)}

    def both(now):
        names = ["fact_daily_metrics", "leaderboard", "personal_records"]
        tables = {kept: pl.run_pipeline(spark, root, paths, now, check=False, incremental=kept) for kept, root in roots.items()}
        for n in names:
            columns = [c for c in tables[True][n].columns if c != "month"]
            assert rows(tables[True][n].select(*columns)) == rows(tables[False][n].select(*columns)), n

    both(NOW)
    # A late workout, a correction that lowers a record, a new user's profile, and another day.
    late = [workout(400, "u-2", T0 - timedelta(days=6)), workout(10, "u-1", T0, minutes=5, synced_at=iso(T0 + timedelta(hours=9)))]
    put(tmp_path / "raw/workouts", "3.jsonl", late)
    put(tmp_path / "raw/users", "3.jsonl", [user("u-3", T0)])
    both(NOW + timedelta(days=1))
    both(NOW + timedelta(days=1))


def test_backfill_replays_and_leaves_the_mark(spark, tmp_path):
    edge = datetime(2024, 3, 3)  # midnight after the last day comes in, midnight of the first does not
    records = [workout(i, synced_at=iso(ts)) for i, ts in enumerate([datetime(2024, 3, 1), datetime(2024, 3, 1, 1), datetime(2024, 3, 2, 5), edge, edge + timedelta(seconds=1)])]
    path = put(tmp_path / "raw", "1.jsonl", records)
    wh = pl.Warehouse(str(tmp_path / "wh"))
    for _ in range(2):
        pl.backfill(spark, wh, {"workouts": path}, "synthetic", date(2024, 3, 1), date(2024, 3, 2), NOW)
    assert [r[0] for r in table_rows(spark, wh.raw("workouts"))] == ["w-1", "w-2", "w-3"]
    assert landing.read_landing(spark, wh.landing, "workouts").count() == 3
    assert read_table(spark, wh.marks, MARKS).isEmpty()
    with pytest.raises(ValueError):
        pl.ingest(spark, wh, path, "workouts", "synthetic", NOW, until=edge)


def test_live_runs_reject_an_undated_record_once(spark, tmp_path):
    wh = pl.Warehouse(str(tmp_path / "wh"))
    path = put(tmp_path / "raw", "1.jsonl", [workout(1), "broken"])
    for _ in range(3):
        pl.ingest(spark, wh, path, "workouts", "synthetic", NOW)
    assert landing.read_rejects(spark, wh.landing, "workouts").count() == 1


def test_a_run_without_users(spark, tmp_path):
    paths = raw_records(tmp_path)
    del paths["synthetic"]["users"], paths["synthetic"]["friendships"]
    tables = pl.run_pipeline(spark, str(tmp_path / "wh"), paths, NOW, check=False)
    assert tables["fact_workout"].count() == 13 and tables["fact_daily_metrics"].isEmpty()


def test_dry_run_changes_nothing(spark, tmp_path):
    wh = pl.Warehouse(str(tmp_path / "wh"))
    path = put(tmp_path / "raw", "1.jsonl", [workout(1)])
    pl.ingest(spark, wh, path, "workouts", "synthetic", NOW)
    assert pl.load(spark, wh, "workouts", "synthetic", dry_run=True).count() == 1
    assert table_rows(spark, wh.raw("workouts")) == []


def test_failed_checks_stop_the_run(spark, tmp_path):
    paths = raw_records(tmp_path)
    put(tmp_path / "raw/workouts", "9.jsonl", [workout(900, minutes=60 * 30)])
    with pytest.raises(ChecksFailed, match="duration_minutes"):
        pl.run_pipeline(spark, str(tmp_path / "wh"), paths, NOW)


def test_one_user_from_two_sources_stops_the_snapshot(spark, tmp_path):
    wh = pl.Warehouse(str(tmp_path / "wh"))
    two = spark.createDataFrame([("u", "a", T0), ("u", "b", T0)], "user_id string, source_system string, updated_at timestamp")
    with pytest.raises(ChecksFailed, match="not unique"):
        pl.take_snapshot(spark, wh, two)
