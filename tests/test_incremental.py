"""Late dedupe, one-pass snapshots, sparse rolling sums, windows over landed days, observed batches, keyed streams."""

from __future__ import annotations

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from records import T0, iso, texts, workout

from activity_engine.operators.dedupe import latest_per_key, latest_per_key_late
from activity_engine.operators.normalize import normalize_workouts, valid_rows
from activity_engine.operators.rolling import rolling_at, sparse_rolling_sums
from activity_engine.operators.scd2 import first_snapshot, snapshot_timestamp, snapshots_at
from activity_engine.schemas import ENTITIES
from activity_engine.sources import landing
from activity_engine.sources.tables import merge_table, read_entity
from activity_engine.streaming.ingest import stream_newest

WORKOUTS = ENTITIES["workouts"]


def NOW():
    return F.lit(datetime(2024, 3, 2)).cast("timestamp")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(folder)


@pytest.mark.parametrize("sent", [0, 1000])
def test_late_dedupe_keeps_the_same_rows(spark, tmp_path, sent):
    rng = random.Random(4)
    made = [(rng.choice(["a", "b", None]) if i % 9 == 0 else f"k{rng.randrange(60)}", rng.randrange(5), i, ["wide"] * 5) for i in range(300)]
    df = spark.createDataFrame(made, "k string, v int, t int, samples array<string>")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    late = latest_per_key_late(scan, ["k"], "v", ["t"], broadcast_rows=sent)
    assert late.columns == scan.columns and rows(late) == rows(latest_per_key(df, ["k"], "v", ["t"]))
    if sent:
        again = latest_per_key_late(scan, ["k"], "v", ["t"], broadcast_rows=sent)
        plan = again._jdf.queryExecution().executedPlan().toString()  # not run yet, so one plan only
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert moved and "samples" not in plan[plan.index("Exchange hashpartitioning") :]
    empty = spark.read.schema(scan.schema).parquet(str(tmp_path / "t")).where("false")
    assert latest_per_key_late(empty, ["k"], "v").count() == 0


def test_late_dedupe_of_equal_rows_keeps_one(spark, tmp_path):
    spark.createDataFrame([("a", 1)] * 5 + [("b", None)] * 2, "k string, v int").write.parquet(str(tmp_path / "t"))
    assert rows(latest_per_key_late(spark.read.parquet(str(tmp_path / "t")), ["k"], "v")) == [("a", 1), ("b", None)]


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_at_equals_a_run_at_each_moment(spark, seed):
    rng = random.Random(seed)
    log = {(rng.choice("abc"), rng.randrange(60)) for _ in range(40)} | {("hot", n) for n in range(0, 60, 2)}
    df = spark.createDataFrame([(k, T0 + timedelta(days=n), n) for k, n in sorted(log)], "k string, at timestamp, n int")
    moments = sorted({T0 + timedelta(days=rng.randrange(60), hours=rng.choice([0, 0, 5])) for _ in range(rng.randrange(1, 9))})
    history = None
    for m in moments:
        seen = latest_per_key(df.where(F.col("at") <= F.lit(m).cast("timestamp")), ["k"], "at")
        history = first_snapshot(seen, "at") if history is None else snapshot_timestamp(history, seen, "k", "at")
    for hot_rows in (10**6, 8):
        assert rows(snapshots_at(df, ["k"], "at", moments, hot_rows)) == rows(history)
    plan = snapshots_at(df, ["k"], "at", moments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_sparse_rolling_sums_match_every_day(spark):
    rng = random.Random(3)
    days = {(k, d): (rng.randrange(50), rng.random()) for k in "ab" for d in rng.sample(range(90), 25)}
    df = spark.createDataFrame([(k, date(2024, 1, 1) + timedelta(days=d), n, x) for (k, d), (n, x) in days.items()], "k string, day date, n bigint, x double")
    sparse = sparse_rolling_sums(df, "k", "day", {"n7": "n", "x7": "x"})
    found = {(r.k, (r.day - date(2024, 1, 1)).days): (r.n7, r.x7) for r in sparse.select("k", F.explode(F.sequence("from_day", "to_day")).alias("day"), "n7", "x7").collect()}
    for k in "ab":
        for d in range(110):
            held = [days[k, e] for e in range(d - 6, d + 1) if (k, e) in days]
            assert ((k, d) in found) == bool(held)
            if held:
                assert found[k, d][0] == sum(n for n, _ in held) and found[k, d][1] == pytest.approx(sum(x for _, x in held))
    at = rolling_at(sparse, F.lit(date(2024, 2, 1)))
    assert {r.k: r.n7 for r in at.collect()} == {k: v[0] for (k, d), v in found.items() if d == 31}
    assert sparse_rolling_sums(df.where("false"), "k", "day", {"n7": "n"}).count() == 0


def test_a_window_reads_only_its_days(spark, tmp_path):
    base = str(tmp_path)
    made = [workout(i, start=T0 + timedelta(hours=9 * i)) for i in range(20)]
    seen = landing.land(normalize_workouts(texts(spark, [*made, {"workout_id": "w-x"}]), "app"), base, "workouts", "app", NOW(), "r")
    assert (seen.total, seen.valid, seen.rejected) == (21, 20, 1)
    everything = landing.read_landing(spark, base, "workouts", "app")
    assert (seen.first, seen.mark) == tuple(everything.agg(F.min("synced_at"), F.max("synced_at")).first())
    since, until = T0 + timedelta(days=2, hours=3), T0 + timedelta(days=4)
    window = landing.read_window(spark, base, "workouts", "app", since, until)
    assert rows(window) == rows(everything.where((F.col("synced_at") > F.lit(since)) & (F.col("synced_at") <= F.lit(until))))
    scan = next(x for x in window._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert "dt" in scan.split("PartitionFilters: [")[1].split("]")[0]
    read = {r[0].split("dt=")[1][:10] for r in window.select("*", F.input_file_name().alias("f")).select("f").distinct().collect()}
    assert read <= {(T0 + timedelta(days=n)).strftime("%Y-%m-%d") for n in (2, 3, 4)}
    assert landing.land(normalize_workouts(texts(spark, []), "app"), base, "workouts", "app", NOW(), "none").mark is None


def test_old_raw_files_are_not_opened(spark, tmp_path):
    put(tmp_path / "raw", "old.jsonl", [workout(1)])
    put(tmp_path / "raw", "new.jsonl", [workout(2), workout(3)])
    os.utime(tmp_path / "raw/old.jsonl", (1_700_000_000, 1_700_000_000))
    path = str(tmp_path / "raw")
    assert landing.read_raw(spark, path).count() == 3
    assert landing.read_raw(spark, path, datetime(2023, 12, 1)).count() == 2
    assert landing.read_raw(spark, path, datetime(2100, 1, 1)).count() == 0


def test_the_stream_state_gives_the_newest_of_all_batches(spark, tmp_path):
    rng = random.Random(7)
    raw, table, records = tmp_path / "raw", str(tmp_path / "table"), []
    for batch in range(3):
        made = [workout(rng.randrange(6), synced_at=iso(T0 + timedelta(hours=rng.randrange(40))), calories=float(len(records) + i)) for i in range(8)]
        records += made
        put(raw, f"{batch}-a.jsonl", made[:4])
        put(raw, f"{batch}-b.jsonl", made[4:])
        for _ in range(2):  # a restart without new files changes nothing
            stream_newest(spark, str(raw), table, "workouts", "app", NOW(), str(tmp_path / "state"), 1, ["calories"]).awaitTermination()
        whole = valid_rows(normalize_workouts(texts(spark, records), "app"))
        newest = latest_per_key(whole.select(*WORKOUTS.columns), WORKOUTS.keys, WORKOUTS.version, ["calories"])
        merged = read_entity(spark, table, WORKOUTS)
        assert rows(merged.select("workout_id", "synced_at")) == rows(newest.select("workout_id", "synced_at"))
    merge_table(spark, str(tmp_path / "batch"), whole.select(*WORKOUTS.columns), WORKOUTS)
    assert rows(merged.select("workout_id", "dt")) == rows(read_entity(spark, str(tmp_path / "batch"), WORKOUTS).select("workout_id", "dt"))
