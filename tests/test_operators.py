"""Operators on small inputs, against brute force or worked-out results."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_engine.functions import scalars as sc
from activity_engine.functions.nested import sample_stats, zip_streams
from activity_engine.operators import marks as mk
from activity_engine.operators import quality as qa
from activity_engine.operators.asof import asof_validity_join
from activity_engine.operators.dedupe import latest_per_key
from activity_engine.operators.grid import densify
from activity_engine.operators.hot import CHUNK, assign_chunks, hot_keys
from activity_engine.operators.ranking import best_per_group, rank_desc
from activity_engine.operators.rolling import days_since_active, period_over_period, rolling_avg
from activity_engine.operators.scd2 import first_snapshot, scd2_history, snapshot_timestamp
from activity_engine.operators.upsert import upsert_newest

T0 = datetime(2024, 1, 1)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def at(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def planned(df) -> str:
    """The physical plan before it is run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def log(spark, data):
    return spark.createDataFrame(data, "k string, v timestamp, x int")


# --- upsert ------------------------------------------------------------------------------------

versions = st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 6), st.integers(0, 99)), max_size=20)


def one_per_key(data):
    return list({k: (k, at(v), x) for k, v, x in data}.values())


@FEW
@given(versions, versions)
def test_upsert_matches_brute_force_and_is_idempotent(spark, target, source):
    target, source = one_per_key(target), [(k, at(v), x) for k, v, x in source]
    expected = {k: (k, v, x) for k, v, x in target}
    for k, v, x in sorted(source, key=lambda r: (r[1], r[2])):
        old = expected.get(k)
        if old is None or v > old[1] or (v == old[1] and old not in target):
            expected[k] = (k, v, x)
    t, s = log(spark, target), log(spark, source)
    once = upsert_newest(t, s, ["k"], "v", ["x"])
    assert rows(once) == sorted(expected.values(), key=repr)
    assert rows(upsert_newest(once, s, ["k"], "v", ["x"])) == rows(once)


def test_upsert_keeps_target_on_equal_version(spark):
    t, s = log(spark, [("a", at(1), 1), ("b", at(1), 1)]), log(spark, [("a", at(1), 9), ("b", at(2), 9), ("c", at(0), 9)])
    assert rows(upsert_newest(t, s, ["k"], "v")) == [("a", at(1), 1), ("b", at(2), 9), ("c", at(0), 9)]


def test_upsert_batches_in_any_order(spark):
    batches = [log(spark, [("a", at(i), i), ("b", at(10 - i), i)]) for i in range(4)]
    results = []
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        table = log(spark, [])
        for i in order:
            table = upsert_newest(table, batches[i], ["k"], "v")
        results.append(rows(table))
    assert results[0] == results[1] == [("a", at(3), 3), ("b", at(10), 0)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = latest_per_key(log(spark, [("a", at(1), 1), ("a", at(2), 2)]), ["k"], "v", ["x"])
    assert rows(df) == [("a", at(2), 2)]
    plan = planned(df)
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


# --- type-2 history ----------------------------------------------------------------------------


def change_log(keys=5, per_key=12, hot=150, seed=1):
    rng = random.Random(seed)
    data = {("hot", at(rng.randrange(10_000) / 7)) for _ in range(hot)}
    for k in range(keys):
        data |= {(f"k{k}", at(rng.randrange(10_000) / 7)) for _ in range(per_key)}
    return [(k, v, i) for i, (k, v) in enumerate(sorted(data))]


@pytest.mark.parametrize("hot_rows", [3, 20, 1_000_000])
def test_history_is_contiguous_whatever_the_split(spark, hot_rows):
    data = change_log()
    history = scd2_history(log(spark, data), ["k"], "v", hot_rows=hot_rows)
    by_key: dict[str, list] = {}
    for k, v, x in sorted(data):
        by_key.setdefault(k, []).append((v, x))
    expected = [
        (k, v, x, v, versions[i + 1][0] if i + 1 < len(versions) else None)
        for k, versions in by_key.items()
        for i, (v, x) in enumerate(versions)
    ]
    assert rows(history) == sorted(expected, key=repr)


def test_snapshots_fold(spark):
    runs = [
        [("a", at(1), 1), ("b", at(1), 1)],
        [("a", at(5), 2), ("b", at(1), 7), ("c", at(3), 1)],  # b has not moved, so its change is not seen
        [("a", at(4), 3), ("c", at(9), 2)],  # a went back in time, b is gone
    ]
    history = first_snapshot(log(spark, runs[0]), "v")
    for run in runs[1:]:
        history = snapshot_timestamp(history, log(spark, run), "k", "v")
    assert rows(history.select("k", "x", "valid_from", "valid_to")) == [
        ("a", 1, at(1), at(5)),
        ("a", 2, at(5), None),
        ("b", 1, at(1), None),
        ("c", 1, at(3), at(9)),
        ("c", 2, at(9), None),
    ]


# --- as-of join --------------------------------------------------------------------------------


def brute_asof(facts, dims):
    out = []
    for f in facts:
        hits = [d for d in dims if f[0] is not None and f[1] is not None and d[0] == f[0] and d[1] <= f[1] and (d[2] is None or f[1] < d[2])]
        assert len(hits) <= 1
        out.append((*f, *(hits[0][1:] if hits else (None, None, None))))
    return sorted(out, key=repr)


def asof_input(seed):
    rng = random.Random(seed)
    dims = []
    for k in ["hot", "cold", "other"]:
        start = 0.0
        for n in range(60 if k == "hot" else 3):
            start += rng.choice([1, 2, 7])
            end = start + rng.choice([0.5, 1])  # intervals with gaps between them
            dims.append((k, at(start), at(end), n))
        dims.append((k, at(1000), None, 99))
    facts = [(rng.choice(["hot"] * 5 + ["cold", "missing", None]), at(rng.randrange(4000) / 4), i) for i in range(400)]
    facts += [("hot", None, -1), ("hot", dims[5][1], -2), ("hot", dims[5][2], -3), ("cold", at(2000), -4)]
    return facts, dims


@pytest.mark.parametrize("hot_rows", [5, 40, 1_000_000])
def test_asof_join_matches_brute_force(spark, hot_rows):
    facts, dims = asof_input(hot_rows)
    f = spark.createDataFrame(facts, "k string, ts timestamp, id int")
    d = spark.createDataFrame(dims, "k string, valid_from timestamp, valid_to timestamp, n int")
    expected = brute_asof(facts, dims)
    assert rows(asof_validity_join(f, d, ["k"], "ts", hot_rows=hot_rows)) == expected
    matched = [r for r in expected if r[-1] is not None]
    assert rows(asof_validity_join(f, d, ["k"], "ts", how="inner", hot_rows=hot_rows)) == matched


def test_chunks_are_even_where_positions_crowd(spark):
    # One outlier far away, so that equal widths would leave nearly all rows in the first chunk.
    data = [("k", at(i / 60), i) for i in range(500)] + [("k", at(1_000_000), 500)]
    borders = hot_keys(log(spark, data), ["k"], "v", 50)
    assert hot_keys(log(spark, data), ["k"], "v", 501) is None
    chunked = assign_chunks(log(spark, data), borders, ["k"], "v")
    sizes = [r["count"] for r in chunked.groupBy(CHUNK).count().collect()]
    assert sum(sizes) == 501 and max(sizes) <= 60
    assert [r.x for r in chunked.orderBy(CHUNK, "v").collect()] == list(range(501))
    history = scd2_history(log(spark, data), ["k"], "v", hot_rows=50)
    assert history.where("valid_to is null").count() == 1
    assert history.where("timestampdiff(MINUTE, v, valid_to) = 1").count() == 499


def test_asof_join_broadcasts_only_a_small_dimension(spark):
    facts, dims = asof_input(3)
    f = spark.createDataFrame(facts, "k string, ts timestamp, id int")
    d = spark.createDataFrame(dims, "k string, valid_from timestamp, valid_to timestamp, n int")
    small = asof_validity_join(f, d, ["k"], "ts", broadcast_rows=1000)
    large = asof_validity_join(f, d, ["k"], "ts", broadcast_rows=10)
    assert "BroadcastHashJoin" in planned(small)
    assert "Join" not in planned(large)
    assert rows(small) == rows(large) == brute_asof(facts, dims)


@pytest.mark.parametrize("hot_rows", [2, 7, 1_000_000])
def test_null_keys_and_versions_do_not_depend_on_the_split(spark, hot_rows):
    data = change_log(keys=2, hot=40) + [(None, at(n), 1000 + n) for n in range(9)] + [("k0", None, -1)]
    history = scd2_history(log(spark, data), ["k"], "v", hot_rows=hot_rows)
    by_key: dict = {}
    for k, v, x in sorted(data, key=lambda r: (r[0] or "", r[1] is not None, r[1] or at(0))):
        by_key.setdefault(k, []).append((v, x))
    expected = [
        (k, v, x, v, versions[i + 1][0] if i + 1 < len(versions) else None)
        for k, versions in by_key.items()
        for i, (v, x) in enumerate(versions)
    ]
    assert rows(history) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", [2, 7, 1_000_000])
def test_null_groups_and_measures_are_ranked(spark, hot_rows):
    data = [("g", 5.0, 1), ("g", None, 2), ("g", None, 3), (None, 1.0, 4), (None, 1.0, 5), (None, None, 6), (None, 9.0, 7)]
    data += [("g", float(i % 6), 10 + i) for i in range(20)]
    above = lambda a, b: a is not None and (b is None or a > b)
    expected = [(g, m, i, 1 + sum(1 for h, o, _ in data if h == g and above(o, m))) for g, m, i in data]
    df = spark.createDataFrame(data, "g string, m double, id int")
    assert rows(rank_desc(df, ["g"], "m", "r", hot_rows)) == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_overlapping_versions_give_one_match_either_way(spark, how):
    dims = [("a", at(0), at(10), 1), ("a", at(5), at(7), 2), ("a", at(5), None, 3), ("a", at(8), at(9), 4), (None, at(0), None, 5)]
    facts = [("a", at(h + 0.5), h) for h in range(12)] + [(None, at(1), 99), ("a", None, 98)]
    f = spark.createDataFrame(facts, "k string, ts timestamp, id int")
    d = spark.createDataFrame(dims, "k string, valid_from timestamp, valid_to timestamp, n int")
    # Of the two that begin at 5, the one with an end is greater (NULL is least), and it decides until 8.
    match = {**{h: 1 for h in range(5)}, 5: 2, 6: 2, 8: 4}
    expected = sorted((i, match.get(i)) for _, _, i in facts if how == "left" or i in match)
    for settings in ({"broadcast_rows": 1000}, {"hot_rows": 3}, {}):
        found = asof_validity_join(f, d, ["k"], "ts", how=how, **settings)
        assert sorted((r.id, r.n) for r in found.collect()) == expected, settings


# --- grid and windows --------------------------------------------------------------------------


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def test_dense_grid_and_metrics(spark):
    active = {("a", 0): 10, ("a", 1): 20, ("a", 9): 30, ("b", 14): 5, ("gone", 3): 1, ("a", 40): 7}
    facts = spark.createDataFrame([(u, day(n), 1, m) for (u, n), m in active.items()], "u string, d date, n bigint, m bigint")
    users = spark.createDataFrame([("a", "A"), ("b", "B"), ("idle", "I")], "u string, name string")
    dense = densify(facts, users, "u", F.lit(day(0)), F.lit(day(14)), {"n": 0, "m": 0}, day="d")
    assert dense.columns == ["u", "name", "d", "n", "m"]
    expected = [
        (u, u[0].upper(), day(i), int((u, i) in active), active.get((u, i), 0)) for u in ("a", "b", "idle") for i in range(15)
    ]
    assert rows(dense) == sorted(expected, key=repr)

    metrics = dense.select(
        "u", "d", rolling_avg("m", "u", "d").alias("avg"), period_over_period("m", "u", "d").alias("wow"),
        days_since_active("n", "u", "d").alias("gap"),
    )
    got = {(r.u, r.d): r for r in metrics.collect()}
    assert got["a", day(1)].avg == 15 and got["a", day(6)].avg == pytest.approx(30 / 7)
    assert got["a", day(6)].wow is None  # no earlier week yet
    assert got["a", day(7)].wow == pytest.approx((20 - 10) / 10)
    assert got["a", day(9)].wow == pytest.approx((30 - 30) / 30)
    assert got["idle", day(14)].wow is None  # an earlier week of zero
    assert [got["a", day(i)].gap for i in (0, 1, 5, 9)] == [None, 1, None, 8]
    plan = planned(metrics)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("hot_rows", [2, 25, 1_000_000])
def test_rank_shares_ties_and_leaves_gaps(spark, hot_rows):
    rng = random.Random(hot_rows)
    data = [("g" if i % 4 else "h", float(rng.choice([0, 0, 0, -3, 5, 7.5, i])), i) for i in range(300)]
    expected = [(g, m, i, 1 + sum(1 for h, o, _ in data if h == g and o > m)) for g, m, i in data]
    df = spark.createDataFrame(data, "g string, m double, id int")
    assert rows(rank_desc(df, ["g"], "m", "r", hot_rows)) == sorted(expected, key=repr)


def test_best_ratio_ignores_non_positive(spark):
    df = spark.createDataFrame([("u", -5.0, 10), ("u", 0.0, 10), ("u", 2000.0, 10), ("v", 0.0, 3)], "u string, m double, t bigint")
    pace = F.when(F.col("m") > 0, F.col("t") / (F.col("m") / 1000.0))
    assert rows(best_per_group(df, ["u"], {"far": "m"}, {"pace": pace})) == [("u", 2000.0, 5.0), ("v", 0.0, None)]


# --- marks -------------------------------------------------------------------------------------


def test_window_scan_edges(spark):
    df = log(spark, [("a", at(i), i) for i in range(5)])
    ids = lambda *b: [r[2] for r in rows(mk.window_scan(df, "v", *b))]
    assert ids(at(1), at(3)) == [2, 3]
    assert ids(None, at(1)) == [0, 1] and ids(at(3), None) == [4] and ids() == [0, 1, 2, 3, 4]
    assert ids("2024-01-01T01:00:00", "2024-01-01T03:00:00+00:00") == [2, 3]


def test_marks_only_move_forward(spark):
    marks = spark.createDataFrame([("s", "users", at(5)), ("s", "workouts", at(5))], "source string, entity string, mark timestamp")
    seen = spark.createDataFrame(
        [("s", "users", at(3)), ("s", "workouts", at(8)), ("t", "users", at(1)), ("t", "workouts", None)], marks.schema
    )
    moved = mk.advance_mark(marks, seen)
    assert rows(moved) == [("s", "users", at(5)), ("s", "workouts", at(8)), ("t", "users", at(1))]
    assert mk.read_mark(moved, "s", "workouts") == at(8) and mk.read_mark(moved, "t", "workouts") is None


def test_backfill_is_one_window():
    assert mk.backfill_bounds(date(2024, 1, 1), date(2024, 1, 3)) == (datetime(2024, 1, 1), datetime(2024, 1, 4))


# --- quality -----------------------------------------------------------------------------------


def test_freshness_is_strict_on_whole_hours(spark):
    now = T0 + timedelta(days=10)
    synced = {"pass": timedelta(hours=48, minutes=59), "fail": timedelta(hours=49), "new": timedelta(0)}
    df = spark.createDataFrame([(k, now - age, 0) for k, age in synced.items()], "k string, v timestamp, x int")
    assert [(r.k, r.hours_since_sync) for r in qa.stale_keys(df, "k", "v", F.lit(now)).collect()] == [("fail", 49)]


def volume(spark, counts, today, **kw):
    data = [("k", datetime(2024, 1, d, 12), 0) for d, n in counts.items() for _ in range(n)]
    return qa.volume_anomaly(log(spark, data), "v", F.lit(date(2024, 1, today)), **kw).collect()


def test_volume(spark):
    assert volume(spark, {18: 9, 19: 9, 20: 1}, 20) == []  # two trailing days are too few
    assert volume(spark, {17: 10, 18: 10, 19: 10, 20: 5}, 20) == []  # exactly half
    (low,) = volume(spark, {1: 900, 17: 10, 18: 10, 19: 12, 20: 4}, 20)
    assert low.asDict() == {
        "date": date(2024, 1, 20), "today_count": 4, "trailing_avg": 10.7, "trailing_days": 3, "ratio": 0.375,
    }
    assert volume(spark, {17: 10, 18: 10, 19: 10}, 20) == []  # the latest day present is compared
    (out,) = volume(spark, {17: 10, 18: 10, 19: 10}, 20, dense=True)
    assert (out.today_count, out.trailing_days) == (0, 8)
    assert volume(spark, {}, 20) == []


def test_duration_rule(spark):
    df = spark.createDataFrame([(1440,), (1441,), (None,)], "m bigint")
    assert rows(qa.duration_under_hours(df, "m")) == [(1441,)]


def test_anomalies_and_symmetry(spark):
    w = spark.createDataFrame(
        [(1, at(0), at(24), 1.0), (2, at(0), at(25), 1.0), (3, at(0), at(1), -1.0), (4, at(0), at(1), None)],
        "id int, start_time timestamp, end_time timestamp, distance_meters double",
    )
    assert [(r.id, r.reason) for r in qa.business_anomalies(w).orderBy("id").collect()] == [
        (2, "long_duration"), (3, "negative_distance")
    ]
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 1)], "a int, b int")
    assert rows(qa.asymmetric_edges(edges, "a", "b")) == [(3, 3, "self_edge"), (4, 1, "no_reverse")]


def test_declared_checks_and_gate(spark):
    child = spark.createDataFrame([(1, 10, 5), (1, 11, 50), (None, None, None)], "id int, fk int, m int")
    parent = spark.createDataFrame([(10,)], "pk int")
    spec = {
        "child": qa.TableChecks(["id"], ["id"], {"fk": ("parent", "pk")}, {"m": 20}),
        "absent": qa.TableChecks(["x"]),
    }
    result = qa.run_checks({"child": child, "parent": parent}, spec)
    assert rows(result.select("column", "test", "failing_rows", "passed")) == [
        ("fk", "relationships", 1, False), ("id", "not_null", 1, False), ("id", "unique", 1, False), ("m", "at_most", 1, False),
    ]
    with pytest.raises(qa.ChecksFailed, match="not_null"):
        qa.gate(result.where("not passed"), "declared")
    qa.gate(result.where("failing_rows < 0"), "nothing")


def test_table_freshness_levels(spark):
    def status(hours):
        df = log(spark, [("a", at(0), 1)])
        return qa.table_freshness(df, "t", "v", F.lit(at(hours)), 24, 48).first().status

    assert [status(h) for h in (24, 24.1, 48, 48.1)] == ["pass", "warn", "warn", "error"]
    assert qa.table_freshness(log(spark, []), "t", "v", F.lit(at(0)), 24, 48).first().status == "error"


# --- functions ---------------------------------------------------------------------------------


def test_surrogate_keys(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, datetime(2024, 1, 2, 3, 4, 5, 120000))], "a string, b string, t timestamp")
    got = df.select(sc.surrogate_key("a", "b").alias("k"), sc.timestamp_text("t").alias("t")).first()
    assert got.k == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert got.t == "2024-01-02 03:04:05.120+00"


def test_whole_units_truncate_toward_zero(spark):
    df = spark.createDataFrame([(at(0), at(1.99)), (at(1.99), at(0))], "a timestamp, b timestamp")
    assert rows(df.select(sc.hours_between("a", "b"), sc.minutes_between("a", "b"))) == [(-1, -119), (1, 119)]


def test_sample_measures(spark):
    data = [(1, [(at(0), 100), (at(1), None), (None, 140)]), (2, []), (3, None)]
    df = spark.createDataFrame(data, "id int, samples array<struct<ts timestamp, heart_rate_bpm bigint>>")
    got = rows(df.select("id", *(c.alias(n) for n, c in sample_stats().items())))
    assert got == [(1, 120.0, 140, 100, 2), (2, None, None, None, None), (3, None, None, None, None)]


def test_streams_are_as_long_as_time(spark):
    schema = "t array<double>, h array<bigint>, l array<array<double>>, a array<double>"
    df = spark.createDataFrame(
        [([0.0, 1.5], [100], [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], None), (None, [1], None, [2.0]), ([], [1], None, None)], schema
    )
    c = [F.col(x) for x in "thla"]
    got = [r[0] for r in df.select(zip_streams(*c, F.lit(at(0)).cast("timestamp"))).collect()]
    assert [tuple(x) for x in got[0]] == [
        (at(0), 100, 1.0, 2.0, None),
        (at(0) + timedelta(seconds=1.5), None, 3.0, 4.0, None),
    ]
    assert got[1] == [] and got[2] == []
