"""

Every query reads its tables whole. Fractions are rounded at the very end, for comparison only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.functions import scalars as sc
from activity_engine.functions.nested import array_mean, count_present, sample_stats, zip_streams
from activity_engine.operators import marks as mk
from activity_engine.operators import normalize as nz
from activity_engine.operators import quality as qa
from activity_engine.operators.asof import asof_validity_join
from activity_engine.operators.dedupe import latest_per_key, latest_per_key_late
from activity_engine.operators.grid import densify
from activity_engine.operators.ranking import best_per_group, rank_desc
from activity_engine.operators.rolling import rolling_at, sparse_rolling_sums
from activity_engine.operators.scd2 import current_versions, first_snapshot, scd2_history, snapshot_timestamp, snapshots_at
from activity_engine.operators.upsert import upsert_newest
from activity_engine.plans import dims, facts, feeds, marts, staging
from activity_engine.plans.checks import DECLARED, source_freshness
from activity_engine.plans.pipeline import Warehouse, load
from activity_engine.plans.refresh import DAY_TOTALS, DailyModels
from activity_engine.registry import standins as si
from activity_engine.schemas import CANONICAL_SOURCE, ENTITIES, THIRD_PARTY_SOURCE
from activity_engine.session import scratch_dir
from activity_engine.sources import landing
from activity_engine.sources.bucketed import asof_colocated, upsert_colocated, write_bucketed
from activity_engine.sources.seeds import exercise_types, read_seed
from activity_engine.sources.tables import merge_table, read_entity, replace_table
from activity_engine.streaming.ingest import stream_ingest, stream_newest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TIE = ["calories", "distance_meters"]
SOURCE = "app"


def presented(df: DataFrame) -> DataFrame:
    """Round fractions and show instants without a zone."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("double", "float"):
            c = F.round(c.cast("double"), 6)
        elif dtype == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


def sample_text() -> Column:
    """Times and rates of the nested samples as one text, so that they are compared one by one."""
    one = lambda x: F.concat(F.date_format(x["ts"], "dd HH:mm:ss"), F.lit("="), x["heart_rate_bpm"].cast("string"))
    return F.array_join(F.transform("samples", one), " ")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(fn(spark, sf_dir))

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


# --- dedupe and upsert -------------------------------------------------------------------------


@query
def u1_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(si.read(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query
def u1_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """The same ranked on the rows' places in the file; far more rows lose than may be broadcast."""
    return latest_per_key_late(si.read(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"], broadcast_rows=100)


@query
def u4_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Stored deliveries with their nested samples, collapsed without moving a sample."""
    path = f"{scratch_dir(spark, 'deliveries')}/workouts"
    si.raw_workouts(spark, d).write.parquet(path)
    newest = latest_per_key_late(spark.read.parquet(path), ["workout_id"], "synced_at", TIE)
    return staging.stg_workouts(newest, unique=True).withColumn("samples", sample_text())


@query
def u4_stg_workouts(spark: SparkSession, d: str) -> DataFrame:
    """Re-delivered workouts are collapsed to the corrected version."""
    return stg_workouts(spark, d).withColumn("samples", sample_text())


@query
def u5_stg_users(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_users(si.raw_users(spark, d))


@query
def u6_stg_friendships(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_friendships(si.raw_friendships(spark, d))


def upsert_target(spark: SparkSession, d: str) -> DataFrame:
    known = si.read(spark, d, "events").where(F.col("event_type") != "error")
    latest = latest_per_key(known, ["user_id", "event_type"], "ts", ["event_id"])
    return latest.select("user_id", "event_type", "ts", "value")


@query
def u2_upsert_newest(spark: SparkSession, d: str) -> DataFrame:
    """The source delivers every event again k - 50 hours off, so some keys are newer and some older
    than the target, and errors are new keys."""
    source = si.events(spark, d).select(
        "user_id",
        "event_type",
        sc.plus_seconds("ts", (F.col("k") - 50) * 3600).alias("ts"),
        (F.col("value") + 1000).alias("value"),
    )
    return upsert_newest(upsert_target(spark, d), source, ["user_id", "event_type"], "ts", ["value"])


@query
def u2_upsert_equal_version(spark: SparkSession, d: str) -> DataFrame:
    """The source has the target's own versions with another payload: the target stays."""
    source = si.read(spark, d, "events").select("user_id", "event_type", "ts", (F.col("value") + 1000).alias("value"))
    return upsert_newest(upsert_target(spark, d), source, ["user_id", "event_type"], "ts", ["value"])


def bucketed(spark: SparkSession, df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` stored by its keys, in a table of its own."""
    path = scratch_dir(spark, "bucketed")
    return write_bucketed(df, f"b_{uuid.uuid4().hex}", f"{path}/t", keys, 8)


@query
def u2_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert on stored buckets: the source is deduplicated and joined where it lies."""
    keys = ["user_id", "event_type"]
    source = si.events(spark, d).select(
        *keys, sc.plus_seconds("ts", (F.col("k") - 50) * 3600).alias("ts"), (F.col("value") + 1000).alias("value")
    )
    newest = latest_per_key(bucketed(spark, source, keys), keys, "ts", ["value"])
    return upsert_colocated(bucketed(spark, upsert_target(spark, d), keys), newest, keys, "ts")


# --- type-2 history ----------------------------------------------------------------------------


@query
def v1_snapshot_three_batches(spark: SparkSession, d: str) -> DataFrame:
    """Three snapshot runs over the customer log as it stood at three moments."""
    log = si.customer_log(spark, d)

    def seen_by(moment: str) -> DataFrame:
        return latest_per_key(mk.window_scan(log, "changed_at", None, moment), ["custkey"], "changed_at")

    history = first_snapshot(seen_by("1997-01-01"), "changed_at")
    for moment in ("1999-06-01", "2001-12-31"):
        history = snapshot_timestamp(history, seen_by(moment), "custkey", "changed_at")
    return history


@query
def v1_snapshots_one_pass(spark: SparkSession, d: str) -> DataFrame:
    """The same three runs, and then one for each month of seven years, in one pass over the log."""
    log = si.customer_log(spark, d)
    months = [f"{y}-{m:02}-01" for y in range(1992, 1999) for m in range(1, 13)]
    three = snapshots_at(log, ["custkey"], "changed_at", ["1997-01-01", "1999-06-01", "2001-12-31"])
    monthly = snapshots_at(log, ["custkey"], "changed_at", months, hot_rows=14)
    return three.withColumn("runs", F.lit(3)).unionByName(monthly.withColumn("runs", F.lit(len(months))))


@query
def v2_scd2_history(spark: SparkSession, d: str) -> DataFrame:
    return scd2_history(si.customer_log(spark, d), ["custkey"], "changed_at")


@query
def v2_null_keys_split(spark: SparkSession, d: str) -> DataFrame:
    """Keys that are NULL for a third of the rows, with a threshold that they pass."""
    log = si.events(spark, d).select(F.when(F.col("k") >= 33, F.col("user_id")).alias("key"), "ts").distinct()
    return scd2_history(log, ["key"], "ts", hot_rows=20)


@query
def v2_scd2_history_split(spark: SparkSession, d: str) -> DataFrame:
    """The same with a threshold that the busiest customers pass, so their histories run in chunks."""
    return scd2_history(si.customer_log(spark, d), ["custkey"], "changed_at", hot_rows=14)


def dim_user(spark: SparkSession, d: str) -> DataFrame:
    log = latest_per_key(si.raw_users(spark, d), ["user_id", "updated_at"], "updated_at", ["weight_kg"])
    return dims.dim_user(
        scd2_history(log.withColumnRenamed("source", "source_system"), ["user_id"], "updated_at")
    )


def end_as_text(df: DataFrame) -> DataFrame:
    """The far-future end does not fit the nanosecond range some clients use."""
    return df.withColumn("valid_to", F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss"))


@query
def v3_dim_user(spark: SparkSession, d: str) -> DataFrame:
    return end_as_text(dim_user(spark, d))


@query
def v4_current(spark: SparkSession, d: str) -> DataFrame:
    return end_as_text(current_versions(dim_user(spark, d)))


# --- joins and grids ---------------------------------------------------------------------------


def shipped(spark: SparkSession, d: str) -> DataFrame:
    orders = si.read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey"))
    lines = si.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    return lines.join(orders, "l_orderkey", "inner")


def customer_versions(spark: SparkSession, d: str) -> DataFrame:
    history = scd2_history(si.customer_log(spark, d), ["custkey"], "changed_at")
    return history.select("custkey", "price", "priority", "valid_from", "valid_to")


@query
def j2_asof_scd2(spark: SparkSession, d: str) -> DataFrame:
    """Each line with the customer version that held on its ship date."""
    joined = asof_validity_join(shipped(spark, d), customer_versions(spark, d), ["custkey"], "l_shipdate")
    return joined.drop("valid_to")


@query
def j2_overlap_both(spark: SparkSession, d: str) -> DataFrame:
    """Versions that last ten days and overlap, joined by broadcast and by merge."""
    e = si.read(spark, d, "events")
    versions = e.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("valid_from"), sc.plus_seconds("ts", F.lit(864000)).alias("valid_to"), F.col("event_id").alias("version")
    )
    bought = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    ways = [
        asof_validity_join(bought, versions, ["user_id"], "ts", **settings).withColumn("way", F.lit(way))
        for way, settings in (("broadcast", {"broadcast_rows": 1_000_000}), ("merge", {"hot_rows": 5}))
    ]
    return ways[0].unionByName(ways[1]).select("way", "event_id", "version")


@query
def j2_asof_split(spark: SparkSession, d: str) -> DataFrame:
    """The same with the busiest customers hot, so versions are carried across chunk borders."""
    joined = asof_validity_join(
        shipped(spark, d), customer_versions(spark, d), ["custkey"], "l_shipdate", hot_rows=70
    )
    return joined.drop("valid_to")


@query
def j2_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The same on lines and versions that are stored by customer."""
    lines, versions = (bucketed(spark, df, ["custkey"]) for df in (shipped(spark, d), customer_versions(spark, d)))
    return asof_colocated(lines, versions, ["custkey"], "l_shipdate").drop("valid_to")


@query
def j2_asof_small_dim(spark: SparkSession, d: str) -> DataFrame:
    """The same as an inner join, broadcast if the versions are counted to be few."""
    joined = asof_validity_join(
        shipped(spark, d), customer_versions(spark, d), ["custkey"], "l_shipdate", how="inner", broadcast_rows=200_000
    )
    return joined.drop("valid_to")


@query
def j5_dense_user_days(spark: SparkSession, d: str) -> DataFrame:
    """Purchases per signed-up user and day, idle days included."""
    e = si.read(spark, d, "events")
    users = e.where(F.col("event_type") == "signup").select("user_id").distinct()
    purchases = e.where(F.col("event_type") == "purchase")
    active = purchases.groupBy("user_id", F.to_date("ts").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )
    first = purchases.select(F.min(F.to_date("ts"))).scalar()
    return densify(active, users, "user_id", first, si.last_day(spark, d), {"n": 0, "total": 0.0})


@query
def n1_unnest_agg(spark: SparkSession, d: str) -> DataFrame:
    """Samples unnested and aggregated per workout; workouts without samples drop out (J-11, A-2)."""
    s = stg_workouts(spark, d).select("workout_id", F.explode("samples").alias("s"))
    return s.groupBy("workout_id").agg(
        F.avg("s.heart_rate_bpm").alias("avg_heart_rate_bpm"),
        F.max("s.heart_rate_bpm").alias("max_heart_rate_bpm"),
        F.min("s.heart_rate_bpm").alias("min_heart_rate_bpm"),
        F.count("s.ts").alias("sample_count"),
    )


@query
def n2_sample_stats(spark: SparkSession, d: str) -> DataFrame:
    """The same measures in place; workouts without samples keep NULLs."""
    return stg_workouts(spark, d).withColumns(sample_stats()).select(
        "workout_id", "avg_heart_rate_bpm", "max_heart_rate_bpm", "min_heart_rate_bpm", "sample_count"
    )


@query
def n2_array_stats(spark: SparkSession, d: str) -> DataFrame:
    values = F.col("embedding")
    return si.read(spark, d, "embeddings").select(
        "vec_id",
        array_mean(values).alias("mean"),
        F.array_max(values).cast("double").alias("highest"),
        F.array_min(values).cast("double").alias("lowest"),
        count_present(F.filter(values, lambda x: x > 0)).alias("positive"),
    )


# --- models ------------------------------------------------------------------------------------


def stg_workouts(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_workouts(si.raw_workouts(spark, d), TIE)


def spine(spark: SparkSession, d: str) -> DataFrame:
    return dims.dim_date(spark, si.last_day(spark, d))


def fact_workout(spark: SparkSession, d: str, users: DataFrame | None = None) -> DataFrame:
    users = dim_user(spark, d) if users is None else users
    types = dims.dim_exercise_type(exercise_types(spark))
    return facts.fact_workout(stg_workouts(spark, d), users, types, spine(spark, d))


def daily_metrics(spark: SparkSession, d: str, users: DataFrame | None = None) -> DataFrame:
    users = dim_user(spark, d) if users is None else users
    return facts.fact_daily_metrics(stg_workouts(spark, d), users, si.last_day(spark, d))


@query
def m1_dim_date(spark: SparkSession, d: str) -> DataFrame:
    """The calendar from the first order to a year past the last one."""
    ends = si.read(spark, d, "orders").select(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")
    )
    return dims.dim_date(spark, ends.select("hi").scalar(), ends.select("lo").scalar())


def part_types(spark: SparkSession, d: str) -> DataFrame:
    return si.read(spark, d, "part").groupBy(F.lower("p_type").alias("workout_type")).agg(
        F.min("p_brand").alias("category"),
        (F.max("p_size") > 25).alias("is_cardio"),
        F.max("p_retailprice").alias("met_value"),
    )


@query
def m2_dim_type(spark: SparkSession, d: str) -> DataFrame:
    """Part types as the looked-up vocabulary."""
    return dims.dim_exercise_type(part_types(spark, d))


@query
def m4_fact_workout(spark: SparkSession, d: str) -> DataFrame:
    """Staging, nested measures, as-of join, type and date lookups."""
    return fact_workout(spark, d).withColumn("samples", sample_text())


@query
def m5_daily_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Dense user days with rolling, week-over-week and gap metrics (X-3 to X-8)."""
    return daily_metrics(spark, d)


@query
def m6_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    users = dim_user(spark, d)
    edges = staging.stg_friendships(si.raw_friendships(spark, d))
    active = facts.daily_activity(stg_workouts(spark, d))  # idle days add nothing to a week's totals
    return marts.leaderboard(edges, users, active, si.last_day(spark, d))


@query
def m6_leaderboard_split(spark: SparkSession, d: str) -> DataFrame:
    """The same with a threshold that popular users pass, so ranks come from distinct values."""
    users = dim_user(spark, d)
    edges = staging.stg_friendships(si.raw_friendships(spark, d))
    active = facts.daily_activity(stg_workouts(spark, d))
    return marts.leaderboard(edges, users, active, si.last_day(spark, d), hot_rows=100)


@query
def x3_sparse_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Rolling sums where they change, spread over their days: the active weeks of all users."""
    active = facts.daily_activity(stg_workouts(spark, d))
    sums = {"minutes": "total_duration_minutes", "metres": "total_distance_meters"}
    rolling = sparse_rolling_sums(active, "user_id", "date_day", sums)
    return rolling.select("user_id", F.explode(F.sequence("from_day", "to_day")).alias("date_day"), *sums)


@query
def a4_weekly_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the last seven days straight from the change points."""
    active = facts.daily_activity(stg_workouts(spark, d))
    rolling = sparse_rolling_sums(active, "user_id", "date_day", {"distance_7d": "total_distance_meters", "workouts_7d": "workout_count"})
    return rolling_at(rolling, si.last_day(spark, d))


@query
def m7_records(spark: SparkSession, d: str) -> DataFrame:
    return marts.personal_records(stg_workouts(spark, d))


def refreshed(spark: SparkSession, d: str, *models_kept: str) -> DailyModels:
    """Day totals, and the models asked for, kept up over three merges: early versions of some workouts, days off and with three times
    the distance, for half of the users and an earlier today; then all first deliveries; then all repeats."""
    base, spec = scratch_dir(spark, "refresh"), ENTITIES["workouts"]
    models, users = DailyModels(spark, f"{base}/models"), current_versions(dim_user(spark, d))
    first = si.first_deliveries(spark, d)
    early = {c: sc.plus_seconds(c, F.lit(-172800)) for c in ("start_time", "end_time", "synced_at")}
    early["distance_meters"] = F.col("distance_meters") * 3
    today = si.read(spark, d, "events").agg(F.date_trunc("day", F.max("ts"))).first()[0]
    batches = [first.where(F.col("k") < 30).withColumns(early), first, si.raw_workouts(spark, d)]
    for run, batch in enumerate(batches):
        feed = f"{base}/feed/{run}"
        merge_table(spark, f"{base}/raw", batch, spec, feed)
        workouts = staging.stg_workouts(read_entity(spark, f"{base}/raw", spec).drop("dt"), unique=True)
        touched = models.log_batch(workouts, run, spark.read.parquet(feed) if run else None)
        if "metrics" in models_kept:
            known = users if run else users.where(F.crc32("user_id") % 2 == 0)
            models.refresh_metrics(known, today if run else today - timedelta(days=9), touched)
        if "records" in models_kept:
            models.refresh_records(touched)
    return models


@query
def m5_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The daily fact after three batches that rewrote only the rows they touched."""
    return refreshed(spark, d, "metrics").daily_metrics(dim_user(spark, d))


@query
def m7_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Records raised batch by batch, and lowered where one corrected them."""
    return refreshed(spark, d, "records").personal_records()


@query
def a1_day_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals and bests per user, type and day from the logged partial rows, after compaction."""
    models = refreshed(spark, d)
    models.compact()
    return DAY_TOTALS.state(models.log())


@query
def a3_best_per_group(spark: SparkSession, d: str) -> DataFrame:
    """Bests per supplier and return flag; the ratio counts only where a tax is due."""
    lines = si.read(spark, d, "lineitem")
    ratio = F.when(F.col("l_tax") > 0, F.col("l_quantity") / F.col("l_tax"))
    return best_per_group(
        lines,
        ["l_suppkey", "l_returnflag"],
        {"best_price": "l_extendedprice", "last_ship": "l_shipdate"},
        {"lowest_ratio": ratio},
    )


@query
def x2_rank_with_ties(spark: SparkSession, d: str) -> DataFrame:
    """Lines ranked by quantity within their status: few groups, very many ties."""
    lines = si.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_quantity")
    return rank_desc(lines, ["l_linestatus"], "l_quantity", "position")


@query
def x2_null_rank_split(spark: SparkSession, d: str) -> DataFrame:
    """Groups and measures that are NULL, ranked value by value."""
    e = si.events(spark, d)
    rows = e.select("event_id", F.when(F.col("k") < 70, F.col("event_type")).alias("grp"), F.when(F.col("k") % 3 > 0, F.col("k")).alias("m"))
    return rank_desc(rows, ["grp"], "m", "place", hot_rows=10)


@query
def x2_rank_split(spark: SparkSession, d: str) -> DataFrame:
    """Orders ranked by price within their priority, each priority split into chunks."""
    orders = si.read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank_desc(orders, ["o_orderpriority"], "o_totalprice", "position", hot_rows=200)


# --- feeds -------------------------------------------------------------------------------------


@query
def d1_trend(spark: SparkSession, d: str) -> DataFrame:
    return feeds.trend(daily_metrics(spark, d))


@query
def d2_kpis(spark: SparkSession, d: str) -> DataFrame:
    return feeds.kpis(daily_metrics(spark, d))


@query
def d3_session_mix(spark: SparkSession, d: str) -> DataFrame:
    return feeds.session_mix(stg_workouts(spark, d))


@query
def d4_heart_rate_trend(spark: SparkSession, d: str) -> DataFrame:
    return feeds.heart_rate_trend(stg_workouts(spark, d).withColumns(sample_stats()))


@query
def d5_volume(spark: SparkSession, d: str) -> DataFrame:
    """The records are normalised once and stored; both sides read of them what they need."""
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    shaped = shaped.withColumn("record", F.when(F.col("error").isNull(), F.struct("record.source")))
    shaped = replace_table(shaped, f"{scratch_dir(spark, 'volume')}/workouts")
    source = F.lit(SOURCE).alias("source")
    rejects = nz.reject_rows(shaped, si.last_day(spark, d)).select(source, "dt")
    return feeds.ingestion_volume(nz.valid_rows(shaped).select("source", "dt"), rejects)


# --- normalising and rejects -------------------------------------------------------------------


def nested_as_numbers(workouts: DataFrame) -> DataFrame:
    """Sample lists shown as their length, rates and times in flat columns."""
    s = "samples"
    return workouts.withColumns(
        {
            "n_samples": F.size(s).cast("bigint"),
            "first_ts": F.get(F.col(f"{s}.ts"), F.lit(0)),
            "last_ts": F.try_element_at(F.col(f"{s}.ts"), F.lit(-1)),
            "rates": F.array_join(F.transform(F.col(f"{s}.heart_rate_bpm"), lambda x: x.cast("string")), ",", "-"),
        }
    ).drop(s)


@query
def i1_users_valid(spark: SparkSession, d: str) -> DataFrame:
    return nz.valid_rows(nz.normalize_users(si.damaged_users(spark, d), SOURCE))


@query
def i1_users_rejected(spark: SparkSession, d: str) -> DataFrame:
    shaped = nz.normalize_users(si.damaged_users(spark, d), SOURCE)
    return nz.reject_rows(shaped, si.last_day(spark, d)).groupBy("error", "dt").agg(F.count(F.lit(1)).alias("n"))


@query
def i2_friendships(spark: SparkSession, d: str) -> DataFrame:
    """Valid and rejected edges, counted per pair and message."""
    shaped = nz.normalize_friendships(si.damaged_friendships(spark, d), SOURCE)
    return shaped.groupBy("record.user_id", "record.friend_user_id", "error").agg(
        F.count(F.lit(1)).alias("n"), F.max("mark").alias("mark")
    )


@query
def i8_valid(spark: SparkSession, d: str) -> DataFrame:
    return nested_as_numbers(nz.valid_rows(nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)))


@query
def i8_reject_split(spark: SparkSession, d: str) -> DataFrame:
    """Every reject with its message; the raw text is shown as its hash."""
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    return nz.reject_rows(shaped, si.last_day(spark, d)).select("error", "dt", F.md5("raw").alias("raw_md5"))


@query
def i4_user_from_athlete(spark: SparkSession, d: str) -> DataFrame:
    shaped = nz.normalize_athletes(si.athletes(spark, d), si.last_moment(spark, d))
    return shaped.select("record.*", "error", "dt")


@query
def i5_workout_from_activity(spark: SparkSession, d: str) -> DataFrame:
    shaped = nz.normalize_activities(si.activities(spark, d), si.last_moment(spark, d))
    return nested_as_numbers(shaped.select("record.*", "error", "dt"))


@query
def i6_type_map(spark: SparkSession, d: str) -> DataFrame:
    """Part names through the type map: mapped spellings by size, the rest lower-cased."""
    part = si.read(spark, d, "part")
    spelling = (
        F.when(F.col("p_size") < 10, F.lit("TrailRun"))
        .when(F.col("p_size") < 20, F.lit("MountainBikeRide"))
        .when(F.col("p_size") < 30, F.lit("WeightTraining"))
        .otherwise(F.initcap("p_name"))
    )
    return part.select("p_partkey", spelling.alias("activity_type"), nz.map_type(spelling).alias("workout_type"))


@query
def i7_streams_zip(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as parallel streams: one time per value, rates only where positive, so that they run
    out early, and no altitude for even labels. One row per sample."""
    e = si.read(spark, d, "embeddings")
    values = F.col("embedding")
    time = F.when(F.col("label") != 3, F.transform(values, lambda x, i: (i * 5).cast("double")))
    rates = F.transform(F.filter(values, lambda x: x > 0), lambda x: F.round(x.cast("double") * 1000).cast("bigint"))
    pairs = F.transform(F.filter(values, lambda x: x < 0), lambda x: F.array(x.cast("double"), (-x).cast("double")))
    altitude = F.when(F.col("label") % 2 == 1, F.transform(values, lambda x: x.cast("double")))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return e.select(
        "vec_id", F.explode(zip_streams(time, rates, pairs, altitude, start)).alias("s")
    ).select("vec_id", "s.*")


@query
def i12_conform_sources(spark: SparkSession, d: str) -> DataFrame:
    """Customers as one source and suppliers as the other, in one user shape."""
    at = F.lit("2024-01-01").cast("timestamp")

    def as_users(df: DataFrame, key: str, name: str, weight: str, source: str) -> DataFrame:
        first, last = F.substring_index(name, "#", 1), F.substring_index(name, "#", -1)
        values = nz.athlete_values(F.col(key).cast("string"), first, last, F.lit(None), F.col(weight), at, source)
        schema = ENTITIES["users"].schema
        return df.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields))

    return nz.conform(
        as_users(si.read(spark, d, "customer"), "c_custkey", "c_name", "c_acctbal", "c"),
        as_users(si.read(spark, d, "supplier"), "s_suppkey", "s_name", "s_acctbal", "s"),
    )


# --- scans, marks, backfill --------------------------------------------------------------------


def feed(spark: SparkSession, d: str) -> DataFrame:
    """First deliveries and repeats without their samples."""
    return si.raw_workouts(spark, d).drop("samples")


def nth_day(spark: SparkSession, d: str, n: int) -> date:
    """The day n days after the first event's."""
    return si.read(spark, d, "events").select(F.date_add(F.to_date(F.min("ts")), n)).first()[0]


@query
def s1_landing_scan(spark: SparkSession, d: str) -> DataFrame:
    """Valid rows are landed as JSON in day folders and one day is read back."""
    base = scratch_dir(spark, "landing")
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    landing.land(shaped, base, "workouts", SOURCE, si.last_day(spark, d), "run-1")
    day = nth_day(spark, d, 14).isoformat()
    return nested_as_numbers(landing.read_landing(spark, base, "workouts", SOURCE, dt=day).drop("run"))


@query
def k2_replay_landing(spark: SparkSession, d: str) -> DataFrame:
    """The same window is landed twice and another run once: the replay replaces only itself."""
    base = scratch_dir(spark, "replay")
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    today = si.last_day(spark, d)
    replay = mk.window_scan(shaped, "mark", nth_day(spark, d, 4).isoformat(), nth_day(spark, d, 8).isoformat())
    landing.land(replay, base, "workouts", SOURCE, today, "live-1")
    for _ in range(2):
        landing.land(replay, base, "workouts", SOURCE, today, "backfill-1", replay=True)
    valid = landing.read_landing(spark, base, "workouts").select("dt", "run", F.lit(True).alias("ok"))
    rejected = landing.read_rejects(spark, base, "workouts").select("dt", "run", F.lit(False).alias("ok"))
    return valid.unionByName(rejected).groupBy("dt", "run").agg(
        F.count_if(F.col("ok")).alias("valid"), F.count_if(~F.col("ok")).alias("rejected")
    )


@query
def k6_merge_table(spark: SparkSession, d: str) -> DataFrame:
    """Repeats first, first deliveries after them: the stored table keeps the newest of each workout."""
    path = scratch_dir(spark, "merge")
    first = si.first_deliveries(spark, d)
    spec = ENTITIES["workouts"]
    merge_table(spark, path, first.where(F.col("workout_type") == "run"), spec)
    merge_table(spark, path, si.raw_workouts(spark, d), spec)
    merge_table(spark, path, first.withColumn("calories", F.lit(-1.0)), spec)
    return read_entity(spark, path, spec).select("workout_id", "workout_type", "synced_at", "calories", "dt")


@query
def s8_window_scan(spark: SparkSession, d: str) -> DataFrame:
    """Both bounds are times of events: the lower one is left out, the upper one comes in."""
    e = si.read(spark, d, "events")
    clicks = e.where(F.col("event_type") == "click")
    lo, hi = clicks.select(F.min("ts")).scalar(), clicks.select(F.max("ts")).scalar()
    return mk.window_scan(e, "ts", lo, hi).select("event_id", "ts", "user_id")


@query
def s8_landed_window(spark: SparkSession, d: str) -> DataFrame:
    """Landed records between two moments; only the folders of the days between them are read."""
    base = scratch_dir(spark, "window")
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    landing.land(shaped, base, "workouts", SOURCE, si.last_day(spark, d), "run-1")
    since, until = mk.backfill_bounds(nth_day(spark, d, 6), nth_day(spark, d, 9))
    landed = landing.read_window(spark, base, "workouts", SOURCE, since + timedelta(hours=5), until - timedelta(hours=5))
    return landed.select("workout_id", "synced_at", "dt")


@query
def w6_observed_batch(spark: SparkSession, d: str) -> DataFrame:
    """Counts and marks of one batch as the job that landed it saw them."""
    shaped = nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE)
    seen = landing.land(shaped, scratch_dir(spark, "observed"), "workouts", SOURCE, si.last_day(spark, d), "run-1")
    row = [(seen.total, seen.valid, seen.rejected, str(seen.first), str(seen.mark))]
    found = spark.createDataFrame(row, "total bigint, valid bigint, rejected bigint, first string, mark string")
    return found.withColumns({c: F.col(c).cast("timestamp") for c in ("first", "mark")})


@query
def w2_high_water(spark: SparkSession, d: str) -> DataFrame:
    """Marks of three old runs, moved by what valid and rejected records show; one stays ahead."""
    shaped = nz.normalize_users(si.damaged_users(spark, d), SOURCE).select(F.lit("users").alias("entity"), "mark")
    shaped = shaped.unionByName(
        nz.normalize_workouts(si.damaged_workouts(spark, d), SOURCE).select(F.lit("workouts").alias("entity"), "mark")
    )
    seen = mk.high_water(shaped.withColumn("source", F.lit(SOURCE)), "mark", ["source", "entity"])
    e = si.read(spark, d, "events")
    old = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    marks = old.select(F.lit(SOURCE).alias("source"), F.lit("users").alias("entity"), F.col("lo").alias("mark"))
    marks = marks.unionByName(
        old.select(
            F.lit(SOURCE).alias("source"),
            F.lit("workouts").alias("entity"),
            sc.plus_seconds("hi", F.lit(864000)).alias("mark"),
        )
    ).unionByName(
        old.select(F.lit("other").alias("source"), F.lit("users").alias("entity"), F.col("lo").alias("mark"))
    )
    return mk.advance_mark(marks, seen)


@query
def w4_backfill_range(spark: SparkSession, d: str) -> DataFrame:
    since, until = mk.backfill_bounds(nth_day(spark, d, 9), nth_day(spark, d, 11))
    return mk.window_scan(feed(spark, d), "synced_at", since, until)


@query
def w5_support(spark: SparkSession, d: str) -> DataFrame:
    """Records by source and entity, and whether that source offers the entity."""
    e = si.events(spark, d)
    source = F.when(F.col("k") % 3 == 0, F.lit(THIRD_PARTY_SOURCE)).when(F.col("k") % 3 == 1, F.lit(CANONICAL_SOURCE)).otherwise(F.lit(SOURCE))
    entity = F.when(F.col("event_type") == "signup", F.lit("users")).when(F.col("k") > 60, F.lit("friendships")).otherwise(F.lit("workouts"))
    return e.groupBy(source.alias("source"), entity.alias("entity")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "offered", mk.offered(F.col("source"), F.col("entity"))
    )


@query
def w6_batch_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts of one batch: the damaged records, and the same ones delivered again for some users."""
    raw = si.damaged_workouts(spark, d)
    shaped = nz.normalize_workouts(raw.unionByName(raw.where(F.col("value").contains('"heart_rate_bpm":5'))), SOURCE)
    r = shaped.select("error", "record.*")
    late = F.col("synced_at") - F.col("start_time") > F.expr("interval 1 day")
    return mk.batch_stats(
        r,
        ["workout_id"],
        {
            "valid": F.col("error").isNull(),
            "rejected": F.col("error").isNotNull(),
            "late": late,
            "long": sc.minutes_between("start_time", "end_time") > 240,
        },
    )


@query
def w7_late(spark: SparkSession, d: str) -> DataFrame:
    return mk.late_rows(feed(spark, d), "start_time", "synced_at").select("workout_id", "start_time", "synced_at")


def streamed(spark: SparkSession, d: str) -> str:
    """A folder after three stream runs: first deliveries, corrected and repeated ones, and nothing new."""
    base = scratch_dir(spark, "stream")
    as_of = F.lit("2024-02-01").cast("timestamp")
    for again in (False, True, None):
        if again is not None:
            si.damaged_workouts(spark, d, again).write.mode("append").text(f"{base}/raw")
        stream_ingest(
            spark, f"{base}/raw", f"{base}/landing", f"{base}/table", "workouts", SOURCE, as_of, f"{base}/state", 4
        ).awaitTermination()
    return base


@query
def t2_stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Raw text files taken in as a stream, some files a batch, split, landed and merged."""
    return nested_as_numbers(read_entity(spark, f"{streamed(spark, d)}/table", ENTITIES["workouts"]))


@query
def t2_stream_state(spark: SparkSession, d: str) -> DataFrame:
    """Newest rows from the stream's own state, over three starts and several files a batch, merged key by key."""
    base = scratch_dir(spark, "state")
    as_of = F.lit("2024-02-01").cast("timestamp")
    for again in (True, False, None):  # the corrected deliveries first, the stale ones after them
        if again is not None:
            si.damaged_workouts(spark, d, again).write.mode("append").text(f"{base}/raw")
        stream_newest(
            spark, f"{base}/raw", f"{base}/table", "workouts", SOURCE, as_of, f"{base}/checkpoint", 4, ["calories"]
        ).awaitTermination()
    return nested_as_numbers(read_entity(spark, f"{base}/table", ENTITIES["workouts"]))


@query
def t3_stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The other side of the same stream."""
    rejects = landing.read_rejects(spark, f"{streamed(spark, d)}/landing", "workouts")
    return rejects.groupBy("error", "source").agg(F.count(F.lit(1)).alias("n"))


@query
def k8_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """A dry run shows what it would merge and merges nothing."""
    wh = Warehouse(scratch_dir(spark, "dry"))
    landing.land(
        nz.normalize_workouts(si.damaged_workouts(spark, d), CANONICAL_SOURCE), wh.landing, "workouts", CANONICAL_SOURCE,
        si.last_day(spark, d), "run-1",
    )
    shown = load(spark, wh, "workouts", CANONICAL_SOURCE, run="run-1", dry_run=True)
    stored = read_entity(spark, wh.raw("workouts"), ENTITIES["workouts"])
    return shown.agg(F.count(F.lit(1)).alias("shown")).join(stored.agg(F.count(F.lit(1)).alias("stored")))


@query
def i9_required(spark: SparkSession, d: str) -> DataFrame:
    """Landed workouts in which one column is NULL are read again: a required one must stop the read."""
    rows = si.first_deliveries(spark, d)
    found = []
    for column in ENTITIES["workouts"].columns:
        broken = rows.withColumn(column, F.when(F.col("k") != 5, F.col(column)))
        try:
            nz.enforce_required(broken.select(*ENTITIES["workouts"].columns), ENTITIES["workouts"].required).write.format(
                "noop"
            ).mode("overwrite").save()
            found.append((column, False))
        except PySparkException:
            found.append((column, True))
    return spark.createDataFrame(found, "column string, stopped boolean")


@query
def s5_seed_file(spark: SparkSession, d: str) -> DataFrame:
    """Types made from parts, written as CSV with a header and read as a seed."""
    path = scratch_dir(spark, "seed")
    part_types(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return read_seed(spark, path)


@query
def w1_mark_read(spark: SparkSession, d: str) -> DataFrame:
    """The mark of each kind of event, as if each were an entity, and of one that has never run."""
    e = si.read(spark, d, "events")
    marks = e.groupBy(F.lit(SOURCE).alias("source"), F.col("event_type").alias("entity")).agg(F.max("ts").alias("mark"))
    names = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").collect()]
    found = [(name, mk.read_mark(marks, SOURCE, name)) for name in [*names, "never"]]
    return spark.createDataFrame(found, "entity string, mark timestamp")


# --- quality -----------------------------------------------------------------------------------


def models(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Every table the declared tests name. Models are stored as in the full run, so that each is made
    once and not anew for every test."""
    base = scratch_dir(spark, "models")

    def stored(name: str, df: DataFrame) -> DataFrame:
        return replace_table(df, f"{base}/{name}")

    workouts = stored("stg_workouts", stg_workouts(spark, d))
    users = stored("dim_user", dim_user(spark, d))
    edges = stored("stg_friendships", staging.stg_friendships(si.raw_friendships(spark, d)))
    types, days = dims.dim_exercise_type(exercise_types(spark)), spine(spark, d)
    daily = stored("daily", facts.fact_daily_metrics(workouts, users, si.last_day(spark, d)))
    return {
        "raw_workouts": si.raw_workouts(spark, d),
        "raw_users": si.raw_users(spark, d),
        "raw_friendships": si.raw_friendships(spark, d),
        "stg_workouts": workouts,
        "stg_users": staging.stg_users(si.raw_users(spark, d)),
        "stg_friendships": edges,
        "dim_user": users,
        "dim_date": days,
        "dim_exercise_type": types,
        "fact_workout": stored("fact_workout", facts.fact_workout(workouts, users, types, days)),
        "fact_daily_metrics": daily,
        "leaderboard": marts.leaderboard(edges, users, daily, si.last_day(spark, d)),
        "personal_records": marts.personal_records(workouts),
    }


@query
def q1_declared(spark: SparkSession, d: str) -> DataFrame:
    """All 50 declared tests on the models."""
    return qa.run_checks(models(spark, d), DECLARED)


@query
def q1_run_checks(spark: SparkSession, d: str) -> DataFrame:
    """Tests that fail: keys of lines repeat, labels lack documents, shifted keys lack parents."""
    lines = si.read(spark, d, "lineitem").withColumn("buyer", F.col("l_partkey") + F.col("l_suppkey"))
    tables = {
        "lineitem": lines,
        "customer": si.read(spark, d, "customer"),
        "documents": si.read(spark, d, "documents").join(si.read(spark, d, "labels"), "doc_id", "left"),
    }
    spec = {
        "lineitem": qa.TableChecks(
            not_null=["l_orderkey", "l_shipdate"],
            unique=["l_orderkey"],
            relationships={"buyer": ("customer", "c_custkey")},
            at_most={"l_quantity": 40, "l_tax": 0.07},
        ),
        "documents": qa.TableChecks(not_null=["quality", "toxic", "text"], unique=["doc_id", "quality"]),
    }
    return qa.run_checks(tables, spec)


@query
def q7_gate(spark: SparkSession, d: str) -> DataFrame:
    """Which tests stop a run: every declared test of some line columns is put to the gate."""
    checks = qa.TableChecks(not_null=["l_orderkey"], unique=["l_orderkey"], at_most={"l_quantity": 40, "l_tax": 0.5})
    results = qa.run_checks({"lineitem": si.read(spark, d, "lineitem")}, {"lineitem": checks}).persist()
    found = []
    for r in results.select("column", "test").collect():
        own = results.where((F.col("column") == r[0]) & (F.col("test") == r[1]) & ~F.col("passed"))
        try:
            qa.gate(own, "lineitem")
            found.append((*r, False))
        except qa.ChecksFailed:
            found.append((*r, True))
    results.unpersist()
    return spark.createDataFrame(found, "column string, test string, stopped boolean")


@query
def q1_unique(spark: SparkSession, d: str) -> DataFrame:
    return qa.duplicate_keys(si.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q1_relationships(spark: SparkSession, d: str) -> DataFrame:
    """Orders no line refers to (J-10)."""
    return qa.orphans(si.read(spark, d, "orders"), "o_orderkey", si.read(spark, d, "lineitem"), "l_orderkey")


@query
def q1_rule(spark: SparkSession, d: str) -> DataFrame:
    return qa.duration_under_hours(stg_workouts(spark, d), "duration_minutes").select("workout_id", "duration_minutes")


@query
def q2_table_freshness(spark: SparkSession, d: str) -> DataFrame:
    tables = {"raw_workouts": si.first_deliveries(spark, d), "raw_users": si.raw_users(spark, d)}
    late = si.read(spark, d, "events").select(F.max("ts") + F.expr("interval 16 day 1 hour")).scalar()
    return source_freshness(tables, late)


@query
def q3_user_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Users by the last sync of a workout, as of the last event; the order is for reading only."""
    stale = qa.stale_keys(si.raw_workouts(spark, d), "user_id", "synced_at", si.last_moment(spark, d))
    return stale.orderBy(F.desc("hours_since_sync"), "user_id")


@query
def q3_stale_users(spark: SparkSession, d: str) -> DataFrame:
    """The same three days later, when some users have fallen silent."""
    later = sc.plus_seconds(si.last_moment(spark, d), F.lit(3 * 86400))
    return qa.stale_keys(si.raw_workouts(spark, d), "user_id", "synced_at", later)


def thinned(spark: SparkSession, d: str) -> DataFrame:
    """Events as if most of the last day had failed to arrive."""
    e = si.read(spark, d, "events")
    return e.where((F.to_date("ts") < si.last_day(spark, d)) | (F.col("event_type") == "click"))


@query
def q4_volume(spark: SparkSession, d: str) -> DataFrame:
    return qa.volume_anomaly(thinned(spark, d), "ts", si.last_day(spark, d))


@query
def q4_volume_dense(spark: SparkSession, d: str) -> DataFrame:
    """As of the day after the data ends: an outage."""
    return qa.volume_anomaly(thinned(spark, d), "ts", F.date_add(si.last_day(spark, d), 1), dense=True)


@query
def q5_anomaly(spark: SparkSession, d: str) -> DataFrame:
    found = qa.business_anomalies(stg_workouts(spark, d))
    return found.select("workout_id", "duration_minutes", "distance_meters", "reason")


@query
def q6_symmetry(spark: SparkSession, d: str) -> DataFrame:
    """Events as one-way edges from user to k."""
    edges = si.events(spark, d).select(F.col("user_id").alias("a"), F.col("k").alias("b"))
    return qa.asymmetric_edges(edges, "a", "b")


# --- predicates and scalar functions -----------------------------------------------------------


@query
def p_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Ranges, lists, null and equality flags, a scalar subquery, CASE, and HAVING."""
    lines = si.read(spark, d, "lineitem").join(si.read(spark, d, "labels"), F.col("l_partkey") == F.col("doc_id"), "left")
    first = si.read(spark, d, "orders").select(F.min("o_orderdate")).scalar()
    half_open = (F.col("l_shipdate") >= first) & (F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))
    flagged = lines.where(F.col("l_quantity").between(5, 45) & half_open).select(
        "l_suppkey",
        F.col("l_returnflag").isin("A", "R").alias("returned"),
        F.col("quality").isNull().alias("unlabelled"),
        (F.to_date("l_shipdate") == F.lit("1997-05-28").cast("date")).alias("that_day"),
        F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("discounted"),
        F.when(F.col("l_tax") > 0.04, 2).otherwise(1).alias("band"),
    )
    groups = flagged.groupBy("l_suppkey", "returned", "unlabelled").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("that_day").alias("that_day"),
        F.sum("discounted").alias("discounted"),
        F.sum("band").alias("band"),
    )
    return groups.where(F.col("n") > 3)


def signed_gap() -> tuple[Column, Column]:
    start = F.col("ts")
    return start, sc.plus_seconds(start, (F.col("k") - 50) * F.lit(977))


@query
def f_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Keys, time differences of both signs, calendar numbers and safe ratios on every event."""
    start, end = signed_gap()
    day = F.to_date("ts")
    divisor = F.when(F.col("k") > 0, F.col("k") + F.lit(0.1).cast("double")).otherwise(F.lit(0.0))
    return si.events(spark, d).select(
        "event_id",
        sc.surrogate_key("event_id", F.when(F.col("k") > 9, F.col("event_type"))).alias("key"),
        sc.surrogate_key(sc.timestamp_text(F.date_trunc("second", "ts")), sc.timestamp_text("ts")).alias("time_key"),
        sc.minutes_between(start, end).alias("minutes"),
        sc.hours_between(start, end).alias("hours"),
        F.date_diff(F.to_date(end), day).cast("bigint").alias("days"),
        F.unix_date(day).cast("bigint").alias("day_number"),
        sc.week_of_year_sunday(day).alias("week"),
        F.dayofweek(day).cast("bigint").alias("weekday"),
        F.add_months(day, 12).alias("next_year"),
        F.date_sub(day, 6).alias("week_ago"),
        F.try_divide(F.col("value"), divisor).alias("safe"),
        sc.ratio_change(F.col("value"), divisor).alias("change"),
        F.concat_ws(" ", F.nullif(F.col("event_type"), F.lit("view")), F.lower("props")).alias("words"),
        F.substring(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1, 10).alias("first_ten"),
    )
