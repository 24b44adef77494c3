"""The full run: raw text to landing, raw tables, snapshot, dimensions, facts, marts, checks.

Order and rules of a refresh (W-1 to W-5, K-6 to K-8, Q-7). Models are written as tables one after the
other and the next model reads the written one, so no plan grows beyond a single mart and a lost
executor costs at most the model being built.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.operators.marks import advance_mark, backfill_bounds, mark_row, read_mark, window_scan
from activity_engine.operators.normalize import normalizer
from activity_engine.operators.quality import (
    duplicate_keys,
    gate,
    run_checks,
    stale_keys,
    volume_anomaly,
)
from activity_engine.operators.scd2 import current_versions, first_snapshot, snapshot_timestamp
from activity_engine.plans import dims, facts, marts, staging
from activity_engine.plans.refresh import DailyModels
from activity_engine.plans.checks import DECLARED, source_freshness
from activity_engine.schemas import ENTITIES, MARKS, entities_for
from activity_engine.sources import landing
from activity_engine.sources.files import exists
from activity_engine.sources.seeds import exercise_types
from activity_engine.sources.tables import merge_table, read_entity, read_table, replace_partitions, replace_table, table_exists
from activity_engine.streaming.ingest import stream_ingest

# The user dimension is broadcast in the as-of join only when it is counted to be no larger.
SMALL_USER_VERSIONS = 200_000


@dataclass(frozen=True)
class Warehouse:
    """Folders of one deployment."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def marks(self) -> str:
        return f"{self.root}/state/marks"

    def raw(self, entity: str) -> str:
        return f"{self.root}/raw/{entity}"

    def feed(self, entity: str) -> str | None:
        """Where merges leave what they changed; only workouts have a reader."""
        return f"{self.root}/state/feed/{entity}" if entity == "workouts" else None

    @property
    def daily(self) -> str:
        return f"{self.root}/state/daily"

    def model(self, name: str) -> str:
        return f"{self.root}/marts/{name}"


def now_column(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp")


def ingest(
    spark: SparkSession,
    wh: Warehouse,
    raw_path: str,
    entity: str,
    source: str,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    modified_after: datetime | None = None,
) -> str:
    """Land one entity of one source and return the run id. Raw files not written after `modified_after` are skipped.

    Live (no `until`): everything after the mark, which then moves. Replay (`until` given): exactly
    `since < version <= until`, written over an earlier replay of the same window; the mark stays.
    """
    if until is not None and since is None:
        raise ValueError("a replay needs both bounds")
    if entity not in entities_for(source, entity):
        raise ValueError(f"{source} does not offer {entity}")
    replay = until is not None
    marks = read_table(spark, wh.marks, MARKS)
    lower = since if replay else read_mark(marks, source, entity)
    run, _ = landing.run_id(lower, until)

    shaped = normalizer(entity, source, now_column(as_of))(landing.read_raw(spark, raw_path, modified_after))
    in_window = window_scan(shaped, "mark", lower, until)
    if lower is not None and not replay:
        # A record without a readable version has no place in time; a live run must still reject it, but
        # only the first one that meets it.
        known = landing.read_rejects(spark, wh.landing, entity, source).select("raw").distinct()
        undated = shaped.where(F.col("mark").isNull()).join(known, "raw", "left_anti")
        in_window = in_window.unionByName(undated.select(*in_window.columns))
    # Parsed once, used for both sides. Lost blocks are recomputed from the raw files. The mark is observed.
    batch = in_window.persist(StorageLevel.DISK_ONLY)
    landed = landing.land(batch, wh.landing, entity, source, now_column(as_of), run, replay)
    if not replay:
        seen = mark_row(spark, source, entity, landed.mark)
        replace_partitions(advance_mark(marks, seen), wh.marks, ["source", "entity"])
    batch.unpersist()
    return run


def load(
    spark: SparkSession, wh: Warehouse, entity: str, source: str, run: str | None = None, dt: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Merge landed rows into the raw table; a dry run only returns what it would merge."""
    rows = landing.read_landing(spark, wh.landing, entity, source, dt, run)
    if not dry_run:
        feed = wh.feed(entity)
        merge_table(spark, wh.raw(entity), rows, ENTITIES[entity], feed and f"{feed}/{landing.run_id()[0]}")
    return rows


def take_in(spark: SparkSession, wh: Warehouse, raw_path: str, entity: str, source: str, as_of: datetime) -> None:
    """Land and merge the raw files that no earlier run has read, and move the mark. An absent folder is none."""
    if entity not in entities_for(source, entity):
        raise ValueError(f"{source} does not offer {entity}")
    if not exists(spark, raw_path):
        return
    state = f"{wh.root}/state/files/{source}/{entity}"
    stream_ingest(
        spark, raw_path, wh.landing, wh.raw(entity), entity, source, now_column(as_of), state, marks=wh.marks, feed=wh.feed(entity)
    ).awaitTermination()


def backfill(
    spark: SparkSession, wh: Warehouse, raw_paths: dict[str, str], source: str, start: date, end: date, as_of: datetime
) -> dict[str, str]:
    """Replay all days from `start` to `end` as one window and load that run, whatever its days."""
    since, until = backfill_bounds(start, end)
    runs = {}
    for entity, path in raw_paths.items():
        runs[entity] = ingest(spark, wh, path, entity, source, as_of, since, until)
        load(spark, wh, entity, source, run=runs[entity])
    return runs


def raw_tables(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    return {
        f"raw_{name}": read_entity(spark, wh.raw(name), spec).drop("dt") for name, spec in ENTITIES.items()
    }


def take_snapshot(spark: SparkSession, wh: Warehouse, users: DataFrame) -> DataFrame:
    """Run the user snapshot. Two rows for one user would fork its timeline, so that fails loudly.

    Closed versions never change: only the open ones are read and written, and what a run closes goes into
    a partition of that run beside what earlier runs have closed.
    """
    gate(duplicate_keys(users, ["user_id"]), "user_id is not unique across sources")
    path = wh.model("users_snapshot")
    after = first_snapshot(users, "updated_at")
    if table_exists(spark, path):
        schema = T.StructType([*after.schema.fields, T.StructField("state", T.StringType())])
        is_open = read_table(spark, path, schema).where("state = 'open'").drop("state")
        after = snapshot_timestamp(is_open, users, "user_id", "updated_at")
    state = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit(f"closed-{landing.run_id()[0]}"))
    return replace_partitions(after.withColumn("state", state), path, ["state"]).drop("state")


def build_models(spark: SparkSession, wh: Warehouse, as_of: datetime, incremental: bool = False) -> dict[str, DataFrame]:
    """Build every model from the raw tables; returns raw, staging and mart tables by name.

    With `incremental` the daily fact and the records are kept up from what the merges changed
    (`refresh.DailyModels`); the rows are the same.
    """
    now = now_column(as_of)
    tables = raw_tables(spark, wh)
    tables["stg_workouts"] = staging.stg_workouts(tables["raw_workouts"], unique=True)
    tables["stg_users"] = staging.stg_users(tables["raw_users"], unique=True)
    tables["stg_friendships"] = staging.stg_friendships(tables["raw_friendships"], unique=True)

    def store(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        tables[name] = replace_table(df, wh.model(name), partition_by)
        return tables[name]

    snapshot = take_snapshot(spark, wh, tables["stg_users"])
    users = store("dim_user", dims.dim_user(snapshot))
    types = store("dim_exercise_type", dims.dim_exercise_type(exercise_types(spark)))
    days = store("dim_date", dims.dim_date(spark, now))
    workouts = store(
        "fact_workout",
        facts.fact_workout(tables["stg_workouts"], users, types, days, broadcast_rows=SMALL_USER_VERSIONS),
    )
    since = as_of.date() - timedelta(days=marts.WEEK_DAYS - 1)
    if incremental:
        models = DailyModels(spark, wh.daily)
        models.consume(wh.feed("workouts"), tables["stg_workouts"], current_versions(users), as_of)
        tables["fact_daily_metrics"], recent = models.daily_metrics(users), models.daily_metrics(users, since)
        tables["personal_records"] = models.personal_records()
    else:
        # The stored fact holds the same workouts as staging, already deduplicated.
        by_month = facts.fact_daily_metrics(workouts, users, now).withColumn("month", F.date_format("date_day", "yyyy-MM"))
        daily = store("fact_daily_metrics", by_month, ("month",))
        recent = daily.where(F.col("month") >= f"{since:%Y-%m}")
        store("personal_records", marts.personal_records(workouts))
    store("leaderboard", marts.leaderboard(tables["stg_friendships"], users, recent, now))
    return tables


def verify(tables: dict[str, DataFrame], as_of: datetime) -> None:
    """The declared tests, then the operational checks. The first failing group raises."""
    gate(run_checks(tables, DECLARED).where(~F.col("passed")), "declared tests")
    now = now_column(as_of)
    gate(source_freshness(tables, now).where(F.col("status") == "error"), "source freshness")
    gate(stale_keys(tables["raw_workouts"], "user_id", "synced_at", now), "stale users")
    gate(volume_anomaly(tables["raw_workouts"], "synced_at", now), "volume")


def run_pipeline(
    spark: SparkSession, root: str, raw_paths: dict[str, dict[str, str]], as_of: datetime, check: bool = True,
    incremental: bool = False,
) -> dict[str, DataFrame]:
    """One refresh. `raw_paths` maps source to entity to raw folder; an absent source is skipped.

    Only raw files that are new since the last refresh are read; `ingest` and `load` serve replays.
    """
    wh = Warehouse(root)
    for source, paths in raw_paths.items():
        for entity, path in paths.items():
            take_in(spark, wh, path, entity, source, as_of)
    tables = build_models(spark, wh, as_of, incremental)
    if check:
        verify(tables, as_of)
    return tables
