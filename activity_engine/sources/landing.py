"""The landing zone: JSON lines under `<entity>/source=<s>/dt=<day>/run=<id>` (S-1, S-2, S-4, K-1 to K-4).

Rejects lie under `_rejects/` in the same layout.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.operators.marks import window_scan
from activity_engine.operators.normalize import enforce_required, reject_rows, valid_rows
from activity_engine.schemas import ENTITIES, LANDING_PARTITIONS, REJECT
from activity_engine.sources.files import exists, observed

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_raw(spark: SparkSession, path: str, modified_after: datetime | None = None) -> DataFrame:
    """Raw records as text, one per row in `value`, with nothing assumed about their fields.

    With `modified_after`, files that were last written at or before that moment (UTC) are not opened.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "value string")
    reader = spark.read
    if modified_after is not None:
        reader = reader.option("modifiedAfter", f"{modified_after:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
    return reader.text(path)


def _landed(schema: T.StructType) -> T.StructType:
    """Declared schema with the directory columns as text."""
    fields = [f for f in schema.fields if f.name not in LANDING_PARTITIONS]
    return T.StructType([*fields, *(T.StructField(p, T.StringType()) for p in LANDING_PARTITIONS)])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = _landed(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("mode", "FAILFAST").json(path)


def read_landing(
    spark: SparkSession, base: str, entity: str, source: str | None = None, dt: str | None = None, run: str | None = None
) -> DataFrame:
    """Landed records of an entity with `dt` and `run`; the filters prune directories.

    A missing folder is an empty result.
    """
    spec = ENTITIES[entity]
    df = _read(spark, f"{base}/{entity}", spec.schema)
    for name, wanted in (("source", source), ("dt", dt), ("run", run)):
        if wanted is not None:
            df = df.where(F.col(name) == wanted)
    return enforce_required(df.select(*spec.columns, "dt", "run"), spec.required)


def read_window(
    spark: SparkSession, base: str, entity: str, source: str, since: datetime | str | None, until: datetime | str | None
) -> DataFrame:
    """Landed records with `since < version <= until`; only the days between the bounds are read."""
    return window_scan(read_landing(spark, base, entity, source), ENTITIES[entity].version, since, until, day="dt")


def read_rejects(spark: SparkSession, base: str, entity: str, source: str | None = None) -> DataFrame:
    df = _read(spark, f"{base}/_rejects/{entity}", REJECT)
    return df if source is None else df.where(F.col("source") == source)


def run_id(since: datetime | None = None, until: datetime | None = None) -> tuple[str, bool]:
    """Run name and whether it is a replay. A replay is named after its window, a live run is unique."""
    if until is None:
        now = datetime.now(timezone.utc)
        return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}", False
    first = since.isoformat() if since else "epoch"
    return f"backfill-{first}-{until.isoformat()}".replace(":", ""), True


def _write(df: DataFrame, path: str, source: str, run: str, replay: bool) -> None:
    """A replay replaces its own earlier files and no others; a live run only adds.

    The rebalance hint gathers each day into full files and splits a day that is too large for one task.
    """
    writer = (
        df.withColumn("source", F.lit(source))
        .withColumn("run", F.lit(run))
        .hint("rebalance", "dt")
        .write.mode("overwrite" if replay else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", TIMESTAMP_FORMAT)
    )
    writer.partitionBy(*LANDING_PARTITIONS).json(path)


def write_landing(valid: DataFrame, base: str, entity: str, source: str, run: str, replay: bool = False) -> None:
    _write(valid, f"{base}/{entity}", source, run, replay)


def write_rejects(rejects: DataFrame, base: str, entity: str, source: str, run: str, replay: bool = False) -> None:
    _write(rejects, f"{base}/_rejects/{entity}", source, run, replay)


@dataclass(frozen=True)
class Landed:
    """What one batch held, seen by the job that wrote it."""

    total: int
    rejected: int
    first: datetime | None
    mark: datetime | None

    @property
    def valid(self) -> int:
        return self.total - self.rejected


def land(
    shaped: DataFrame, base: str, entity: str, source: str, as_of: Column, run: str, replay: bool = False
) -> Landed:
    """Both sides of a normalised batch. Its counts, and the lowest and highest version of all its records, are
    observed while the valid side is written, so no pass is made for them. The records are normalised once: what
    the sides need of them is kept on disk, and worked out again where an executor is lost."""
    seen = Observation()
    kept = shaped.withColumn("raw", F.when(F.col("error").isNotNull(), F.col("raw"))).persist(StorageLevel.DISK_ONLY)
    watched = kept.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("error").isNotNull()).alias("rejected"),
        F.min(F.unix_micros("mark")).alias("first"),
        F.max(F.unix_micros("mark")).alias("mark"),
    )
    try:
        write_landing(valid_rows(watched), base, entity, source, run, replay)
        write_rejects(reject_rows(kept, as_of), base, entity, source, run, replay)
    finally:
        kept.unpersist()
    found = observed(seen, total=0, rejected=0, first=None, mark=None)
    moment = lambda us: None if us is None else datetime(1970, 1, 1) + timedelta(microseconds=us)
    return Landed(found["total"], found["rejected"], moment(found["first"]), moment(found["mark"]))
