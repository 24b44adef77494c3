"""Incremental ingest of raw files with the batch operators (T-1 to T-3).

No event-time watermark: it would drop late rows and keep the first arrival, while an activity feed
keeps late rows and the newest version. The state is the raw table itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activity_engine.operators.marks import advance_mark, mark_row
from activity_engine.operators.normalize import normalizer, valid_rows
from activity_engine.schemas import ENTITIES, MARKS
from activity_engine.sources import landing
from activity_engine.sources.tables import merge_table, read_table, replace_partitions


def raw_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New raw files as they appear, one record per row in `value`."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def split_and_merge(
    base: str, table: str, entity: str, source: str, as_of: Column, name: str, marks: str | None = None, feed: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function: land valid rows and rejects, upsert what was landed, and move the mark.

    The run is named after the stream and the batch and written in replace mode, and neither the upsert
    nor the mark changes anything the second time, so a retried batch leaves the same state. Records are
    parsed once, by the landing, and the mark is observed while they are written.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = f"stream-{name}-{batch_id:010d}"
        seen_rows = landing.land(batch, base, entity, source, as_of, run, replay=True)
        landed = landing.read_landing(spark, base, entity, source, run=run)
        merge_table(spark, table, landed, ENTITIES[entity], None if feed is None else f"{feed}/{run}")
        if marks is not None:
            seen = mark_row(spark, source, entity, seen_rows.mark)
            replace_partitions(advance_mark(read_table(spark, marks, MARKS), seen), marks, ["source", "entity"])

    return apply


def stream_ingest(
    spark: SparkSession,
    raw_path: str,
    base: str,
    table: str,
    entity: str,
    source: str,
    as_of: Column,
    checkpoint: str,
    files_per_batch: int | None = None,
    marks: str | None = None,
    feed: str | None = None,
) -> StreamingQuery:
    """Take in all files not seen before and stop. With `marks`, a table of marks, the mark moves along; with
    `feed`, each batch leaves the images of what it changed in a folder of its own."""
    # Batch numbers begin again with a new checkpoint, so the runs are told apart by its name.
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    shaped = normalizer(entity, source, as_of)(raw_stream(spark, raw_path, files_per_batch))
    return (
        shaped.writeStream.foreachBatch(split_and_merge(base, table, entity, source, as_of, name, marks, feed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_stream(rows: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = ()) -> DataFrame:
    """The newest version of each key of a streaming DataFrame, kept in the stream's state store.

    In update mode a batch emits the keys it brought, each with the newest row ever seen, so a stale
    delivery reaches the sink as the row that beat it. Of equal versions the one that is greatest by `tie`
    and then by its place among the batches counts.
    """
    columns = rows.columns
    order = F.struct(F.col(version), *(F.col(t) for t in tie))
    newest = rows.where(F.col(version).isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return newest.select("_row.*")


def stream_newest(
    spark: SparkSession,
    raw_path: str,
    table: str,
    entity: str,
    source: str,
    as_of: Column,
    checkpoint: str,
    files_per_batch: int | None = None,
    tie: Sequence[str] = (),
) -> StreamingQuery:
    """Merge the newest version of each key of all files not seen before into a raw table, and stop.

    The state holds one row per key across restarts, so a batch hands the merge only the keys it touched,
    each once. A batch that is run again merges the same rows, which are then no newer than the table's.
    """
    spec = ENTITIES[entity]
    valid = valid_rows(normalizer(entity, source, as_of)(raw_stream(spark, raw_path, files_per_batch)))
    newest = newest_stream(valid.select(*spec.columns), spec.keys, spec.version, tie)
    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: merge_table(batch.sparkSession, table, batch, spec))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
