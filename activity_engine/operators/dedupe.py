"""Latest row per key (U-1, X-1, O-2), on whole rows or on their places in the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the highest version per key; `tie` columns, descending, settle equal versions.

    Spark cuts each task's rows to one per key before the shuffle (WindowGroupLimit), so a key that
    holds a large share of the rows sends at most one row per task.
    """
    newest_first = [F.col(version).desc(), *(F.col(t).desc() for t in tie)]
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


# Rows that lost are sent to all tasks up to this number; beyond it the winners are joined.
BROADCAST_LOSERS = 200_000


def latest_per_key_late(
    scan: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = (), broadcast_rows: int = BROADCAST_LOSERS
) -> DataFrame:
    """`latest_per_key` of a Parquet scan whose rows are wide: only keys, versions, ties and places are ranked.

    A first pass reads these columns alone and finds the rows that lost; the wide rows are read once, in
    place, and leave out those. Losers are repeated deliveries and mostly few: up to `broadcast_rows` of them
    are broadcast, and no wide row moves. If they are more, `latest_per_key` ranks the whole rows.
    Rows equal in version and ties are told apart by their place.
    """
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    order = [F.col(version).desc(), *(F.col(t).desc() for t in tie), F.col("_file").asc(), F.col("_row").asc()]
    narrow = placed.select(*dict.fromkeys([*keys, version, *tie]), "_file", "_row")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    losers = narrow.withColumn("_rn", rank).where("_rn > 1").select("_file", "_row")
    # One row more than may be sent is enough to know.
    if losers.limit(broadcast_rows + 1).count() > broadcast_rows:
        return latest_per_key(placed, keys, version, [*tie]).drop("_file", "_row")
    return placed.join(F.broadcast(losers), ["_file", "_row"], "left_anti").select(*scan.columns)
