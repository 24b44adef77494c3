"""Newest-wins upsert (U-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert_newest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Target after the merge, as one union and one shuffle.

    A source row replaces the whole target row only when its version is strictly higher; on an equal
    version the target row stays. Unknown keys are inserted, nothing is deleted. `tie` settles equal
    versions within the source. A target row whose version is NULL is never replaced.
    """
    both = target.withColumn("_from", F.lit(0)).unionByName(
        source.select(*target.columns).withColumn("_from", F.lit(1))
    )
    beats = [
        ((F.col("_from") == 0) & F.col(version).isNull()).desc(),
        F.col(version).desc(),
        F.col("_from").asc(),
        *(F.col(t).desc() for t in tie),
    ]
    order = Window.partitionBy(*keys).orderBy(*beats)
    return both.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn", "_from")
