"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b); the root is the smallest node that can be reached.

    Each round hangs all neighbours of a node on the smallest of them, once upwards and once downwards;
    rows never become more than the links. A round reads and writes the shared checkpoint folder, and
    only its count and checksum come to the driver. The rounds grow with the logarithm of the longest
    path.
    """
    edges = cut(_clean(links.select("a", "b")))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _clean(large)
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(down, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(_clean(small.unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b")))))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def _clean(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
