"""Partial aggregates per group that batches are merged into (A-1, A-3).

The state is a log of partial rows. A batch that only brings new rows to a group adds one partial row for it.
Where a batch changes or takes away rows, which neither a sum of fractions nor a maximum can forget exactly,
the group is aggregated again from its rows and a `base` row is added, which replaces what was logged for the
group before. Reading combines the rows since each group's last base. Nothing logged is ever rewritten,
and logging a run again overwrites that run's rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.sources.tables import BEFORE, CHANGE

RUN, BASE, COUNT = "run", "base", "n"
# Rows that a group of changed rows lost or that were replaced in it.
LOST = "_lost"


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def among(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """The rows whose keys are (or, with "left_anti", are not) among the groups; a NULL key is a key."""
    wanted = groups.select(*(F.col(k).alias(f"_k_{k}") for k in keys))
    return rows.join(wanted, same_keys(keys, [f"_k_{k}" for k in keys]), how)


@dataclass(frozen=True)
class Partials:
    """What is kept per group: the number of rows, and named sums, maxima and minima of SQL expressions."""

    keys: tuple[str, ...]
    sums: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)
    minima: Mapping[str, str] = field(default_factory=dict)

    @property
    def measures(self) -> list[str]:
        return [COUNT, *self.sums, *self.maxima, *self.minima]

    def of(self, rows: DataFrame, counted: Column | None = None, *more: Column) -> DataFrame:
        """One partial row per group of plain rows; rows whose `counted` is NULL add nothing to their number."""
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1) if counted is None else counted).alias(COUNT),
            *(F.sum(F.expr(e)).alias(name) for name, e in self.sums.items()),
            *(F.max(F.expr(e)).alias(name) for name, e in self.maxima.items()),
            *(F.min(F.expr(e)).alias(name) for name, e in self.minima.items()),
            *more,
        )

    def combine(self, partial: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """Partial rows of the same group, or of the same coarser `keys`, as one."""
        return partial.groupBy(*(self.keys if keys is None else keys)).agg(
            *(F.sum(name).alias(name) for name in (COUNT, *self.sums)),
            *(F.max(name).alias(name) for name in self.maxima),
            *(F.min(name).alias(name) for name in self.minima),
        )

    def delta(self, changes: DataFrame, current: DataFrame) -> DataFrame:
        """The partial rows that a batch adds: (keys, measures, base).

        `changes` has the images of changed rows before and after (`CHANGE`), `current` all rows as they are
        now; only rows of groups that lost or changed one are read from it. A group that is empty now gets a
        base row with no rows.
        """
        return self.delta_of(self.changed(changes), current)

    def changed(self, changes: DataFrame) -> DataFrame:
        """One row per group that has images of changed rows, with the measures over them and how many rows it lost."""
        return self.of(changes, None, F.count_if(F.col(CHANGE) == BEFORE).alias(LOST))

    def delta_of(self, groups: DataFrame, current: DataFrame) -> DataFrame:
        """`delta` from the `changed` groups, which are looked at several times."""
        # A group that lost nothing has only images of what it gained: its partial row is theirs.
        grown = groups.where(F.col(LOST) == 0).drop(LOST)
        spoiled = groups.where(F.col(LOST) > 0).select(*self.keys)
        # Beside the rows of a spoiled group stands one of its keys alone, so that an empty group has a row too.
        rows = among(current, spoiled, self.keys).withColumn("_real", F.lit(1))
        redone = self.of(rows.unionByName(spoiled, allowMissingColumns=True), F.col("_real"))
        return grown.withColumn(BASE, F.lit(False)).unionByName(redone.withColumn(BASE, F.lit(True)))

    def state(self, log: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """One row per group that has rows, from the logged rows (keys, measures, base, run); runs are in order.

        One shuffle by group; with coarser `keys` a second aggregation follows.
        """
        since = F.max(F.when(F.col(BASE), F.col(RUN))).over(Window.partitionBy(*self.keys))
        counted = log.withColumn("_since", since).where(F.col("_since").isNull() | (F.col(RUN) >= F.col("_since")))
        groups = self.combine(counted).where(F.col(COUNT) > 0)
        return groups if keys is None else self.combine(groups, keys)
