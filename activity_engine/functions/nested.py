"""Functions over array columns: one row in, one row out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_engine.functions.scalars import plus_seconds

EMPTY_SAMPLES = "array<struct<ts:timestamp,heart_rate_bpm:bigint,lat:double,lon:double,elevation_m:double>>"


def array_mean(values: Column) -> Column:
    """Mean of the non-null elements; NULL for a null or empty array."""
    present = F.filter(values, lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.try_divide(total, F.size(present).cast("double"))


def count_present(values: Column) -> Column:
    return F.size(F.filter(values, lambda x: x.isNotNull())).cast("bigint")


def sample_stats(samples: str = "samples") -> dict[str, Column]:
    """Heart-rate measures of a nested sample list.

    A workout without samples has no measures at all, its sample count included (NULL, not 0).
    """
    hr, ts = F.col(f"{samples}.heart_rate_bpm"), F.col(f"{samples}.ts")
    has_any = F.size(F.col(samples)) > 0
    return {
        "avg_heart_rate_bpm": array_mean(hr),
        "max_heart_rate_bpm": F.array_max(hr),
        "min_heart_rate_bpm": F.array_min(hr),
        "sample_count": F.when(has_any, count_present(ts)),
    }


def bound_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` worked out once, however often a lambda inside refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def zip_streams(time: Column, heart_rate: Column, latlng: Column, altitude: Column, start: Column) -> Column:
    """Parallel arrays to one array of samples, as long as `time`; shorter arrays give NULLs.

    The arrays are zipped first and each sample sees only its own element: an array expression inside
    the lambda would be worked out again for every sample.
    """
    streams = {"time": time, "rate": heart_rate, "place": latlng, "height": altitude}
    present = [F.coalesce(c, F.array()).alias(name) for name, c in streams.items()]
    length = F.coalesce(F.size(time), F.lit(0))
    zipped = F.slice(F.arrays_zip(*present), 1, F.greatest(length, F.lit(0)))

    def sample(first: Column) -> Callable[[Column], Column]:
        return lambda x: F.struct(
            plus_seconds(first, x["time"]).alias("ts"),
            x["rate"].cast("bigint").alias("heart_rate_bpm"),
            F.get(x["place"], F.lit(0)).cast("double").alias("lat"),
            F.get(x["place"], F.lit(1)).cast("double").alias("lon"),
            x["height"].cast("double").alias("elevation_m"),
        )

    samples = bound_once(start, lambda first: F.transform(zipped, sample(first)))
    return F.coalesce(samples, F.array().cast(EMPTY_SAMPLES))
