"""Work that is shared, dealt out and done once, seen in plans and jobs."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from activity_engine.operators import normalize as nz
from activity_engine.registry import queries, standins
from activity_engine.sources import landing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def normalised(spark, monkeypatch):
    """Counts how many records are normalised by the queries and operators of a test."""
    seen, plain = spark.sparkContext.accumulator(0), nz.normalize_workouts

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(records, *more):
        return plain(records.select("value").mapInArrow(count, "value string"), *more)

    monkeypatch.setattr(nz, "normalize_workouts", counted)
    return seen


def test_volume_normalises_each_record_once(spark, normalised):
    rows = queries.d5_volume(spark, SF_DIR).collect()
    assert normalised.value == sum(r.valid + r.rejected for r in rows) > 0


@pytest.mark.parametrize("make", [standins.damaged_workouts, standins.damaged_users, standins.damaged_friendships, standins.athletes, standins.activities])
def test_records_of_one_row_group_are_dealt_out(spark, make):
    assert "REPARTITION_BY_COL" in make(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_values_of_a_workout_are_read_once(spark):
    records = spark.createDataFrame([("{}",)], "value string")
    plan = nz.normalize_workouts(records)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("start_time as timestamp") == 1


def test_landing_normalises_each_record_once(spark, normalised, tmp_path):
    records = standins.damaged_workouts(spark, SF_DIR)
    shaped = nz.normalize_workouts(records, "app")
    seen = landing.land(shaped, str(tmp_path), "workouts", "app", F.lit(datetime(2024, 2, 1)), "run-1")
    assert normalised.value == seen.total == records.count()
    assert landing.read_landing(spark, str(tmp_path), "workouts").count() == seen.valid
    rejects = landing.read_rejects(spark, str(tmp_path), "workouts")
    assert rejects.count() == seen.rejected == rejects.where("length(raw) > 2").count() > 0
