"""Plans of the main queries: what is pushed down, how often is shuffled, no nested loops."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["m4_fact_workout", "m5_daily_metrics", "m6_leaderboard", "j2_asof_split", "j5_dense_user_days"])
def test_no_pairs_are_made(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "p_predicates")
    assert "GreaterThanOrEqual(l_quantity,5.0)" in text and "LessThan(l_shipdate" in text
    assert "l_comment" not in text and "l_extendedprice" not in text


def test_asof_join_sorts_once_and_joins_nothing(spark):
    text = plan(spark, "j2_asof_scd2")
    # The only join is the one that finds the customer of a line.
    assert text.count("Join ") == 1
    assert text.count("Window [last(") == 1


def test_unused_samples_are_not_read(spark):
    assert "embedding:array" not in plan(spark, "m5_daily_metrics")


def test_dense_grid_is_not_shuffled(spark):
    text = plan(spark, "m5_daily_metrics")
    grid = text.index("Generate posexplode")
    assert "Exchange" not in text[:grid]


def test_samples_are_shuffled_once(spark):
    text = plan(spark, "m4_fact_workout")
    # The dedupe moves the samples; type and date are broadcast, the user link is joined in place.
    assert text.count("SortMergeJoin") == 1 and "SortMergeJoin [workout_id" in text


@pytest.mark.parametrize("name", ["u2_bucketed", "j2_bucketed"])
def test_stored_buckets_are_joined_where_they_lie(spark, name):
    # Broadcasting would hide it.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in text and "SortMergeJoin" in text


def test_a_week_needs_no_grid(spark):
    assert "posexplode" not in plan(spark, "m6_leaderboard").lower()
