"""The activity tables, made from the given tables.

`events` plays the activity feed: signups are profile updates, every other event is a workout, and the
number in `props` decides the attributes. `embeddings` rows are the heart-rate samples of the workout
with their id. `oracles.py` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.functions.nested import EMPTY_SAMPLES
from activity_engine.functions.scalars import plus_seconds
from activity_engine.schemas import ENTITIES
from activity_engine.session import tune

GOALS = ["run_a_marathon", "sleep_better", "lift_more"]
# Event type to workout type and metres per minute; "error" is left as a type no dimension knows.
PACE = {"click": ("run", 155.0), "view": ("walk", 72.0), "purchase": ("ride", 390.0)}


# Declared columns of the given tables. Their zoneless timestamps are read as UTC instants, so that
# time filters still reach the Parquet scan.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tune(spark).read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number `k` of their props."""
    return read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The same rows dealt out by a key. A file in few row groups is read by as few tasks, whatever its size, and
    the texts made of its rows would be parsed by these alone; the plain rows move before they are made."""
    return rows.repartition(key)


def prefixed(prefix: str, col: Column | str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))


def by_type(values: dict[str, object]) -> Column:
    chosen = F.lit(None)
    for event_type, value in values.items():
        chosen = F.when(F.col("event_type") == event_type, F.lit(value)).otherwise(chosen)
    return chosen


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile log: each signup is a new version of the user."""
    goal = F.element_at(F.array(*map(F.lit, GOALS)), (F.col("k") % len(GOALS) + 1).cast("int"))
    return events(spark, sf_dir).where(F.col("event_type") == "signup").select(
        prefixed("u-", "user_id").alias("user_id"),
        F.lit("app").alias("source"),
        prefixed("User ", "user_id").alias("display_name"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        (F.lit(18) + F.col("k") % 50).cast("bigint").alias("age"),
        (F.lit(50.0) + F.col("value") / 10).alias("weight_kg"),
        (F.lit(150.0) + F.col("k") / 2).cast("double").alias("height_cm"),
        goal.alias("fitness_goal"),
        F.col("ts").alias("updated_at"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample values per workout id, still without their times."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("event_id"), "embedding")


def first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workouts as first delivered: k 0 has a negative distance, k 1 runs two days too long, k 2 has
    no calories, and from k 85 on a workout is synced days late."""
    e = events(spark, sf_dir).where(F.col("event_type") != "signup").join(samples(spark, sf_dir), "event_id", "left")
    k, minutes = F.col("k"), F.col("value")
    seconds = F.round(minutes * 60)
    end = plus_seconds("ts", seconds + F.when(k == 1, F.lit(172800)).otherwise(F.lit(0)))
    delay = F.when(k >= 85, (k - 84) * 86400).otherwise(k * 60)
    pace = by_type({t: p for t, (_, p) in PACE.items()})
    distance = F.when(k == 0, -minutes * pace).otherwise(minutes * pace)
    readings = F.transform(
        "embedding",
        lambda x, i: F.struct(
            plus_seconds("ts", i * 60).alias("ts"),
            F.round(F.lit(130.0) + F.lit(100.0) * x.cast("double")).cast("bigint").alias("heart_rate_bpm"),
            F.lit(None).cast("double").alias("lat"),
            F.lit(None).cast("double").alias("lon"),
            F.lit(None).cast("double").alias("elevation_m"),
        ),
    )
    return e.select(
        prefixed("w-", "event_id").alias("workout_id"),
        prefixed("u-", "user_id").alias("user_id"),
        F.lit("app").alias("source"),
        F.coalesce(by_type({t: name for t, (name, _) in PACE.items()}), F.col("event_type")).alias("workout_type"),
        F.col("ts").alias("start_time"),
        end.alias("end_time"),
        prefixed("device-", "user_id").alias("device_id"),
        plus_seconds("ts", delay).alias("synced_at"),
        F.round(distance, 3).alias("distance_meters"),
        F.when(k != 2, F.round(minutes * 8, 2)).alias("calories"),
        F.coalesce(readings, F.array().cast(EMPTY_SAMPLES)).alias("samples"),
        "k",
    )


def raw_workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries, plus a corrected second one, an hour later, where k is under 10."""
    deliveries = F.when(F.col("k") < 10, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = first_deliveries(spark, sf_dir).withColumn("again", F.explode(deliveries))
    corrected = {
        "synced_at": plus_seconds("synced_at", F.col("again") * 3600),
        "calories": F.col("calories") + F.col("again"),
    }
    return sent.withColumns(corrected).select(*ENTITIES["workouts"].columns)


def raw_friendships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event ties its user to the user numbered k, in both directions, again and again."""
    e = events(spark, sf_dir).where(F.col("user_id") != F.col("k"))
    one, other = prefixed("u-", "user_id"), prefixed("u-", "k")
    ways = F.array(
        F.struct(one.alias("user_id"), other.alias("friend_user_id")),
        F.struct(other.alias("user_id"), one.alias("friend_user_id")),
    )
    return e.select(F.explode(ways).alias("way"), F.lit("app").alias("source"), F.col("ts").alias("created_at")).select(
        "way.*", "source", "created_at"
    )


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    """Stands for today: the day of the last event."""
    return read(spark, sf_dir, "events").select(F.max(F.to_date("ts"))).scalar()


def last_moment(spark: SparkSession, sf_dir: str) -> Column:
    """Stands for now: the time of the last event."""
    return read(spark, sf_dir, "events").select(F.max("ts")).scalar()


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log from orders: one customer version per order day, at the highest price of that day."""
    return (
        read(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("changed_at"))
        .agg(F.max("o_totalprice").alias("price"), F.min("o_orderpriority").alias("priority"))
    )


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def iso(ts: Column | str) -> Column:
    """ISO-8601 text in JSON quotes."""
    return quoted(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def member(name: str, value: Column, keep: Column | None = None) -> Column:
    """One JSON member; left out where `keep` is false."""
    text = F.concat(F.lit(f'"{name}":'), value)
    return text if keep is None else F.when(keep, text)


def json_object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def damaged_workouts(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Raw workout JSON, one text per event; k decides what is wrong with a record: one of the known
    faults, an explicit null for samples, text that is no JSON, or nothing. `again` gives a second delivery
    of those with k under 14, an hour later."""
    e = events(spark, sf_dir)
    hours = F.lit(0)
    if again:
        e, hours = e.where(F.col("k") < 14), F.lit(1)
    e, k, value = dealt(e, "event_id"), F.col("k"), F.col("value").cast("string")
    reading = F.concat(
        F.lit('[{"ts":'), iso("ts"), F.lit(',"heart_rate_bpm":'), k.cast("string"), F.lit("}]")
    )
    body = json_object(
        member("workout_id", quoted(prefixed("w-", "event_id"))),
        member("user_id", F.when(k == 11, F.lit("null")).otherwise(quoted(prefixed("u-", "user_id")))),
        member("workout_type", quoted(F.col("event_type")), k != 12),
        member("start_time", iso("ts")),
        member("end_time", iso(plus_seconds("ts", F.round(F.col("value") * 60)))),
        member("device_id", quoted(prefixed("device-", "user_id")), k != 10),
        member("synced_at", iso(plus_seconds("ts", k * 60 + hours * 3600))),
        member("distance_meters", F.when(k == 15, F.lit("null")).otherwise(value)),
        member("calories", F.when(k == 13, F.lit('"n/a"')).when(k == 16, quoted(value)).otherwise(value)),
        member(
            "samples",
            F.when(k == 14, F.lit('"three"'))
            .when(k == 17, F.lit("null"))
            .when(k == 19, F.lit("[]"))
            .when(k == 21, F.lit('[{"ts":"noon","heart_rate_bpm":21}]'))
            .when(k == 22, F.concat(F.lit('[{"ts":'), iso("ts"), F.lit(',"heart_rate_bpm":"fast"}]')))
            .when(k == 23, F.lit("[1,2]"))
            .otherwise(reading),
            k != 18,
        ),
    )
    return e.select(F.when(k == 20, F.concat(F.lit("broken "), body)).otherwise(body).alias("value"))


def damaged_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user JSON, one text per signup: absent, null or unreadable fields by k."""
    e = dealt(events(spark, sf_dir).where(F.col("event_type") == "signup"), "event_id")
    k, value = F.col("k"), F.col("value").cast("string")
    body = json_object(
        member("user_id", quoted(prefixed("u-", "user_id"))),
        member("display_name", quoted(prefixed("User ", "user_id")), k != 30),
        member("email", F.when(k == 31, F.lit("null")).otherwise(quoted(prefixed("mail-", "user_id")))),
        member("age", F.when(k == 32, F.lit('"old"')).when(k == 33, quoted(k.cast("string"))).otherwise(k.cast("string"))),
        member("weight_kg", F.when(k == 34, quoted(value)).otherwise(value)),
        member("height_cm", F.when(k == 35, F.lit("[]")).otherwise(value)),
        member("fitness_goal", quoted(F.lit("sleep_better")), ~k.isin(30, 36)),
        member("updated_at", F.when(k == 37, F.lit('"yesterday"')).otherwise(iso("ts"))),
    )
    return e.select(body.alias("value"))


def damaged_friendships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw friendship JSON, one text per event; some friends are missing by k."""
    e = dealt(events(spark, sf_dir), "event_id")
    k = F.col("k")
    body = json_object(
        member("user_id", quoted(prefixed("u-", "user_id"))),
        member("friend_user_id", quoted(prefixed("u-", "k")), k != 40),
        member("created_at", F.when(k == 41, F.lit("null")).otherwise(iso("ts"))),
    )
    return e.select(body.alias("value"))


def athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-party athlete JSON from customers: the name is cut in two, and segment decides what is
    given: first name only, last name only, neither, an empty mail, or no weight."""
    c = dealt(read(spark, sf_dir, "customer"), "c_custkey")
    segment = F.col("c_mktsegment")
    first, last = F.substring_index("c_name", "#", 1), F.substring_index("c_name", "#", -1)
    weight = F.when(F.col("c_acctbal") < 0, F.lit("0")).otherwise(F.col("c_acctbal").cast("string"))
    body = json_object(
        member("id", F.col("c_custkey").cast("string"), F.col("c_nationkey") != 24),
        member("firstname", quoted(first), ~segment.isin("BUILDING", "MACHINERY")),
        member("lastname", quoted(last), ~segment.isin("FURNITURE", "MACHINERY")),
        member("email", F.when(segment == "AUTOMOBILE", F.lit('""')).otherwise(quoted(F.lower(last)))),
        member("weight", weight, segment != "HOUSEHOLD"),
        member("updated_at", quoted(F.lit("2024-01-05T06:07:08Z")), F.col("c_nationkey") > 5),
    )
    return c.select(body.alias("value"))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-party activity JSON from orders: the priority decides type and streams, the status what
    is missing."""
    o = dealt(read(spark, sf_dir, "orders"), "o_orderkey")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    odd = F.col("o_orderkey") % 50
    streams = (
        F.when(odd == 0, F.lit('{"time":{"data":["late"]}}'))
        .when(odd == 1, F.lit('{"time":{"data":[0]},"heartrate":{"data":["fast"]}}'))
        .when(
            priority == "1-URGENT",
            F.lit(
                '{"time":{"data":[0,5,10]},"heartrate":{"data":[120,130]},'
                '"latlng":{"data":[[1.5,2.5]]},"altitude":{"data":[7,8,9,10]}}'
            ),
        )
        .when(priority == "2-HIGH", F.lit('{"heartrate":{"data":[99]}}'))
        .when(priority == "3-MEDIUM", F.lit("{}"))
        .otherwise(F.lit('{"time":{"data":[1.5]}}'))
    )
    kind = F.when(priority == "1-URGENT", F.lit("TrailRun")).when(priority == "2-HIGH", F.lit("Rowing")).otherwise(
        F.lit("Yoga")
    )
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    body = json_object(
        member("id", F.col("o_orderkey").cast("string")),
        member("athlete", F.concat(F.lit('{"id":'), F.col("o_custkey").cast("string"), F.lit("}")), status != "P"),
        member("type", quoted(kind)),
        member("start_date", quoted(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))),
        member("elapsed_time", (F.col("o_orderkey") % 7200).cast("string")),
        member("distance", price, priority != "5-LOW"),
        member("calories", F.when(status == "F", F.lit("null")).otherwise(price)),
        member("device_name", quoted(F.lit("watch")), status == "O"),
        member("_synced_at", iso(plus_seconds("o_orderdate", F.lit(86400))), priority != "3-MEDIUM"),
        member("_streams", streams),
    )
    return o.select(body.alias("value"))
