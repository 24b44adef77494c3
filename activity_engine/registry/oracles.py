"""Expected results of the registered queries, as DuckDB SQL over the given tables.

Written from the meaning of each operator, not from its Spark form: an as-of join is a join on the
interval, a rank is a window, a dense grid is a cross product. `VIEWS` states the stand-in tables and
models as common table expressions; `sql` puts the needed ones in front of a query.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
SQL: dict[str, str] = {}


def micros_text(ts: str) -> str:
    """Text of an instant as the surrogate keys use it."""
    us = f"(extract(microseconds from {ts}) % 1000000)"
    fraction = (
        f"case when {us} = 0 then '' when {us} % 1000 = 0 then '.' || lpad(cast({us} // 1000 as varchar), 3, '0') "
        f"else '.' || lpad(cast({us} as varchar), 6, '0') end"
    )
    return f"(strftime({ts}, '%Y-%m-%d %H:%M:%S') || {fraction} || '+00')"


def key(*parts: str) -> str:
    texts = (f"coalesce(cast({p} as varchar), '_dbt_utils_surrogate_key_null_')" for p in parts)
    return "md5(" + " || '-' || ".join(texts) + ")"


def sql(body: str) -> str:
    """Put the common table expressions that `body` uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(view)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed) + "\n" + body


VIEWS["ev"] = "select *, cast(props ->> '$.k' as bigint) as k from events"

VIEWS["last_day"] = "select cast(max(ts) as date) as today, max(ts) as this_moment from events"

VIEWS["first_day"] = "select cast(min(ts) as date) as first_event from events"

VIEWS["app_users"] = """
select 'u-' || user_id as user_id, 'app' as source, 'User ' || user_id as display_name,
  'user' || user_id || '@example.com' as email, 18 + k % 50 as age,
  50 + value / 10 as weight_kg, 150 + k / 2 as height_cm,
  (['run_a_marathon', 'sleep_better', 'lift_more'])[k % 3 + 1] as fitness_goal,
  ts as updated_at
from ev where event_type = 'signup'"""

VIEWS["first_workouts"] = """
select 'w-' || event_id as workout_id, 'u-' || user_id as user_id, 'app' as source,
  case event_type when 'click' then 'run' when 'view' then 'walk' when 'purchase' then 'ride' else event_type end as workout_type,
  ts as start_time,
  ts + to_seconds(cast(round(value * 60) as bigint) + case when k = 1 then 172800 else 0 end) as end_time,
  'device-' || user_id as device_id,
  ts + to_seconds(case when k >= 85 then (k - 84) * 86400 else k * 60 end) as synced_at,
  round(case when k = 0 then -value else value end
    * case event_type when 'click' then 155 when 'view' then 72 when 'purchase' then 390 end, 3) as distance_meters,
  case when k <> 2 then round(value * 8, 2) end as calories,
  case when embedding is null then [] else [cast(round(130 + 100 * cast(x as double)) as bigint) for x in embedding] end as rates,
  k
from ev left join embeddings on vec_id = event_id where event_type <> 'signup'"""

VIEWS["app_workouts"] = """
select * from first_workouts
union all
select * replace (synced_at + interval 1 hour as synced_at, calories + 1 as calories) from first_workouts where k < 10"""

VIEWS["app_edges"] = """
select 'u-' || user_id as user_id, 'u-' || k as friend_user_id, 'app' as source, ts as created_at from ev where user_id <> k
union all
select 'u-' || k, 'u-' || user_id, 'app', ts from ev where user_id <> k"""

VIEWS["clean_workouts"] = """
select * exclude (rn), source as source_system, date_sub('minute', start_time, end_time) as duration_minutes
from (select *, row_number() over (partition by workout_id order by synced_at desc) as rn from app_workouts) where rn = 1"""

VIEWS["clean_users"] = """
select * exclude (rn, source), source as source_system
from (select *, row_number() over (partition by user_id, source order by updated_at desc) as rn from app_users) where rn = 1"""

VIEWS["clean_edges"] = """
select user_id, friend_user_id, min(source) as source_system, max(created_at) as created_at
from app_edges group by user_id, friend_user_id"""

VIEWS["user_versions"] = f"""
select {key('user_id', micros_text('updated_at'))} as user_sk, user_id, source as source_system, display_name, email, age,
  weight_kg, height_cm, fitness_goal, updated_at as valid_from,
  coalesce(lead(updated_at) over w, timestamp '9999-12-31') as valid_to,
  lead(updated_at) over w is null as is_current
from app_users window w as (partition by user_id order by updated_at)"""

VIEWS["spine"] = f"""
select {key('date_day')} as date_sk, date_day from (
  select cast(unnest(generate_series(timestamp '2024-01-01', (select today from last_day) + interval 1 year, interval 1 day)) as date) as date_day)"""

# The seven types of the seed.
VIEWS["kinds"] = f"""
select {key('workout_type')} as exercise_type_sk, * from (values ('run', 'cardio', true, 9.8), ('ride', 'cardio', true, 7.5),
  ('swim', 'cardio', true, 8.3), ('walk', 'cardio', true, 3.5), ('hike', 'cardio', true, 6.0),
  ('strength', 'strength', false, 5.0), ('rower', 'cardio', true, 7.0)) t(workout_type, category, is_cardio, met_value)"""

# Times and rates of a workout's samples, as one text for comparison.
SAMPLE_TEXT = (
    "array_to_string([strftime(start_time + to_minutes(i - 1), '%d %H:%M:%S') || '=' || rates[i] for i in range(1, len(rates) + 1)], ' ')"
)

VIEWS["sample_rows"] = "select workout_id, unnest(rates) as rate from clean_workouts"

VIEWS["pulse"] = """
select workout_id, list_avg(rates) as mean_rate, list_max(rates) as top_rate, list_min(rates) as low_rate, len(rates) as readings
from clean_workouts where len(rates) > 0"""

# The user's version at a time is the newest that is not later; types and days are looked up one by one.
VIEWS["workout_facts"] = f"""
select {key('workout_id')} as workout_sk, workout_id, user_id,
  (select arg_max(v.user_sk, v.valid_from) from user_versions v where v.user_id = c.user_id and v.valid_from <= c.start_time) as user_sk,
  (select exercise_type_sk from kinds where kinds.workout_type = c.workout_type) as exercise_type_sk,
  (select date_sk from spine where date_day = cast(c.start_time as date)) as workout_date_sk,
  workout_type, source_system, start_time, end_time, duration_minutes, device_id, distance_meters, calories,
  (select mean_rate from pulse where pulse.workout_id = c.workout_id) as avg_heart_rate_bpm,
  (select top_rate from pulse where pulse.workout_id = c.workout_id) as max_heart_rate_bpm,
  (select low_rate from pulse where pulse.workout_id = c.workout_id) as min_heart_rate_bpm,
  (select readings from pulse where pulse.workout_id = c.workout_id) as sample_count,
  {SAMPLE_TEXT} as samples
from clean_workouts c"""

# A user's figures of a day, each straight from the workouts of the days it spans.
VIEWS["member_days"] = """
select user_id, user_sk, first_day, unnest(range(first_day, today + interval 1 day, interval 1 day)) as moment
from user_versions, last_day, (select min(cast(start_time as date)) as first_day from clean_workouts) where is_current"""

VIEWS["day_facts"] = f"""
select {key('user_id', 'date_day')} as daily_metric_sk, user_id, user_sk, date_day, workout_count, total_duration_minutes,
  total_distance_meters, total_calories, week_minutes / least(7, date_day - first_day + 1) as rolling_7d_avg_duration_minutes,
  case when old_minutes <> 0 then (week_minutes - old_minutes) / old_minutes end as week_over_week_duration_pct_change,
  case when workout_count > 0 then date_day - last_before end as days_since_previous_workout
from (
  select m.user_id, any_value(m.user_sk) as user_sk, cast(m.moment as date) as date_day, any_value(m.first_day) as first_day,
    count(*) filter (age = 0) as workout_count,
    cast(coalesce(sum(duration_minutes) filter (age = 0), 0) as bigint) as total_duration_minutes,
    coalesce(sum(distance_meters) filter (age = 0), 0) as total_distance_meters,
    coalesce(sum(calories) filter (age = 0), 0) as total_calories,
    coalesce(sum(duration_minutes) filter (age between 0 and 6), 0) as week_minutes,
    coalesce(sum(duration_minutes) filter (age between 7 and 13), 0) as old_minutes,
    max(cast(start_time as date)) filter (age > 0) as last_before
  from (select m.*, w.* exclude (user_id), cast(m.moment as date) - cast(w.start_time as date) as age
        from member_days m left join clean_workouts w on w.user_id = m.user_id) m
  group by m.user_id, m.moment)"""

# A member's place is one more than the number of members of the same board with a longer distance.
VIEWS["circle"] = """
select user_id, friend_user_id as member_user_id from clean_edges union all select user_id, user_id from user_versions where is_current"""

VIEWS["week_of"] = """
select user_id as member_user_id, display_name as member_name,
  (select coalesce(sum(distance_meters), 0) from clean_workouts w, last_day where w.user_id = v.user_id
   and cast(w.start_time as date) between today - 6 and today) as distance_7d,
  (select count(*) from clean_workouts w, last_day where w.user_id = v.user_id
   and cast(w.start_time as date) between today - 6 and today) as workouts_7d
from user_versions v where is_current"""

VIEWS["board"] = """
select c.user_id, c.member_user_id, member_name, distance_7d, workouts_7d,
  1 + (select count(*) from circle o join week_of x on x.member_user_id = o.member_user_id
       where o.user_id = c.user_id and x.distance_7d > m.distance_7d) as rank_by_distance
from circle c join week_of m on m.member_user_id = c.member_user_id"""

VIEWS["records"] = """
select user_id, workout_type, max(distance_meters) as best_distance_meters, max(duration_minutes) as longest_duration_minutes,
  max(calories) as most_calories_burned,
  min(case when distance_meters > 0 then duration_minutes / (distance_meters / 1000) end) as best_pace_min_per_km
from clean_workouts group by 1, 2"""

VIEWS["keyed"] = "select distinct case when k >= 33 then user_id end as key, ts from ev"

VIEWS["placed"] = "select event_id, case when k < 70 then event_type end as grp, case when k % 3 > 0 then k end as m from ev"

VIEWS["buyer_log"] = """
select o_custkey as custkey, o_orderdate as changed_at, max(o_totalprice) as price, min(o_orderpriority) as priority
from orders group by 1, 2"""

VIEWS["buyer_versions"] = """
select *, changed_at as valid_from, lead(changed_at) over (partition by custkey order by changed_at) as valid_to from buyer_log"""


def rounded(names: str) -> str:
    return ", ".join(f"round({n.strip()}, 6) as {n.strip()}" for n in names.split(","))


# --- dedupe and upsert -------------------------------------------------------------------------

SQL["u1_latest_per_key"] = """
select * exclude (rn) from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1"""

SQL["u1_late_rows"] = SQL["u1_latest_per_key"]

SQL["u4_stg_workouts"] = f"""
select workout_id, user_id, source_system, workout_type, start_time, end_time, duration_minutes, device_id, synced_at,
  distance_meters, calories, {SAMPLE_TEXT} as samples from clean_workouts"""

SQL["u4_late_rows"] = SQL["u4_stg_workouts"]

SQL["u5_stg_users"] = f"select * replace ({rounded('weight_kg, height_cm')}) from clean_users"

SQL["u6_stg_friendships"] = "select * from clean_edges"

VIEWS["upsert_target"] = """
select user_id, event_type, max(ts) as ts, arg_max(value, ts) as value from events where event_type <> 'error' group by 1, 2"""

VIEWS["shifted"] = """
select user_id, event_type, ts, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, value desc) as rn
  from (select user_id, event_type, ts + to_hours(cast(k as integer) - 50) as ts, value + 1000 as value from ev)) where rn = 1"""

VIEWS["repeated"] = """
select user_id, event_type, max(ts) as ts, arg_max(value, ts) + 1000 as value from events group by 1, 2"""

UPSERT = """
select coalesce(t.user_id, s.user_id) as user_id, coalesce(t.event_type, s.event_type) as event_type,
  case when t.ts is null or s.ts > t.ts then s.ts else t.ts end as ts,
  round(case when t.ts is null or s.ts > t.ts then s.value else t.value end, 6) as value
from upsert_target t full join {source} s on s.user_id = t.user_id and s.event_type = t.event_type"""

SQL["u2_upsert_newest"] = UPSERT.format(source="shifted")
SQL["u2_bucketed"] = SQL["u2_upsert_newest"]
SQL["u2_upsert_equal_version"] = UPSERT.format(source="repeated")

# --- type-2 history ----------------------------------------------------------------------------

# Each run sees the latest version of a customer; the versions ever seen make up the history.
SQL["v1_snapshot_three_batches"] = """
select custkey, changed_at, price, priority, changed_at as valid_from,
  lead(changed_at) over (partition by custkey order by changed_at) as valid_to
from (select distinct b.custkey, b.changed_at, b.price, b.priority
      from buyer_log b, (values (timestamp '1997-01-01'), (timestamp '1999-06-01'), (timestamp '2001-12-31')) run(moment)
      where b.changed_at = (select max(c.changed_at) from buyer_log c where c.custkey = b.custkey and c.changed_at <= run.moment))"""

# A version is recorded if some run's moment falls between it and the next version.
VIEWS["run_moments"] = """
select 3 as runs, moment from (values (timestamp '1997-01-01'), (timestamp '1999-06-01'), (timestamp '2001-12-31')) t(moment)
union all
select 84, unnest(generate_series(timestamp '1992-01-01', timestamp '1998-12-01', interval 1 month))"""

SQL["v1_snapshots_one_pass"] = """
select custkey, changed_at, price, priority, changed_at as valid_from,
  lead(changed_at) over (partition by runs, custkey order by changed_at) as valid_to, cast(runs as integer) as runs
from (select distinct r.runs, b.* from run_moments r join buyer_log b
      on b.changed_at = (select max(c.changed_at) from buyer_log c where c.custkey = b.custkey and c.changed_at <= r.moment))"""

SQL["v2_scd2_history"] = "select * from buyer_versions"
SQL["v2_null_keys_split"] = """
select key, ts, ts as valid_from, (select min(o.ts) from keyed o where o.key is not distinct from k.key and o.ts > k.ts) as valid_to
from keyed k"""

SQL["v2_scd2_history_split"] = SQL["v2_scd2_history"]

USER_TEXT = f"""
select * replace ({rounded('weight_kg, height_cm')}, strftime(valid_to, '%Y-%m-%d %H:%M:%S') as valid_to) from user_versions"""
SQL["v3_dim_user"] = USER_TEXT
SQL["v4_current"] = USER_TEXT + " where is_current"

# --- joins and grids ---------------------------------------------------------------------------

ASOF = """
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, o_custkey as custkey, v.price, v.priority, v.valid_from
from lineitem join orders on o_orderkey = l_orderkey
{how} join buyer_versions v on v.custkey = o_custkey and l_shipdate >= v.valid_from
  and (v.valid_to is null or l_shipdate < v.valid_to)"""
SQL["j2_asof_scd2"] = ASOF.format(how="left")
SQL["j2_overlap_both"] = """
select way, event_id, case when ts < since + interval 10 day then version end as version
from (select b.event_id, b.ts, max(s.ts) as since, arg_max(s.event_id, (s.ts, s.event_id)) as version
      from events b left join events s on s.event_type = 'signup' and s.user_id = b.user_id and s.ts <= b.ts
      where b.event_type = 'purchase' group by 1, 2), (values ('broadcast'), ('merge')) w(way)"""

SQL["j2_asof_split"] = SQL["j2_asof_scd2"]
SQL["j2_bucketed"] = SQL["j2_asof_scd2"]
SQL["j2_asof_small_dim"] = ASOF.format(how="inner")

SQL["j5_dense_user_days"] = """
select u.user_id, g.date_day, coalesce(p.n, 0) as n, round(coalesce(p.total, 0), 6) as total
from (select distinct user_id from events where event_type = 'signup') u
cross join (select cast(unnest(generate_series(min(ts) filter (event_type = 'purchase'), max(ts) + interval 1 day, interval 1 day)) as date) as date_day from events) g
left join (select user_id, cast(ts as date) as date_day, count(*) as n, sum(value) as total from events
           where event_type = 'purchase' group by 1, 2) p on p.user_id = u.user_id and p.date_day = g.date_day
where g.date_day <= (select today from last_day)"""

SQL["n1_unnest_agg"] = """
select workout_id, round(mean_rate, 6) as avg_heart_rate_bpm, top_rate as max_heart_rate_bpm, low_rate as min_heart_rate_bpm,
  readings as sample_count from pulse"""
SQL["n2_sample_stats"] = """
select workout_id, round(mean_rate, 6) as avg_heart_rate_bpm, top_rate as max_heart_rate_bpm, low_rate as min_heart_rate_bpm,
  readings as sample_count from clean_workouts left join pulse using (workout_id)"""
SQL["n2_array_stats"] = """
select vec_id, round(list_avg([cast(x as double) for x in embedding]), 6) as mean,
  round(cast(list_max(embedding) as double), 6) as highest, round(cast(list_min(embedding) as double), 6) as lowest,
  len([x for x in embedding if x > 0]) as positive
from embeddings"""

# --- models ------------------------------------------------------------------------------------

SQL["m1_dim_date"] = f"""
select {key('date_day')} as date_sk, date_day, year(date_day) as year, month(date_day) as month, monthname(date_day) as month_name,
  day(date_day) as day_of_month, dayofweek(date_day) + 1 as day_of_week, dayname(date_day) as day_name,
  cast(strftime(date_day, '%U') as bigint) as week_of_year, quarter(date_day) as quarter,
  dayofweek(date_day) in (0, 6) as is_weekend, date_day = cast(hi as date) as is_today
from (select cast(unnest(generate_series(min(o_orderdate), cast(max(o_orderdate) as date) + interval 1 year, interval 1 day)) as date) as date_day,
      max(o_orderdate) as hi from orders)"""

SQL["m2_dim_type"] = f"""
select {key('workout_type')} as exercise_type_sk, * from (
  select lower(p_type) as workout_type, min(p_brand) as category, max(p_size) > 25 as is_cardio, max(p_retailprice) as met_value
  from part group by 1)"""

SQL["m4_fact_workout"] = "select * replace (round(avg_heart_rate_bpm, 6) as avg_heart_rate_bpm) from workout_facts"

SQL["m5_daily_metrics"] = f"""
select * replace ({rounded('total_distance_meters, total_calories, rolling_7d_avg_duration_minutes, week_over_week_duration_pct_change')})
from day_facts"""

SQL["m6_leaderboard"] = "select * replace (round(distance_7d, 6) as distance_7d) from board"

SQL["m6_leaderboard_split"] = SQL["m6_leaderboard"]

SQL["x3_sparse_rolling"] = """
select user_id, cast(unnest(range(cast(cast(start_time as date) as timestamp), cast(start_time as date) + interval 7 day, interval 1 day)) as date) as date_day,
  duration_minutes, distance_meters from clean_workouts"""
SQL["x3_sparse_rolling"] = f"""
select user_id, date_day, cast(sum(duration_minutes) as bigint) as minutes, round(sum(distance_meters), 6) as metres
from ({SQL["x3_sparse_rolling"]}) group by 1, 2"""

SQL["a4_weekly_sparse"] = """
select user_id, round(sum(distance_meters), 6) as distance_7d, count(*) as workouts_7d from clean_workouts, last_day
where cast(start_time as date) between today - 6 and today group by 1"""

SQL["m7_records"] = f"select * replace ({rounded('best_pace_min_per_km')}) from records"

SQL["m5_incremental"] = SQL["m5_daily_metrics"]

SQL["m7_incremental"] = SQL["m7_records"]

SQL["a1_day_totals"] = """
select user_id, workout_type, cast(start_time as date) as date_day, count(*) as n, cast(sum(duration_minutes) as bigint) as total_duration_minutes,
  round(sum(distance_meters), 6) as total_distance_meters, round(sum(calories), 6) as total_calories,
  max(distance_meters) as best_distance_meters, max(duration_minutes) as longest_duration_minutes, max(calories) as most_calories_burned,
  round(min(case when distance_meters > 0 then duration_minutes / (distance_meters / 1000) end), 6) as best_pace_min_per_km
from clean_workouts group by 1, 2, 3"""

SQL["a3_best_per_group"] = """
select l_suppkey, l_returnflag, max(l_extendedprice) as best_price, max(l_shipdate) as last_ship,
  round(min(case when l_tax > 0 then l_quantity / l_tax end), 6) as lowest_ratio
from lineitem group by 1, 2"""

SQL["x2_rank_with_ties"] = """
select l_orderkey, l_linenumber, l_partkey, l_linestatus, l_quantity,
  rank() over (partition by l_linestatus order by l_quantity desc) as position from lineitem"""

SQL["x2_null_rank_split"] = """
select event_id, p.grp, p.m, 1 + coalesce(sum(o.n) filter (o.m is not null and (p.m is null or o.m > p.m)), 0) as place
from placed p left join (select grp, m, count(*) as n from placed group by 1, 2) o on o.grp is not distinct from p.grp
group by event_id, p.grp, p.m"""

SQL["x2_rank_split"] = """
select o_orderkey, o_orderpriority, o_totalprice,
  rank() over (partition by o_orderpriority order by o_totalprice desc) as position from orders"""

# --- feeds -------------------------------------------------------------------------------------

SQL["d1_trend"] = """
select date_day, cast(sum(workout_count) as bigint) as workouts, cast(sum(total_duration_minutes) as bigint) as duration_minutes,
  round(sum(total_distance_meters), 6) as distance_meters from day_facts group by 1"""

SQL["d2_kpis"] = """
select user_id, cast(sum(workout_count) as bigint) as workouts, cast(sum(total_duration_minutes) as bigint) as duration_minutes,
  round(sum(total_distance_meters), 6) as distance_meters, round(sum(total_calories), 6) as calories,
  count(*) filter (workout_count > 0) as active_days
from day_facts group by 1"""

SQL["d3_session_mix"] = """
select user_id, workout_type, count(*) as sessions, round(count(*) / sum(count(*)) over (partition by user_id), 6) as share
from clean_workouts group by 1, 2"""

SQL["d4_heart_rate_trend"] = """
select user_id, cast(start_time as date) as date_day, round(avg(rate), 6) as avg_heart_rate_bpm, count(*) as sample_count
from sample_rows join clean_workouts using (workout_id) group by 1, 2"""

# --- normalising and rejects -------------------------------------------------------------------

# What is wrong with a raw workout is known from k; see standins.damaged_workouts.
VIEWS["workout_records"] = """
select event_id, k, 'w-' || event_id as workout_id, 'u-' || user_id as user_id, 'app' as source, event_type as workout_type,
  ts as start_time, ts + to_seconds(cast(round(value * 60) as bigint)) as end_time, 'device-' || user_id as device_id,
  ts + to_minutes(k) as synced_at, case when k <> 15 then value end as distance_meters, value as calories,
  cast(case when k in (18, 19) then 0 else 1 end as bigint) as n_samples, case when k not in (18, 19) then ts end as first_ts,
  case when k not in (18, 19) then ts end as last_ts, case when k in (18, 19) then '' else cast(k as varchar) end as rates,
  case when k = 10 then 'malformed workout record ''w-' || event_id || ''': missing/null [''device_id'']'
       when k = 11 then 'malformed workout record ''w-' || event_id || ''': missing/null [''user_id'']'
       when k = 12 then 'malformed workout record ''w-' || event_id || ''': missing/null [''workout_type'']'
       when k = 13 then 'malformed workout record ''w-' || event_id || ''': bad calories value'
       when k in (14, 17) then 'malformed workout record ''w-' || event_id || ''': samples is not a list'
       when k in (21, 22, 23) then 'malformed workout record ''w-' || event_id || ''': bad samples value'
       when k = 20 then 'not a JSON object' end as error
from ev"""

WORKOUT_COLUMNS = """workout_id, user_id, source, workout_type, start_time, end_time, device_id, synced_at, distance_meters,
  calories, n_samples, first_ts, last_ts, rates"""

SQL["i8_valid"] = f"""
select {WORKOUT_COLUMNS}, strftime(synced_at, '%Y-%m-%d') as dt from workout_records where error is null"""

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"

VIEWS["workout_texts"] = f"""
select r.*, case when r.k = 20 then 'broken ' else '' end || '{{"workout_id":"' || workout_id || '","user_id":'
  || case when r.k = 11 then 'null' else '"' || r.user_id || '"' end
  || case when r.k <> 12 then ',"workout_type":"' || workout_type || '"' else '' end
  || ',"start_time":"' || {ISO.format('start_time')} || '","end_time":"' || {ISO.format('end_time')} || '"'
  || case when r.k <> 10 then ',"device_id":"' || device_id || '"' else '' end
  || ',"synced_at":"' || {ISO.format('synced_at')} || '","distance_meters":'
  || case when r.k = 15 then 'null' else cast(ev.value as varchar) end || ',"calories":'
  || case when r.k = 13 then '"n/a"' when r.k = 16 then '"' || cast(ev.value as varchar) || '"' else cast(ev.value as varchar) end
  || case when r.k = 14 then ',"samples":"three"' when r.k = 17 then ',"samples":null' when r.k = 18 then ''
          when r.k = 19 then ',"samples":[]' when r.k = 23 then ',"samples":[1,2]'
          when r.k = 21 then ',"samples":[{{"ts":"noon","heart_rate_bpm":21}}]'
          when r.k = 22 then ',"samples":[{{"ts":"' || {ISO.format('start_time')} || '","heart_rate_bpm":"fast"}}]'
          else ',"samples":[{{"ts":"' || {ISO.format('start_time')} || '","heart_rate_bpm":' || cast(r.k as varchar) || '}}]' end
  || '}}' as raw
from workout_records r join ev using (event_id)"""

SQL["i8_reject_split"] = """
select error, strftime(case when k = 20 then (select today from last_day) else cast(synced_at as date) end, '%Y-%m-%d') as dt,
  md5(raw) as raw_md5
from workout_texts where error is not null"""

SQL["d5_volume"] = """
select 'app' as source, strftime(case when k = 20 then (select today from last_day) else cast(synced_at as date) end, '%Y-%m-%d') as dt,
  count(*) filter (error is null) as valid, count(*) filter (error is not null) as rejected
from workout_records group by 2"""

VIEWS["user_records"] = """
select 'u-' || user_id as user_id, 'app' as source, 'User ' || user_id as display_name, 'mail-' || user_id as email, k as age,
  value as weight_kg, value as height_cm, 'sleep_better' as fitness_goal, ts as updated_at, k,
  case when k = 30 then 'missing/null [''display_name'', ''fitness_goal'']' when k = 31 then 'missing/null [''email'']'
       when k = 32 then 'bad age value' when k = 35 then 'bad height_cm value' when k = 36 then 'missing/null [''fitness_goal'']'
       when k = 37 then 'bad updated_at value' end as fault
from ev where event_type = 'signup'"""

SQL["i1_users_valid"] = """
select * exclude (k, fault), strftime(updated_at, '%Y-%m-%d') as dt from user_records where fault is null"""

SQL["i1_users_rejected"] = """
select 'malformed user record ''' || user_id || ''': ' || fault as error,
  case when k = 37 then 'yesterday' else strftime(updated_at, '%Y-%m-%d') end as dt, count(*) as n
from user_records where fault is not null group by 1, 2"""

SQL["i2_friendships"] = """
select case when error is null then u end as user_id, case when error is null then f end as friend_user_id, error,
  count(*) as n, max(case when k <> 41 then ts end) as mark
from (select *, 'u-' || user_id as u, 'u-' || k as f,
        case when k = 40 then 'malformed friendship record: missing/null [''friend_user_id'']'
             when k = 41 then 'malformed friendship record: missing/null [''created_at'']' end as error from ev)
group by 1, 2, 3"""

SQL["i4_user_from_athlete"] = """
select case when ok then id end as user_id, case when ok then 'strava' end as source,
  case when not ok then null when c_mktsegment = 'BUILDING' then last when c_mktsegment = 'FURNITURE' then 'Customer'
       when c_mktsegment = 'MACHINERY' then 'Athlete ' || c_custkey else 'Customer ' || last end as display_name,
  case when not ok then null when c_mktsegment = 'AUTOMOBILE' then id || '@unknown.example' else last end as email,
  cast(null as bigint) as age,
  case when ok and c_mktsegment <> 'HOUSEHOLD' and c_acctbal > 0 then c_acctbal end as weight_kg,
  cast(null as double) as height_cm, cast(null as varchar) as fitness_goal,
  case when not ok then null when c_nationkey > 5 then timestamp '2024-01-05 06:07:08' else (select this_moment from last_day) end as updated_at,
  case when not ok then 'malformed athlete record None: missing [''id'']' end as error,
  case when c_nationkey > 5 then '2024-01-05' else strftime((select today from last_day), '%Y-%m-%d') end as dt
from (select *, c_nationkey <> 24 as ok, 'strava-' || c_custkey as id, split_part(c_name, '#', 2) as last from customer)"""

SQL["i5_workout_from_activity"] = """
select case when ok then 'strava-' || o_orderkey end as workout_id, case when ok then 'strava-' || o_custkey end as user_id,
  case when ok then 'strava' end as source,
  case when not ok then null when urgent then 'run' when o_orderpriority = '2-HIGH' then 'rower' else 'yoga' end as workout_type,
  case when ok then o_orderdate end as start_time, case when ok then o_orderdate + to_seconds(o_orderkey % 7200) end as end_time,
  case when not ok then null when o_orderstatus = 'O' then 'watch' else 'strava-unknown-device' end as device_id,
  case when not ok then null when o_orderpriority = '3-MEDIUM' then (select this_moment from last_day) else o_orderdate + interval 1 day end as synced_at,
  case when ok and o_orderpriority <> '5-LOW' then o_totalprice end as distance_meters,
  case when ok and o_orderstatus <> 'F' then o_totalprice end as calories,
  cast(case when not ok then null when urgent then 3 when bare then 0 else 1 end as bigint) as n_samples,
  case when not ok or bare then null when urgent then o_orderdate else o_orderdate + interval 1500 millisecond end as first_ts,
  case when not ok or bare then null when urgent then o_orderdate + interval 10 second else o_orderdate + interval 1500 millisecond end as last_ts,
  case when not ok then null when urgent then '120,130,-' when bare then '' else '-' end as rates,
  case when o_orderstatus = 'P' then 'malformed activity record ' || o_orderkey || ': missing [''athlete'']'
       when o_orderkey % 50 = 0 then 'malformed activity record ' || o_orderkey || ': bad time stream'
       when o_orderkey % 50 = 1 then 'malformed activity record ' || o_orderkey || ': bad heartrate stream' end as error,
  strftime(case when o_orderpriority = '3-MEDIUM' then (select today from last_day) else cast(o_orderdate as date) + 1 end, '%Y-%m-%d') as dt
from (select *, o_orderstatus <> 'P' and o_orderkey % 50 > 1 as ok, o_orderpriority = '1-URGENT' as urgent,
        o_orderpriority in ('2-HIGH', '3-MEDIUM') as bare from orders)"""

SQL["i6_type_map"] = """
select p_partkey, case when p_size < 10 then 'TrailRun' when p_size < 20 then 'MountainBikeRide' when p_size < 30 then 'WeightTraining'
    else array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' ') end as activity_type,
  case when p_size < 10 then 'run' when p_size < 20 then 'ride' when p_size < 30 then 'strength' else lower(p_name) end as workout_type
from part"""

SQL["i7_streams_zip"] = """
select vec_id, timestamp '2024-01-01' + to_seconds((i - 1) * 5) as ts, cast(round(cast(up[i] as double) * 1000) as bigint) as heart_rate_bpm,
  round(cast(down[i] as double), 6) as lat, round(cast(-down[i] as double), 6) as lon,
  case when label % 2 = 1 then round(cast(embedding[i] as double), 6) end as elevation_m
from (select *, unnest(range(1, len(embedding) + 1)) as i, [x for x in embedding if x > 0] as up, [x for x in embedding if x < 0] as down
      from embeddings where label <> 3)"""

SQL["i12_conform_sources"] = """
select p || '-' || id as user_id, p as source, split_part(name, '#', 1) || ' ' || split_part(name, '#', 2) as display_name,
  p || '-' || id || '@unknown.example' as email, cast(null as bigint) as age, nullif(weight, 0) as weight_kg,
  cast(null as double) as height_cm, cast(null as varchar) as fitness_goal, timestamp '2024-01-01' as updated_at
from (select 'c' as p, c_custkey as id, c_name as name, c_acctbal as weight from customer
      union all select 's', s_suppkey, s_name, s_acctbal from supplier)"""

# --- scans, marks, backfill --------------------------------------------------------------------

SQL["s1_landing_scan"] = f"""
select {WORKOUT_COLUMNS}, strftime(first_event + 14, '%Y-%m-%d') as dt from workout_records, first_day
where error is null and cast(synced_at as date) = first_event + 14"""

SQL["k2_replay_landing"] = """
select strftime(synced_at, '%Y-%m-%d') as dt, run, count(*) filter (error is null) as valid, count(*) filter (error is not null) as rejected
from workout_records, first_day, (values ('live-1'), ('backfill-1')) r(run)
where k <> 20 and synced_at > first_event + 4 and synced_at <= first_event + 8 group by 1, 2"""

SQL["k6_merge_table"] = """
select workout_id, workout_type, synced_at, calories, strftime(synced_at, '%Y-%m-%d') as dt from clean_workouts"""

SQL["s8_window_scan"] = """
select event_id, ts, user_id from events
where ts > (select min(ts) from events where event_type = 'click') and ts <= (select max(ts) from events where event_type = 'click')"""

SQL["s8_landed_window"] = """
select workout_id, synced_at, strftime(synced_at, '%Y-%m-%d') as dt from workout_records, first_day
where error is null and synced_at > first_event + interval 6 day + interval 5 hour and synced_at <= first_event + interval 10 day - interval 5 hour"""

SQL["w6_observed_batch"] = """
select count(*) as total, count(*) filter (error is null) as valid, count(*) filter (error is not null) as rejected,
  (select min(ts + to_minutes(k)) from ev where k <> 20) as first, (select max(ts + to_minutes(k)) from ev where k <> 20) as mark
from workout_records"""

SQL["w2_high_water"] = """
select 'app' as source, 'users' as entity, max(ts) as mark from ev where event_type = 'signup' and k <> 37
union all
select 'app', 'workouts', greatest((select max(ts) + interval 10 day from ev), (select max(ts + to_minutes(k)) from ev where k <> 20))
union all
select 'other', 'users', (select min(ts) from ev)"""

SQL["w4_backfill_range"] = """
select workout_id, user_id, source, workout_type, start_time, end_time, device_id, synced_at, distance_meters, calories
from app_workouts, first_day where synced_at > first_event + 9 and synced_at <= first_event + 12"""

SQL["w5_support"] = """
select source, entity, count(*) as n, (entity <> 'friendships' and source <> 'app') or (entity = 'friendships' and source = 'synthetic') as offered
from (select case k % 3 when 0 then 'strava' when 1 then 'synthetic' else 'app' end as source,
      case when event_type = 'signup' then 'users' when k > 60 then 'friendships' else 'workouts' end as entity from ev) group by 1, 2"""

SQL["w6_batch_stats"] = """
select count(*) as total,
  cast((select count(workout_id) - count(distinct workout_id) from twice where error is null) as bigint) as duplicate,
  count(*) filter (error is null) as valid, count(*) filter (error is not null) as rejected,
  count(*) filter (error is null and synced_at - start_time > interval 1 day) as late,
  count(*) filter (error is null and date_sub('minute', start_time, end_time) > 240) as long
from twice"""

VIEWS["twice"] = """
select * from workout_records
union all select * from workout_records where k not in (14, 17, 18, 19) and (k = 5 or k between 50 and 59)"""

SQL["w7_late"] = """
select workout_id, start_time, synced_at from app_workouts where synced_at - start_time > interval 1 day"""

SQL["t2_stream_upsert"] = f"""
select * replace (strftime(synced_at, '%Y-%m-%d') as dt) from (
  select {WORKOUT_COLUMNS.replace("synced_at,", "synced_at + to_hours(case when k < 14 then 1 else 0 end) as synced_at,")}, '' as dt
  from workout_records where error is null)"""

SQL["t2_stream_state"] = SQL["t2_stream_upsert"]

SQL["t3_stream_rejects"] = """
select error, 'app' as source, sum(case when k < 14 then 2 else 1 end) as n from workout_records where error is not null group by 1"""

SQL["k8_dry_run"] = "select count(*) as shown, cast(0 as bigint) as stored from workout_records where error is null"

SQL["i9_required"] = """
select name as "column", name in ('workout_id', 'user_id', 'source', 'synced_at') as stopped
from (select unnest(['workout_id', 'user_id', 'source', 'workout_type', 'start_time', 'end_time', 'device_id', 'synced_at',
  'distance_meters', 'calories', 'samples']) as name), (select count(*) as n from first_workouts where k = 5) where n > 0"""

SQL["s5_seed_file"] = """
select lower(p_type) as workout_type, min(p_brand) as category, max(p_size) > 25 as is_cardio, max(p_retailprice) as met_value
from part group by 1"""

SQL["w1_mark_read"] = """
select event_type as entity, max(ts) as mark from events group by 1 union all select 'never', null"""

SQL["q7_gate"] = """
select 'l_orderkey' as "column", 'not_null' as test, (select count(*) from lineitem where l_orderkey is null) > 0 as stopped
union all select 'l_orderkey', 'unique', (select count(*) - count(distinct l_orderkey) from lineitem) > 0
union all select 'l_quantity', 'at_most', (select max(l_quantity) from lineitem) > 40
union all select 'l_tax', 'at_most', (select max(l_tax) from lineitem) > 0.5"""

# --- quality -----------------------------------------------------------------------------------

# Names of the declared tables among the common table expressions.
DECLARED_VIEW = {
    "raw_workouts": "app_workouts",
    "raw_users": "app_users",
    "raw_friendships": "app_edges",
    "stg_workouts": "clean_workouts",
    "stg_users": "clean_users",
    "stg_friendships": "clean_edges",
    "dim_user": "user_versions",
    "dim_date": "spine",
    "dim_exercise_type": "kinds",
    "fact_workout": "workout_facts",
    "fact_daily_metrics": "day_facts",
    "leaderboard": "board",
    "personal_records": "records",
}


# The tests each table must pass, as kind and columns; written out here and not taken from the engine.
EXPECTED_TESTS = {
    "raw_workouts": "not_null workout_id user_id synced_at",
    "raw_users": "not_null user_id updated_at",
    "raw_friendships": "not_null user_id friend_user_id",
    "stg_workouts": "not_null workout_id user_id start_time end_time; unique workout_id",
    "stg_users": "not_null user_id source_system updated_at",
    "stg_friendships": "not_null user_id friend_user_id",
    "dim_user": "not_null user_sk user_id valid_from valid_to; unique user_sk",
    "dim_date": "not_null date_sk date_day; unique date_sk date_day",
    "dim_exercise_type": "not_null exercise_type_sk workout_type; unique exercise_type_sk workout_type",
    "fact_workout": "not_null workout_sk workout_id user_id duration_minutes; at_most duration_minutes=1440; unique workout_sk workout_id; relationships user_sk=dim_user.user_sk exercise_type_sk=dim_exercise_type.exercise_type_sk workout_date_sk=dim_date.date_sk",
    "leaderboard": "not_null user_id member_user_id rank_by_distance",
    "personal_records": "not_null user_id workout_type",
    "fact_daily_metrics": "not_null daily_metric_sk user_id date_day; unique daily_metric_sk; relationships user_sk=dim_user.user_sk",
}


def checks_sql(spec: dict[str, str], view: dict[str, str]) -> str:
    """One SELECT per expected test."""
    parts = []
    for table, tests in spec.items():
        t = view[table]
        for kind, *columns in (group.split() for group in tests.split("; ")):
            for entry in columns:
                c, _, rule = entry.partition("=")
                if kind == "not_null":
                    count = f"select count(*) from {t} where {c} is null"
                elif kind == "at_most":
                    count = f"select count(*) from {t} where {c} > {rule}"
                elif kind == "unique":
                    count = f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"
                else:
                    parent, p = rule.split(".")
                    count = (
                        f"select count(*) from {t} x where x.{c} is not null "
                        f"and not exists (select 1 from {view[parent]} y where y.{p} = x.{c})"
                    )
                head = f"select '{table}' as \"table\", '{c}' as \"column\", '{kind}' as test"
                parts.append(f"{head}, cast(({count}) as bigint) as failing_rows")
    return "select *, failing_rows = 0 as passed from (\n" + "\nunion all ".join(parts) + ")"


SQL["q1_declared"] = checks_sql(EXPECTED_TESTS, DECLARED_VIEW)

SQL["q1_run_checks"] = """
select *, failing_rows = 0 as passed from (
select 'lineitem' as "table", 'l_orderkey' as "column", 'not_null' as test, count(*) filter (l_orderkey is null) as failing_rows from lineitem
union all select 'lineitem', 'l_shipdate', 'not_null', count(*) filter (l_shipdate is null) from lineitem
union all select 'lineitem', 'l_quantity', 'at_most', count(*) filter (l_quantity > 40) from lineitem
union all select 'lineitem', 'l_tax', 'at_most', count(*) filter (l_tax > 0.07) from lineitem
union all select 'lineitem', 'l_orderkey', 'unique', count(*) from (select l_orderkey from lineitem group by 1 having count(*) > 1)
union all select 'lineitem', 'buyer', 'relationships', count(*) from lineitem where not exists
  (select 1 from customer where c_custkey = l_partkey + l_suppkey)
union all select 'documents', 'quality', 'not_null', count(*) filter (quality is null) from documents left join labels using (doc_id)
union all select 'documents', 'toxic', 'not_null', count(*) filter (toxic is null) from documents left join labels using (doc_id)
union all select 'documents', 'text', 'not_null', count(*) filter ("text" is null) from documents left join labels using (doc_id)
union all select 'documents', 'doc_id', 'unique', count(*) from
  (select doc_id from documents left join labels using (doc_id) group by 1 having count(*) > 1)
union all select 'documents', 'quality', 'unique', count(*) from
  (select quality from documents left join labels using (doc_id) where quality is not null group by 1 having count(*) > 1))"""

SQL["q1_unique"] = "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1"

SQL["q1_relationships"] = """
select o_orderkey, count(*) as n from orders where o_orderkey not in (select l_orderkey from lineitem) group by 1"""

SQL["q1_rule"] = "select workout_id, duration_minutes from clean_workouts where duration_minutes > 1440"

SQL["q2_table_freshness"] = """
select name as "table", newest, date_sub('hour', newest, now) as age_hours,
  case when now - newest > to_hours(error) then 'error' when now - newest > to_hours(warn) then 'warn' else 'pass' end as status
from (select 'raw_workouts' as name, max(synced_at) as newest, 24 as warn, 48 as error from first_workouts
      union all select 'raw_users', max(updated_at), 48, 96 from app_users),
  (select max(ts) + interval 16 day + interval 1 hour as now from events)"""

SQL["q3_user_freshness"] = """
select user_id, max(synced_at) as last_synced_at, date_sub('hour', max(synced_at), (select this_moment from last_day)) as hours_since_sync
from app_workouts group by 1 having hours_since_sync > 48"""

SQL["q3_stale_users"] = """
select user_id, max(synced_at) as last_synced_at,
  date_sub('hour', max(synced_at), (select this_moment + interval 3 day from last_day)) as hours_since_sync
from app_workouts group by 1 having hours_since_sync > 48"""

VIEWS["thin_days"] = """
select cast(ts as date) as day, count(*) as n from events
where cast(ts as date) < (select today from last_day) or event_type = 'click' group by 1"""

SQL["q4_volume"] = """
select day as date, n as today_count, round(mean, 1) as trailing_avg, days as trailing_days, round(n / mean, 3) as ratio
from thin_days, (select avg(n) as mean, count(*) as days from thin_days
                 where day >= (select today from last_day) - 8 and day < (select today from last_day))
where day = (select today from last_day) and days >= 3 and n / mean < 0.5"""

SQL["q4_volume_dense"] = """
select today + 1 as date, cast(0 as bigint) as today_count, round((select sum(n) from thin_days where day >= today - 7) / 8, 1) as trailing_avg,
  cast(8 as bigint) as trailing_days, cast(0 as double) as ratio
from last_day"""

SQL["q5_anomaly"] = """
select workout_id, duration_minutes, distance_meters,
  case when end_time - start_time > interval 24 hour and distance_meters < 0 then 'long_duration,negative_distance'
       when distance_meters < 0 then 'negative_distance' else 'long_duration' end as reason
from clean_workouts where end_time - start_time > interval 24 hour or distance_meters < 0"""

SQL["q6_symmetry"] = """
select distinct user_id as a, k as b, 'no_reverse' as problem from ev e
where not exists (select 1 from ev r where r.user_id = e.k and r.k = e.user_id)
union all
select distinct user_id, k, 'self_edge' from ev where user_id = k"""

# --- predicates and scalar functions -----------------------------------------------------------

SQL["p_predicates"] = """
select l_suppkey, l_returnflag in ('A', 'R') as returned, quality is null as unlabelled, count(*) as n,
  count(*) filter (cast(l_shipdate as date) = date '1997-05-28') as that_day,
  round(sum(case when l_discount > 0.05 then l_quantity end), 6) as discounted,
  cast(sum(case when l_tax > 0.04 then 2 else 1 end) as bigint) as band
from lineitem left join labels on doc_id = l_partkey
where l_quantity between 5 and 45 and l_shipdate >= (select min(o_orderdate) from orders) and l_shipdate < timestamp '2000-01-01'
group by 1, 2, 3 having count(*) > 3"""

SQL["f_scalars"] = f"""
select event_id, {key('event_id', "case when k > 9 then event_type end")} as key,
  {key(micros_text("date_trunc('second', ts)"), micros_text('ts'))} as time_key,
  date_sub('minute', ts, gap) as minutes, date_sub('hour', ts, gap) as hours,
  date_diff('day', cast(ts as date), cast(gap as date)) as days, cast(ts as date) - date '1970-01-01' as day_number,
  cast(strftime(ts, '%U') as bigint) as week, dayofweek(ts) + 1 as weekday, cast(cast(ts as date) + interval 1 year as date) as next_year,
  cast(ts as date) - 6 as week_ago, round(case when k > 0 then value / (k + 0.1::double) end, 6) as safe,
  round(case when k > 0 then (value - (k + 0.1::double)) / (k + 0.1::double) end, 6) as change,
  case when event_type = 'view' then '' else event_type || ' ' end || lower(props) as words, strftime(ts, '%Y-%m-%d') as first_ten
from (select *, ts + to_seconds((k - 50) * 977) as gap from ev)"""


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in SQL.items()}
