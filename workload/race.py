"""The race feed made from the test tables: its ten cleaners, each with SQL of its own.

``RAW`` derives every raw table with text where the feed has text, missing keys, junk, values out of
range and repeated rows; both engines run the same text. ``CLEAN`` says, in SQL, what a cleaned
table is: types, which rows stay, and the order in which the first row of a key wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeaudit.operators import audit, reconcile
from lakeaudit.operators.clean import clean
from lakeaudit.plans import race
from workload.manifests import SLICES_SQL, slice_files
from workload.common import sql_stable, stable_doubles, table

SOURCES = ("region", "nation", "customer", "orders", "lineitem", "events")

RAW = {
    "meetings": """
      select case when n_nationkey % 9 = 4 then null else cast(n_nationkey as varchar(9)) end as meeting_key, n_name as meeting_name,
             cast(2023 + n_regionkey % 3 as varchar(9)) as year, n_regionkey as circuit_key, cast(k as varchar(9)) as country_key,
             concat('2024-0', cast(1 + k % 9 as varchar(9)), '-01') as date_start, concat('/meetings/', cast(k % 2 as varchar(9))) as source_file
      from nation, (select r_regionkey as k from region where r_regionkey < 3) r""",
    "sessions": """
      select case when c_custkey % 41 = 0 then null else cast(c_custkey % 700 as varchar(9)) end as session_key, c_nationkey as meeting_key,
             cast(2023 + c_custkey % 3 as varchar(9)) as year, 'Race' as session_name, c_mktsegment as session_type, c_name as location,
             case when c_custkey % 17 = 0 then 'soon' else concat('2024-0', cast(1 + c_custkey % 9 as varchar(9)), '-02T10:00:00') end as date_start,
             concat('2024-0', cast(1 + c_custkey % 9 as varchar(9)), '-03T10:00:00') as date_end, '/sessions' as source_file
      from customer""",
    "drivers": """
      select o_custkey % 700 as session_key, case when o_orderkey % 31 = 0 then 'x' else cast(o_orderkey % 20 as varchar(9)) end as driver_number,
             o_orderpriority as full_name, o_orderstatus as team_name,
             case when o_custkey % 4 = 0 then cast(o_custkey % 5 as varchar(9)) end as meeting_key, '/drivers' as source_file
      from orders""",
    "laps": """
      select case when l_partkey % 53 = 0 then null else l_orderkey % 700 end as session_key, cast(l_suppkey % 20 as varchar(9)) as driver_number,
             l_linenumber - cast(l_tax * 0 as int) - case when l_quantity = 5 then 9 else 0 end as lap_number,
             case when l_quantity = 13 then 'n/a' when l_quantity = 14 then null when l_quantity = 15 then '-1' else cast(l_quantity as varchar(20)) end as lap_duration,
             l_tax as duration_sector_1, cast(l_discount as varchar(20)) as duration_sector_2, l_partkey % 300 as i1_speed,
             l_returnflag = 'R' as is_pit_out_lap, cast(cast(l_shipdate as date) as varchar(20)) as date_start, l_linestatus as source_file
      from lineitem""",
    "pit": """
      select l_orderkey % 700 as session_key, case when l_suppkey % 20 = 3 then null else l_suppkey % 20 end as driver_number,
             case when l_quantity = 5 then '0' when l_quantity = 6 then null else cast(l_linenumber as varchar(9)) end as lap_number,
             cast(l_extendedprice as varchar(30)) as pit_duration, l_quantity as lane_duration,
             case when l_quantity = 19 then 'later' else cast(cast(l_shipdate as date) as varchar(20)) end as date, l_returnflag as source_file
      from lineitem where l_returnflag <> 'N'""",
    "weather": """
      select case when user_id % 37 = 0 then null else user_id % 700 end as session_key, cast(value as varchar(30)) as air_temperature,
             event_id % 40 as track_temperature, event_type as humidity, user_id % 2 as rainfall,
             cast(cast(ts as date) as varchar(20)) as date, '/weather' as source_file
      from events union all
      select user_id % 700, cast(value as varchar(30)), event_id % 40, event_type, user_id % 2, cast(cast(ts as date) as varchar(20)), '/again'
      from events where event_type = 'view' and user_id % 37 <> 0""",
    "position": """
      select user_id % 700 as session_key, case when user_id % 29 = 0 then null else cast(event_id % 20 as varchar(9)) end as driver_number,
             event_id % 22 - 1 as position, cast(cast(ts as date) as varchar(20)) as date,
             case when user_id % 4 = 0 then user_id % 5 end as meeting_key, event_type as source_file
      from events""",
    "race_control": """
      select case when event_id % 43 = 0 then null else user_id % 700 end as session_key, cast(cast(ts as date) as varchar(20)) as date,
             event_type as message, case when event_id % 3 = 0 then 'YELLOW' end as flag,
             case when user_id % 4 = 0 then cast(user_id % 5 as varchar(9)) end as meeting_key, '/rc' as source_file
      from events union all
      select user_id % 700, cast(cast(ts as date) as varchar(20)), event_type, case when event_id % 3 = 0 then 'YELLOW' end,
             case when user_id % 4 = 0 then cast(user_id % 5 as varchar(9)) end, '/again'
      from events where event_id % 11 = 0 and event_id % 43 <> 0""",
    "session_result": """
      select o_custkey % 700 as session_key, cast(o_orderkey % 20 as varchar(9)) as driver_number,
             case when o_orderkey % 19 = 0 then 0 when o_orderkey % 23 = 0 then null else o_orderkey % 20 end as position,
             case when o_orderkey % 29 = 0 then '-1' when o_orderkey % 31 = 0 then null else cast(o_orderkey % 26 - o_orderkey % 2 * 0.5 as varchar(20)) end as points,
             o_orderstatus = 'F' as dnf, case when o_custkey % 4 = 0 then o_custkey % 5 end as meeting_key, '/results' as source_file
      from orders""",
    "starting_grid": """
      select o_custkey % 700 as session_key, o_orderkey % 20 as driver_number, cast(o_orderkey % 22 as varchar(9)) as position, '/grid' as source_file
      from orders where o_orderstatus = 'P'""",
}


def _longs(*names):
    return {n: f"coalesce(try_cast({n} as bigint), cast(try_cast({n} as decimal(38, 6)) as bigint))" for n in names}


def _doubles(*names):
    return {n: f"try_cast({n} as double)" for n in names}


def _times(*names):
    return {n: f"try_cast({n} as timestamp)" for n in names}


# name -> (casts, added columns, rows that stay, key or None, order in front of the columns)
CLEAN = {
    "meetings": (_longs("meeting_key", "year", "country_key", "circuit_key"), "", "meeting_key is not null", "meeting_key", "date_start"),
    "sessions": ({**_longs("session_key", "year"), "meeting_key": "cast(meeting_key as bigint)", **_times("date_start", "date_end")}, "",
                 "session_key is not null", "session_key", "date_start"),
    "drivers": (_longs("driver_number", "meeting_key"), "", "session_key is not null and driver_number is not null",
                "session_key, driver_number", ""),
    "laps": ({**_longs("driver_number"), "lap_number": "cast(lap_number as bigint)",
              **_doubles("lap_duration", "duration_sector_2"), **_times("date_start")}, "",
             "session_key is not null and driver_number is not null and lap_number > 0 and (lap_duration is null or lap_duration > 0)",
             "session_key, driver_number, lap_number", "date_start"),
    "pit": ({**_longs("lap_number"), **_doubles("pit_duration"), **_times("date")}, "",
            "session_key is not null and driver_number is not null and (lap_number is null or lap_number > 0)",
            "session_key, driver_number, lap_number", "date"),
    "weather": ({**_doubles("air_temperature", "track_temperature", "humidity", "rainfall"), **_times("date")}, "",
                "session_key is not null", None, ""),
    "position": ({**_longs("driver_number"), **_times("date")}, "",
                 "session_key is not null and driver_number is not null and (position is null or position > 0)",
                 "session_key, driver_number, date", ""),
    "race_control": ({**_longs("meeting_key"), **_times("date")}, "", "session_key is not null", None, ""),
    "session_result": ({**_longs("driver_number"), **_doubles("points")}, "",
                       "session_key is not null and driver_number is not null and (position is null or position > 0) "
                       "and (points is null or points >= 0)", "session_key, driver_number", ""),
    "starting_grid": (_longs("position", "grid_position"), ", position as grid_position",
                      "session_key is not null and driver_number is not null", "session_key, driver_number", ""),
}


def raw(spark, sf_dir, name):
    query = RAW[name]
    used = {s: table(spark, sf_dir, s) for s in SOURCES if f"from {s}" in query}
    for s in used:
        query = query.replace(f"from {s}", "from {" + s + "}")
    return spark.sql(query, **used)


def cleaned(spark, sf_dir, name):
    return clean(raw(spark, sf_dir, name), race.SPECS[name])


def cleaned_sql(name):
    casts, added, keep, key, order = CLEAN[name]
    swaps = ", ".join(f"{value} as {column}" for column, value in casts.items())
    typed = f"select * replace ({swaps}) from (select *{added} from raw)"
    if key is None:
        rest = "select distinct * exclude (source_file) from kept"
    else:
        lead = f"{order} nulls first, " if order else ""
        by = ", ".join(f"{c} nulls first" for c in BY_COLUMN[name])
        rest = (f"select * exclude (nth, source_file) from (select *, row_number() over (partition by {key} "
                f"order by {lead}{by}, source_file nulls first) as nth from kept) where nth = 1")
    return f"with raw as ({RAW[name]}), typed as ({typed}), kept as (select * from typed where {keep}) {rest}"


# The columns in the order in which ties are broken.
BY_COLUMN = {
    "meetings": ("meeting_name", "year", "circuit_key", "country_key", "date_start"),
    "sessions": ("meeting_key", "year", "session_name", "session_type", "location", "date_start", "date_end"),
    "drivers": ("full_name", "team_name", "meeting_key"),
    "laps": ("lap_duration", "duration_sector_1", "duration_sector_2", "i1_speed", "is_pit_out_lap", "date_start"),
    "pit": ("pit_duration", "lane_duration", "date"),
    "position": ("position", "meeting_key"),
    "session_result": ("position", "points", "dnf", "meeting_key"),
    "starting_grid": ("position", "grid_position"),
}


def _query(name):
    return lambda spark, sf_dir: cleaned(spark, sf_dir, name).drop("source_file")


def silver_foreign_keys(spark, sf_dir):
    tables = {n: cleaned(spark, sf_dir, n) for n in race.TABLE_ORDER}
    return audit.fk_suite(tables, race.FOREIGN_KEYS, "after").drop("status")


QUERIES = {f"clean_{name}": _query(name) for name in race.TABLE_ORDER}
ORACLES = {f"clean_{name}": cleaned_sql(name) for name in race.TABLE_ORDER}

_CLEANED = ", ".join(f"{n} as ({cleaned_sql(n)})" for n in race.TABLE_ORDER)


def _fk_sql():
    parts = []
    for e in race.FOREIGN_KEYS:
        on = " and ".join(f"p.{c} = c.{c}" for c in e.columns)
        whole = " and ".join(f"{c} is not null" for c in e.columns)
        keys = ", ".join(e.columns)
        parts.append(
            f"select '{e.child}' as child_table, '{e.parent}' as parent_table, '{','.join(e.columns)}' as key_columns, "
            f"count(*) as distinct_child_keys, count(*) filter (where p.hit is null) as unmatched_rows, "
            f"round(100.0 * count(*) filter (where p.hit is null) / greatest(count(*), 1), 4) as unmatched_pct, 'after' as stage "
            f"from (select distinct {keys} from {e.child} where {whole}) c "
            f"left join (select distinct {keys}, true as hit from {e.parent} where {whole}) p on {on}")
    return f"with {_CLEANED} " + " union all ".join(parts)


QUERIES["silver_foreign_keys"] = silver_foreign_keys
ORACLES["silver_foreign_keys"] = _fk_sql()


# --- the mart through the product path --------------------------------------------------------

def race_mart(spark, sf_dir):
    mart, _ = race.build_mart({n: cleaned(spark, sf_dir, n) for n in race.TABLE_ORDER})
    return stable_doubles(mart)


def _keyed(name):
    """The table with its meeting taken from its session where it has none."""
    own = "t.meeting_key" if " as meeting_key" in RAW[name] else "null"
    rest = "t.* exclude (meeting_key)" if own != "null" else "t.*"
    return (f"(select {rest}, coalesce({own}, s.meeting_key) as meeting_key from {name} t "
            "left join sessions s on s.session_key = t.session_key)")


RACE_MART_SQL = f"""
with {_CLEANED},
laps_f as (
  select session_key, meeting_key, driver_number, count(lap_number) as lap_count, avg(lap_duration) as avg_lap_duration,
         quantile_cont(lap_duration, 0.5) as median_lap_duration, min(lap_duration) as best_lap_duration,
         stddev_samp(lap_duration) as std_lap_duration,
         avg(lap_duration) filter (where lap_number <= 5) as avg_first5_lap_duration,
         min(lap_duration) filter (where lap_number <= 5) as best_first5_lap_duration,
         stddev_samp(lap_duration) filter (where lap_number <= 5) as std_first5_lap_duration,
         avg(duration_sector_1) as avg_sector_1, avg(duration_sector_2) as avg_sector_2, avg(i1_speed) as avg_i1_speed,
         count(*) filter (where is_pit_out_lap) as pit_out_lap_count
  from {_keyed('laps')} group by all),
pit_f as (
  select session_key, meeting_key, driver_number, count(*) as pit_stop_count, avg(d) as avg_pit_duration,
         min(d) as min_pit_duration, max(d) as max_pit_duration, min(lap_number) as first_pit_lap,
         case when min(lap_number) <= 10 then 1 else 0 end as early_pit_stop_flag
  from (select *, coalesce(pit_duration, lane_duration) as d from {_keyed('pit')}) group by 1, 2, 3),
seen as (
  select *, row_number() over (partition by session_key, meeting_key, driver_number
                               order by date nulls last, position nulls last) as nth from {_keyed('position')}),
position_f as (
  select session_key, meeting_key, driver_number,
         arg_min(position, nth) filter (where nth <= 5 and position is not null) as first_observed_position,
         avg(position) filter (where nth <= 5) as early_avg_position, min(position) filter (where nth <= 5) as early_min_position,
         max(position) filter (where nth <= 5) as early_max_position,
         count(position) filter (where nth <= 5) as position_observation_count,
         arg_max(position, nth) filter (where position is not null and date is not null) as diagnostic_final_observed_position,
         count(*) as position_total_observation_count
  from seen group by 1, 2, 3),
weather_f as (
  select session_key, meeting_key, avg(air_temperature) as avg_air_temperature, avg(track_temperature) as avg_track_temperature,
         avg(humidity) as avg_humidity, avg(rainfall) as rainfall_mean, case when max(rainfall) > 0 then 1 else 0 end as rainfall_flag
  from {_keyed('weather')} group by 1, 2),
control_f as (
  select session_key, meeting_key, count(*) as race_control_message_count,
         count(*) filter (where flag is not null and flag <> '') as flag_message_count,
         count(*) filter (where flag = 'YELLOW') as yellow_flag_count
  from {_keyed('race_control')} group by 1, 2),
people as (
  select p.session_key, p.meeting_key, p.driver_number, full_name, team_name, cast(null as varchar) as driver_country_code,
         s.session_type, s.session_name, s.location, s.year as session_year, cast(null as varchar) as session_country_name,
         m.meeting_name, m.circuit_key
  from {_keyed('drivers')} p left join sessions s on s.session_key = p.session_key left join meetings m on m.meeting_key = p.meeting_key)
select b.session_key, b.meeting_key, b.driver_number, coalesce(b.dnf, false) as result_dnf, false as result_dns, false as result_dsq,
       case when b.points > 0 then 1 else 0 end as points_finish, b.position as final_position, b.points as result_points,
       p.* exclude (session_key, meeting_key, driver_number),
       l.* exclude (session_key, meeting_key, driver_number) replace (coalesce(lap_count, 0) as lap_count, coalesce(pit_out_lap_count, 0) as pit_out_lap_count),
       i.* exclude (session_key, meeting_key, driver_number)
         replace (coalesce(pit_stop_count, 0) as pit_stop_count, coalesce(early_pit_stop_flag, 0) as early_pit_stop_flag),
       o.* exclude (session_key, meeting_key, driver_number), w.* exclude (session_key, meeting_key),
       coalesce(race_control_message_count, 0) as race_control_message_count, coalesce(flag_message_count, 0) as flag_message_count,
       coalesce(yellow_flag_count, 0) as yellow_flag_count, cast(0 as bigint) as red_flag_count, cast(0 as bigint) as green_flag_count,
       cast(0 as bigint) as safety_car_message_count, cast(0 as bigint) as pit_exit_message_count
from {_keyed('session_result')} b
left join people p on p.session_key = b.session_key and p.meeting_key = b.meeting_key and p.driver_number = b.driver_number
left join laps_f l on l.session_key = b.session_key and l.meeting_key = b.meeting_key and l.driver_number = b.driver_number
left join pit_f i on i.session_key = b.session_key and i.meeting_key = b.meeting_key and i.driver_number = b.driver_number
left join position_f o on o.session_key = b.session_key and o.meeting_key = b.meeting_key and o.driver_number = b.driver_number
left join weather_f w on w.session_key = b.session_key and w.meeting_key = b.meeting_key
left join control_f c on c.session_key = b.session_key and c.meeting_key = b.meeting_key
"""
RACE_DOUBLES = [
    "result_points", "avg_lap_duration", "median_lap_duration", "best_lap_duration", "std_lap_duration", "avg_first5_lap_duration",
    "best_first5_lap_duration", "std_first5_lap_duration", "avg_sector_1", "avg_sector_2", "avg_i1_speed", "avg_pit_duration",
    "min_pit_duration", "max_pit_duration", "early_avg_position", "avg_air_temperature", "avg_track_temperature", "avg_humidity",
    "rainfall_mean",
]
QUERIES["race_mart"] = race_mart
ORACLES["race_mart"] = f"select * replace ({sql_stable(RACE_DOUBLES)}) from ({RACE_MART_SQL})"


def layer_volume(spark, sf_dir):
    """Rows and files of the landed feed, rows of the ten cleaned tables and of the mart."""
    def counted(df, name):
        return df.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("row_count"))

    silver = reduce(lambda a, b: a.unionByName(b), [counted(cleaned(spark, sf_dir, n), n) for n in race.TABLE_ORDER])
    mart, _ = race.build_mart({n: cleaned(spark, sf_dir, n) for n in race.TABLE_ORDER})
    return reconcile.volume_by_layer({
        "bronze": slice_files(spark, sf_dir).select(F.col("endpoint").alias("entity"), "row_count"),
        "silver": silver, "gold": counted(mart, "driver_race_feature_mart")})


QUERIES["layer_volume"] = layer_volume
ORACLES["layer_volume"] = f"""
with {SLICES_SQL}, {_CLEANED}
select 'bronze' as layer, endpoint as entity, cast(sum(row_count) as bigint) as row_count, count(*) as file_count from files group by 2
union all select 'bronze', 'all_endpoints', cast(sum(row_count) as bigint), count(*) from files
{' '.join(f"union all select 'silver', '{n}', count(*), 1 from {n}" for n in race.TABLE_ORDER)}
union all select 'gold', 'driver_race_feature_mart', count(*), 1 from ({RACE_MART_SQL})"""
