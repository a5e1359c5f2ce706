"""Feature groups and the feature mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.operators import features as feat
from lakeaudit.operators.clean import with_optional, zero_fill
from workload.common import sql_stable, stable_doubles, table

GRAIN = ["session_key", "meeting_key", "driver_number"]
LAP_MEANS = {
    "avg_sector_1": "l_quantity", "avg_sector_2": "l_discount", "avg_sector_3": "l_tax",
    "avg_i1_speed": "l_partkey", "avg_i2_speed": "l_suppkey", "avg_st_speed": "l_linenumber",
}
WEATHER_MEANS = {
    "avg_air_temperature": "value", "avg_track_temperature": "k", "avg_humidity": "at_hour",
    "avg_pressure": "at_day", "avg_wind_speed": "at_minute",
}
TERMS = {
    "yellow_flag_count": ("CLICK",), "red_flag_count": ("ERR",), "green_flag_count": ("VIEW",),
    "safety_car_message_count": ("SIGN", "SIGNUP"), "pit_exit_message_count": ("PURCHASE",),
}


def _laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("session_key"), "l_linenumber", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_partkey", "l_suppkey", "l_returnflag",
        (F.col("l_returnflag") == "A").alias("pit_out"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("driver_number"), "event_id", "ts", "event_type", "value",
        F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("double").alias("k"),
        F.hour("ts").alias("at_hour"), F.day("ts").alias("at_day"), F.minute("ts").alias("at_minute"),
        (F.col("event_type") == "error").cast("int").alias("rainfall"),
        F.when(F.col("value") > 20, "raised").when(F.col("value") > 10, "").alias("flag"),
    )


def lap_features(spark, sf_dir):
    laps = _laps(spark, sf_dir)
    out = feat.lap_features(
        laps, ["session_key"], LAP_MEANS, "l_linenumber", "l_extendedprice",
        ("pit_out_lap_count", "pit_out"),
    )
    return stable_doubles(out)


def pit_features(spark, sf_dir):
    returned = _laps(spark, sf_dir).where("l_returnflag = 'R'")
    out = feat.pit_features(returned, ["session_key"], "l_linenumber", "l_extendedprice", early=2)
    return stable_doubles(out)


def first_n_features(spark, sf_dir):
    out = feat.position_features(
        _events(spark, sf_dir), ["driver_number"], "ts", "value", ["event_id"])
    return stable_doubles(out)


def session_means(spark, sf_dir):
    return stable_doubles(feat.weather_features(_events(spark, sf_dir), ["driver_number"], WEATHER_MEANS))


def event_message_counts(spark, sf_dir):
    return feat.message_features(
        _events(spark, sf_dir), ["driver_number"], "event_type", "flag", TERMS)


def message_counts(spark, sf_dir):
    """Term counts over whole document texts per source."""
    docs = table(spark, sf_dir, "documents")
    return feat.message_features(
        docs, ["source"], "text", "lang",
        {"yellow_flag_count": ("LICENSE",), "red_flag_count": ("RE",), "green_flag_count": ("LE ",),
         "safety_car_message_count": ("ION", "TION"), "pit_exit_message_count": ("@",)},
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver-grain columns: the dimension star and the three feature groups fed by events."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driver_number"), F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("team_name"), "c_nationkey",
        F.col("c_nationkey").cast("bigint").alias("meeting_key"),
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("driver_country_code"),
        F.col("n_regionkey").alias("circuit_key"),
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("circuit_key"), F.col("r_name").alias("meeting_name"))
    people = feat.one_per_key(customer, ["driver_number"])
    out = feat.star(people, [(nation, ["c_nationkey"]), (region, ["circuit_key"])])
    out = out.withColumn("circuit_key", F.col("circuit_key").cast("bigint")).drop("c_nationkey")
    events = _events(spark, sf_dir)
    on = ["driver_number"]
    for group in (
        feat.position_features(events, on, "ts", "value", ["event_id"]),
        feat.weather_features(events, on, WEATHER_MEANS),
        feat.message_features(events, on, "event_type", "flag", TERMS),
    ):
        out = feat.feature_left_join(out, group, on, one_base_row_per_key=True)
    return out


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: outcome, label and session columns."""
    orders = table(spark, sf_dir, "orders")
    points = F.round(F.col("o_totalprice") - 250000, 2)
    rows = orders.select(
        F.col("o_orderkey").alias("session_key"), F.col("o_custkey").alias("driver_number"),
        (F.col("o_orderstatus") == "F").alias("result_dnf"), points.alias("result_points"),
        feat.label(points).alias("points_finish"),
        F.substring("o_orderpriority", 1, 1).try_cast("bigint").alias("final_position"),
        F.col("o_orderstatus").alias("session_type"), F.col("o_orderpriority").alias("circuit_short_name"),
        F.year("o_orderdate").cast("bigint").alias("session_year"),
        "o_orderdate",
    )
    return with_optional(rows, {
        "result_dns": (["result_dns"], "boolean", False),
        "result_dsq": (["result_dsq"], "boolean", False),
        "session_country_name": (["session_country_name"], "string", None),
    })


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart with unrounded values.

    Laps and stops share one grouping of the line items. Customer-grain columns, the meeting key
    among them, are assembled on the customer key first, so the order rows move once per key.
    """
    rows = base(spark, sf_dir).drop("o_orderdate")
    rows = feat.feature_left_join(rows, drivers(spark, sf_dir), ["driver_number"])
    laps = _laps(spark, sf_dir)
    aggs = feat.lap_aggregates(
        laps.columns, "l_linenumber", "l_extendedprice", LAP_MEANS, ("pit_out_lap_count", "pit_out"), 5)
    aggs += feat.pit_aggregates("l_linenumber", "l_extendedprice", 2, F.col("l_returnflag") == "R")
    lines = feat.grouped_with_median(laps, ["session_key"], "l_extendedprice", "median_lap_duration", aggs)
    rows = feat.feature_left_join(rows, lines, ["session_key"], one_base_row_per_key=True)
    return zero_fill(rows, list(feat.EVENT_COUNT_COLUMNS))


def order_feature_mart(spark, sf_dir):
    return stable_doubles(mart(spark, sf_dir))


# --- checks -----------------------------------------------------------------------------------

LAPS_CTE = """
laps as (
  select l_orderkey as session_key, count(l_linenumber) as lap_count,
         avg(l_extendedprice) as avg_lap_duration, min(l_extendedprice) as best_lap_duration,
         stddev_samp(l_extendedprice) as std_lap_duration,
         avg(l_extendedprice) filter (where l_linenumber <= 5) as avg_first5_lap_duration,
         min(l_extendedprice) filter (where l_linenumber <= 5) as best_first5_lap_duration,
         stddev_samp(l_extendedprice) filter (where l_linenumber <= 5) as std_first5_lap_duration,
         avg(l_quantity) as avg_sector_1, avg(l_discount) as avg_sector_2, avg(l_tax) as avg_sector_3,
         avg(l_partkey) as avg_i1_speed, avg(l_suppkey) as avg_i2_speed,
         avg(l_linenumber) as avg_st_speed,
         count(*) filter (where l_returnflag = 'A') as pit_out_lap_count,
         quantile_cont(l_extendedprice, 0.5) as median_lap_duration
  from lineitem group by l_orderkey
)"""
LAP_DOUBLES = [
    "avg_lap_duration", "best_lap_duration", "std_lap_duration", "avg_first5_lap_duration",
    "best_first5_lap_duration", "std_first5_lap_duration", "avg_sector_1", "avg_sector_2",
    "avg_sector_3", "avg_i1_speed", "avg_i2_speed", "avg_st_speed", "median_lap_duration",
]
PIT_CTE = """
pit as (
  select l_orderkey as session_key, count(*) as pit_stop_count,
         avg(l_extendedprice) as avg_pit_duration, min(l_extendedprice) as min_pit_duration,
         max(l_extendedprice) as max_pit_duration, min(l_linenumber) as first_pit_lap,
         case when min(l_linenumber) <= 2 then 1 else 0 end as early_pit_stop_flag
  from lineitem where l_returnflag = 'R' group by l_orderkey
)"""
PIT_DOUBLES = ["avg_pit_duration", "min_pit_duration", "max_pit_duration"]
EVENTS_CTE = """
ev as (
  select user_id as driver_number, event_id, ts, event_type, value,
         try_cast(regexp_extract(props, '"k": (\\d+)', 1) as double) as k,
         case when event_type = 'error' then 1 else 0 end as rainfall,
         case when value > 20 then 'raised' when value > 10 then '' end as flag
  from events
),
seen as (
  select *, row_number() over (partition by driver_number order by ts, event_id) as nth,
         row_number() over (partition by driver_number order by ts desc, event_id desc) as nth_last
  from ev
),
pos as (
  select driver_number, max(value) filter (where nth = 1) as first_observed_position,
         avg(value) filter (where nth <= 5) as early_avg_position,
         min(value) filter (where nth <= 5) as early_min_position,
         max(value) filter (where nth <= 5) as early_max_position,
         count(value) filter (where nth <= 5) as position_observation_count,
         max(value) filter (where nth_last = 1) as diagnostic_final_observed_position,
         count(*) as position_total_observation_count
  from seen group by driver_number
),
weather as (
  select driver_number, avg(value) as avg_air_temperature, avg(k) as avg_track_temperature,
         avg(hour(ts)) as avg_humidity, avg(day(ts)) as avg_pressure, avg(minute(ts)) as avg_wind_speed,
         avg(rainfall) as rainfall_mean,
         case when max(rainfall) > 0 then 1 else 0 end as rainfall_flag
  from ev group by driver_number
),
msg as (
  select driver_number, count(*) as race_control_message_count,
         count(*) filter (where flag is not null and flag <> '') as flag_message_count,
         count(*) filter (where event_type = 'click') as yellow_flag_count,
         count(*) filter (where event_type = 'error') as red_flag_count,
         count(*) filter (where event_type = 'view') as green_flag_count,
         2 * count(*) filter (where event_type = 'signup') as safety_car_message_count,
         count(*) filter (where event_type = 'purchase') as pit_exit_message_count
  from ev group by driver_number
)"""
POS_DOUBLES = [
    "first_observed_position", "early_avg_position", "early_min_position", "early_max_position",
    "diagnostic_final_observed_position",
]
WEATHER_DOUBLES = [
    "avg_air_temperature", "avg_track_temperature", "avg_humidity", "avg_pressure", "avg_wind_speed",
    "rainfall_mean",
]
EVENT_COUNTS = [c for c in feat.EVENT_COUNT_COLUMNS]
MSG_COUNTS = [
    "race_control_message_count", "flag_message_count", "yellow_flag_count", "red_flag_count",
    "green_flag_count", "safety_car_message_count", "pit_exit_message_count",
]


def _zero(names: list[str]) -> str:
    return ", ".join(f"coalesce({n}, 0) as {n}" for n in names)


MART_CTE = f"""
{LAPS_CTE}, {PIT_CTE}, {EVENTS_CTE},
mart as (
  select o_orderkey as session_key, o_custkey as driver_number,
         cast(c_nationkey as bigint) as meeting_key,
         o_orderstatus = 'F' as result_dnf, false as result_dns, false as result_dsq,
         round(o_totalprice - 250000, 2) as result_points,
         case when round(o_totalprice - 250000, 2) > 0 then 1 else 0 end as points_finish,
         cast(substr(o_orderpriority, 1, 1) as bigint) as final_position,
         o_orderstatus as session_type, o_orderpriority as circuit_short_name,
         cast(year(o_orderdate) as bigint) as session_year,
         cast(null as varchar) as session_country_name,
         c_name as full_name, c_mktsegment as team_name, n_name as driver_country_code,
         cast(n_regionkey as bigint) as circuit_key, r_name as meeting_name,
         {', '.join(LAP_DOUBLES)}, {_zero(['lap_count', 'pit_out_lap_count'])},
         {', '.join(PIT_DOUBLES)}, first_pit_lap, {_zero(['pit_stop_count', 'early_pit_stop_flag'])},
         {', '.join(POS_DOUBLES)}, position_observation_count, position_total_observation_count,
         {', '.join(WEATHER_DOUBLES)}, rainfall_flag, {_zero(MSG_COUNTS)}
  from orders
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey
  left join pos on pos.driver_number = o_custkey
  left join weather on weather.driver_number = o_custkey
  left join msg on msg.driver_number = o_custkey
  left join laps on laps.session_key = o_orderkey
  left join pit on pit.session_key = o_orderkey
)"""
MART_DOUBLES = LAP_DOUBLES + PIT_DOUBLES + POS_DOUBLES + WEATHER_DOUBLES + ["result_points"]


def _replace(doubles: list[str]) -> str:
    return "select * replace (" + sql_stable(doubles) + ") from "


QUERIES = {
    "order_feature_mart": order_feature_mart,
    "lap_features": lap_features,
    "pit_features": pit_features,
    "first_n_features": first_n_features,
    "session_means": session_means,
    "event_message_counts": event_message_counts,
    "message_counts": message_counts,
}

ORACLES = {
    "order_feature_mart": f"with {MART_CTE} {_replace(MART_DOUBLES)} mart",
    "lap_features": f"with {LAPS_CTE} {_replace(LAP_DOUBLES)} laps",
    "pit_features": f"with {PIT_CTE} {_replace(PIT_DOUBLES)} pit",
    "first_n_features": f"with {EVENTS_CTE} {_replace(POS_DOUBLES)} pos",
    "session_means": f"with {EVENTS_CTE} {_replace(WEATHER_DOUBLES)} weather",
    "event_message_counts": f"with {EVENTS_CTE} select * from msg",
    "message_counts": """
        with d as (select source, lang, upper(text || ' ' || lang) as t from documents)
        select source, count(*) as race_control_message_count,
               count(*) filter (where lang is not null and lang <> '') as flag_message_count,
               count(*) filter (where contains(t, 'LICENSE')) as yellow_flag_count,
               count(*) filter (where contains(t, 'RE')) as red_flag_count,
               count(*) filter (where contains(t, 'LE ')) as green_flag_count,
               count(*) filter (where contains(t, 'ION')) + count(*) filter (where contains(t, 'TION'))
                 as safety_car_message_count,
               count(*) filter (where contains(t, '@')) as pit_exit_message_count
        from d group by source""",
}
