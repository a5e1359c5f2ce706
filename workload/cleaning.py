"""Casts, filters, de-duplication and the cleaning log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeaudit.functions.columns import cast_columns, snake_case
from lakeaudit.operators import clean as ops
from lakeaudit.operators import features as feat
from lakeaudit.operators import govern, profile
from lakeaudit.plans.race import CATALOG
from lakeaudit.spec import Rule, TableSpec
from workload import mart as mart_queries
from workload.common import RAW_LINES_SQL, raw_lines, stable_doubles, table

LINE_SPEC = TableSpec(
    name="lineitem",
    keys=("l_orderkey", "l_linenumber"),
    casts={"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_shipdate": "timestamp"},
    not_null=("l_orderkey", "l_linenumber"),
    rules=(
        Rule("SIL_LAP_NUM_POS", "Keep positive line numbers",
             lambda cols: F.col("l_linenumber") > 0, ("l_linenumber",), "high"),
        Rule("SIL_LAP_DUR_POS", "Keep missing or positive prices",
             lambda cols: F.col("l_extendedprice").isNull() | (F.col("l_extendedprice") > 0),
             ("l_extendedprice",), "high"),
    ),
    dedupe_keys=("l_orderkey", "l_linenumber"),
    dedupe_order=("l_shipdate",),
)
LOG_COLUMNS = [
    "table_name", "rule_id", "rows_before", "rows_after", "rows_removed", "values_imputed",
    "columns_affected", "severity",
]


def clean_table(spark, sf_dir):
    out = ops.clean(raw_lines(spark, sf_dir), LINE_SPEC)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


def clean_rules_log(spark, sf_dir):
    return ops.cleaning_log(raw_lines(spark, sf_dir), LINE_SPEC).select(*LOG_COLUMNS)


def rejected_records(spark, sf_dir):
    log = ops.cleaning_log(raw_lines(spark, sf_dir), LINE_SPEC)
    return ops.rejected_records(log, ["lineitem"]).select("table_name", "rule_id", "rejected_count")


def cleaning_impact(spark, sf_dir):
    raw = raw_lines(spark, sf_dir)
    before = profile.table_profile(raw, "lineitem")
    after = profile.table_profile(ops.clean(raw, LINE_SPEC), "lineitem")
    return profile.cleaning_impact(before, after)


def snake_case_names(spark, sf_dir):
    messy = table(spark, sf_dir, "events").toDF(
        "Event ID", "eventTime", "user-id", " Event Type ", "Value", "propsJson")
    return snake_case(messy)


def casts_and_timestamps(spark, sf_dir):
    out = cast_columns(raw_lines(spark, sf_dir), LINE_SPEC.casts)
    return out.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate"),
    )


def timestamp_parse(spark, sf_dir):
    """ISO text with and without fractions, and text that is no date."""
    ev = table(spark, sf_dir, "events")
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fine = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    text = (
        F.when(F.col("event_type") == "error", "at noon").when(F.col("event_type") == "view", plain)
        .otherwise(fine)
    )
    out = cast_columns(ev.select("event_id", text.alias("ts")), {"ts": "timestamp"})
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def mixed_type_normalise(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return profile.mixed_type_columns(ev.select(
        "event_id", F.col("value").cast("string").alias("value"), "props",
        F.struct("user_id", "event_type").alias("who"), F.array("user_id", "event_id").alias("ids"),
    ))


def exact_dedupe(spark, sf_dir):
    return ops.dedupe_exact(raw_lines(spark, sf_dir))


def key_dedupe(spark, sf_dir):
    return ops.dedupe_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])


def null_key_drop(spark, sf_dir):
    return ops.drop_null_keys(raw_lines(spark, sf_dir), ["l_orderkey", "l_shipdate", "absent"])


def retained_repeats(spark, sf_dir):
    """Turns of a conversation repeat a role on purpose: counted, logged and kept."""
    spec = TableSpec(
        name="conversations", keys=("conv_id",), not_null=("conv_id",), repeats_checked=("conv_id", "role"))
    log = ops.cleaning_log(table(spark, sf_dir, "conversations"), spec)
    return log.select(*LOG_COLUMNS, "rule_description").where(
        F.col("rule_id") == ops.RETAINED_RULE)


def optional_alias(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "pit_duration", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")))
    out = ops.with_optional(orders.select("o_orderkey", "o_custkey", "o_totalprice", "pit_duration"), {
        "grid_position": (["grid_position", "o_custkey"], "bigint", None),
        "stop_time": (["pit_duration", "o_totalprice"], "double", None),
        "dsq": (["dsq"], "boolean", False),
        "country": (["country"], "string", None),
    })
    return out.select("o_orderkey", "grid_position", "stop_time", "dsq", "country")


def event_filter(spark, sf_dir):
    """Latest purchase or signup per user, with an absent column added as null."""
    ev = table(spark, sf_dir, "events")
    return ops.event_sessions(
        ev, "event_type", "props", ["PURCHASE", "Signup"], "user_id",
        {"user_id": "bigint", "event_id": "bigint", "event_type": "string", "value": "double",
         "country_name": "string"},
        [F.desc("ts"), F.desc("event_id")],
    )


def zero_filled_counts(spark, sf_dir):
    """Event counts of customers, zero where a customer has no events."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("driver_number"))
    counts = mart_queries.event_message_counts(spark, sf_dir)
    joined = feat.feature_left_join(people, counts, ["driver_number"])
    return ops.zero_fill(joined, list(feat.EVENT_COUNT_COLUMNS))


def select_features(spark, sf_dir):
    mart = mart_queries.mart(spark, sf_dir)
    names = govern.resolve_features(CATALOG, plan=govern.feature_plan(spark, CATALOG))
    return stable_doubles(govern.select_features(mart, names, "points_finish", keep=("session_key",)))


# --- checks -----------------------------------------------------------------------------------

STEPS_SQL = f"""
{RAW_LINES_SQL},
s_cast as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, try_cast(l_quantity as double) as l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
         try_cast(l_shipdate as timestamp) as l_shipdate
  from raw_lines
),
s_keys as (select * from s_cast where l_orderkey is not null and l_linenumber is not null),
s_number as (select * from s_keys where l_linenumber > 0),
s_price as (select * from s_number where l_extendedprice is null or l_extendedprice > 0),
s_exact as (select distinct * from s_price),
s_ranked as (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber
    order by l_shipdate nulls first, l_partkey, l_suppkey, l_quantity nulls first, l_extendedprice,
             l_discount, l_tax, l_returnflag, l_linestatus) as nth
  from s_exact
),
s_clean as (select * exclude (nth) from s_ranked where nth = 1)
"""


def _log_step(rule, before, after, columns, severity):
    return (
        f"select 'lineitem' as table_name, '{rule}' as rule_id, "
        f"(select count(*) from {before}) as rows_before, (select count(*) from {after}) as rows_after, "
        f"(select count(*) from {before}) - (select count(*) from {after}) as rows_removed, "
        f"cast(0 as bigint) as values_imputed, '{columns}' as columns_affected, '{severity}' as severity"
    )


LOG_SQL = " union all ".join([
    _log_step("SIL_RENAME", "raw_lines", "raw_lines", "", "low"),
    _log_step("SIL_CAST_NUM", "raw_lines", "s_cast", "l_orderkey,l_linenumber,l_quantity,l_shipdate", "low"),
    _log_step("SIL_DROP_NULL_KEYS", "s_cast", "s_keys", "l_orderkey,l_linenumber", "high"),
    _log_step("SIL_LAP_NUM_POS", "s_keys", "s_number", "l_linenumber", "high"),
    _log_step("SIL_LAP_DUR_POS", "s_number", "s_price", "l_extendedprice", "high"),
    _log_step("SIL_DUP_FULL", "s_price", "s_exact", "", "medium"),
    _log_step("SIL_DUP_KEY", "s_exact", "s_clean", "l_orderkey,l_linenumber", "high"),
])


def _profile_sql(rel: str, columns: list[str]) -> str:
    missing = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in columns)
    return (
        f"select count(*) as n, (select count(*) from (select distinct * from {rel})) as d, "
        f"cast(sum({missing}) as bigint) as m from {rel}"
    )


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
KEY_DEDUPE_SQL = """
select * exclude (nth) from (
  select *, row_number() over (
    partition by l_orderkey, l_linenumber
    order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) as nth
  from lineitem) where nth = 1
"""

QUERIES = {
    "clean_table": clean_table,
    "clean_rules_log": clean_rules_log,
    "rejected_records": rejected_records,
    "cleaning_impact": cleaning_impact,
    "snake_case": snake_case_names,
    "casts_and_timestamps": casts_and_timestamps,
    "timestamp_parse": timestamp_parse,
    "mixed_type_normalise": mixed_type_normalise,
    "exact_dedupe": exact_dedupe,
    "key_dedupe": key_dedupe,
    "null_key_drop": null_key_drop,
    "retained_repeats": retained_repeats,
    "optional_alias": optional_alias,
    "event_filter": event_filter,
    "zero_filled_counts": zero_filled_counts,
    "select_features": select_features,
}

MODEL_FEATURES = [c for c in CATALOG.default_numeric]
_DOUBLE = set(mart_queries.MART_DOUBLES)

ORACLES = {
    "clean_table": f"with {STEPS_SQL} select * from s_clean",
    "clean_rules_log": f"with {STEPS_SQL} {LOG_SQL}",
    "rejected_records": (
        f"with {STEPS_SQL}, log as ({LOG_SQL}) "
        "select table_name, rule_id, rows_removed as rejected_count from log where rows_removed > 0"
    ),
    "cleaning_impact": f"""
        with {STEPS_SQL}, b as ({_profile_sql('raw_lines', LINE_COLUMNS)}),
        a as ({_profile_sql('s_clean', LINE_COLUMNS)})
        select 'lineitem' as table_name, b.n as rows_before, a.n as rows_after,
               b.n - a.n as rows_removed, round((b.n - a.n) * 100.0::double / b.n, 4) as row_removal_pct,
               cast(11 as bigint) as columns_before, cast(11 as bigint) as columns_after,
               b.m as missing_cells_before, a.m as missing_cells_after,
               round(b.m * 100.0::double / (b.n * 11), 4) as missing_cell_pct_before,
               round(a.m * 100.0::double / (a.n * 11), 4) as missing_cell_pct_after,
               b.n - b.d as duplicate_rows_before, a.n - a.d as duplicate_rows_after
        from a, b""",
    "snake_case": """
        select event_id, ts as event_time, user_id, event_type, value, props as props_json from events""",
    "casts_and_timestamps": f"""
        with {STEPS_SQL} select l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate from s_cast""",
    "timestamp_parse": """
        select event_id, case when event_type = 'error' then null
                              when event_type = 'view' then date_trunc('second', ts) else ts end as ts
        from events""",
    "mixed_type_normalise": """
        select event_id, value, props,
               '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as who,
               '[' || user_id || ',' || event_id || ']' as ids
        from events""",
    "exact_dedupe": f"with {RAW_LINES_SQL} select distinct * from raw_lines",
    "key_dedupe": KEY_DEDUPE_SQL,
    "null_key_drop": f"""
        with {RAW_LINES_SQL} select * from raw_lines where l_orderkey is not null and l_shipdate is not null""",
    "retained_repeats": """
        with c as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
        g as (select conv_id, role, count(*) as n from c group by conv_id, role having count(*) > 1)
        select 'conversations' as table_name, 'SIL_RC_DUP_CHECK_RETAINED' as rule_id,
               (select count(*) from c) as rows_before, (select count(*) from c) as rows_after,
               cast(0 as bigint) as rows_removed, cast(0 as bigint) as values_imputed,
               'conv_id,role' as columns_affected, 'low' as severity,
               (select count(*) from g) || ' keys repeat in ' || (select sum(n) from g)
                 || ' rows; all kept' as rule_description""",
    "optional_alias": """
        select o_orderkey, o_custkey as grid_position, o_totalprice as stop_time, false as dsq,
               cast(null as varchar) as country
        from orders""",
    "event_filter": """
        select user_id, event_id, event_type, value, cast(null as varchar) as country_name from (
          select *, row_number() over (partition by user_id order by ts desc, event_id desc) as nth
          from events where lower(event_type) in ('purchase', 'signup')
             or lower(props) in ('purchase', 'signup')) where nth = 1""",
    "zero_filled_counts": f"""
        with {mart_queries.EVENTS_CTE}
        select c_custkey as driver_number, {mart_queries._zero(mart_queries.MSG_COUNTS)}
        from customer left join msg on msg.driver_number = c_custkey""",
    "select_features": f"""
        with {mart_queries.MART_CTE} select session_key, points_finish, """
        + ", ".join(f"round({c} + 1e-7, 4) as {c}" if c in _DOUBLE else c for c in MODEL_FEATURES)
        + " from mart",
}
