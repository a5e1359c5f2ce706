"""Profiles and data-quality audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeaudit.functions.columns import cast_columns
from lakeaudit.operators import audit, features as feat, profile
from lakeaudit.operators.clean import clean
from lakeaudit.spec import ForeignKey
from workload import mart as mart_queries
from workload.cleaning import LINE_COLUMNS, LINE_SPEC, STEPS_SQL
from workload.common import RAW_LINES_SQL, raw_lines, table

DOMAIN_RULES = [
    ("l_linenumber", "l_linenumber <= 0"),
    ("l_extendedprice", "l_extendedprice <= 0"),
    ("l_quantity", "l_quantity <= 0"),
    ("absent", "absent <= 0"),
]


def missingness(spark, sf_dir):
    return profile.missingness(raw_lines(spark, sf_dir), "lineitem")


def mart_missingness(spark, sf_dir):
    """Null counts of every mart column."""
    return profile.null_counts(mart_queries.mart(spark, sf_dir), "gold")


def numeric_summary(spark, sf_dir):
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), "lineitem")


def numeric_summary_approx(spark, sf_dir):
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), "lineitem", approx=True)


def numeric_summary_approx_check(spark, sf_dir):
    """Count and extremes of every column, and whether each sketched percentile's rank is within a hundredth."""
    lines = table(spark, sf_dir, "lineitem")
    sketched = profile.numeric_summary(lines, "lineitem", approx=True)
    cells = lines.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC]).unpivot([], NUMERIC, "column_name", "cell")
    joined = cells.join(F.broadcast(sketched), "column_name")  # a row per column
    ranks = [
        (F.avg((F.col("cell") < F.col(q)).cast("int")) <= p + 0.01) & (F.avg((F.col("cell") <= F.col(q)).cast("int")) >= p - 0.01)
        for q, p in profile.SUMMARY_QUANTILES.items()]
    return joined.groupBy("column_name", "count", "min", "max").agg(reduce(lambda a, b: a & b, ranks).alias("ranks_hold"))


def table_profile(spark, sf_dir):
    out = profile.table_profile(raw_lines(spark, sf_dir), "raw_lines")
    for name in ("documents", "conversations", "embeddings"):
        out = out.unionByName(profile.table_profile(table(spark, sf_dir, name), name))
    return out


def full_row_duplicates(spark, sf_dir):
    docs = audit.full_row_duplicates(table(spark, sf_dir, "documents"), "documents", ["text", "lang"])
    return docs.unionByName(audit.full_row_duplicates(raw_lines(spark, sf_dir), "lineitem"))


def key_duplicates(spark, sf_dir):
    lines = audit.key_duplicates(table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    raw = audit.key_duplicates(raw_lines(spark, sf_dir), "raw_lines", ["l_orderkey", "l_linenumber"])
    absent = audit.key_duplicates(table(spark, sf_dir, "orders"), "orders", ["o_orderkey", "absent"])
    return lines.unionByName(raw).unionByName(absent)


def duplicate_report(spark, sf_dir):
    tables = {n: table(spark, sf_dir, n) for n in ("lineitem", "events", "conversations")}
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "events": ["user_id", "event_type"]}
    return audit.duplicate_report(tables, keys, "before")


def iqr_outliers(spark, sf_dir):
    lines = audit.iqr_outliers(table(spark, sf_dir, "lineitem"), "lineitem", ["l_extendedprice", "l_quantity"])
    return lines.unionByName(audit.iqr_outliers(table(spark, sf_dir, "events"), "events", ["value"]))


def _cast_lines(spark, sf_dir):
    return cast_columns(raw_lines(spark, sf_dir), LINE_SPEC.casts)


def domain_violations(spark, sf_dir):
    return audit.domain_violations(_cast_lines(spark, sf_dir), "lineitem", DOMAIN_RULES)


def outlier_report(spark, sf_dir):
    return audit.outlier_report(
        {"lineitem": _cast_lines(spark, sf_dir), "events": table(spark, sf_dir, "events")},
        {"lineitem": ["l_extendedprice"], "events": ["value"]}, {"lineitem": DOMAIN_RULES}, "before")


def temporal_lag(spark, sf_dir):
    return audit.lag_decrease(
        table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey"], "l_linenumber", "l_shipdate")


def _order_periods(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("opened"),
        (F.col("o_orderdate") + F.expr("interval 60 days")).alias("closed"))


def temporal_bounds(spark, sf_dir):
    return audit.outside_bounds(
        table(spark, sf_dir, "lineitem"), _order_periods(spark, sf_dir), "lineitem", "l_orderkey",
        "l_shipdate", "opened", "closed")


def temporal_report(spark, sf_dir):
    """Row checks on the raw feed, then lag and bounds on the clean table."""
    rows = audit.row_time_checks(raw_lines(spark, sf_dir), "raw_lines", positive="l_linenumber")
    orders = audit.row_time_checks(_order_periods(spark, sf_dir), "orders", ("opened", "closed"))
    parts = [rows, orders, temporal_lag(spark, sf_dir), temporal_bounds(spark, sf_dir)]
    return audit.union_reports(parts).withColumn("stage", F.lit("before")).drop("notes")


EDGES = [
    ForeignKey("orders", "customer", ("o_custkey",), ("c_custkey",)),
    ForeignKey("lineitem", "orders", ("l_orderkey",), ("o_orderkey",)),
    ForeignKey("orders", "lineitem", ("o_orderkey",), ("l_orderkey",)),
    ForeignKey("lineitem", "part", ("l_partkey",), ("p_partkey",)),
    ForeignKey("lineitem", "supplier", ("l_suppkey",), ("s_suppkey",)),
    ForeignKey("customer", "nation", ("c_nationkey",), ("n_nationkey",)),
    ForeignKey("supplier", "nation", ("s_nationkey",), ("n_nationkey",)),
    ForeignKey("nation", "region", ("n_regionkey",), ("r_regionkey",)),
    ForeignKey("labels", "documents", ("doc_id",)),
    ForeignKey("documents", "labels", ("doc_id",)),
    ForeignKey("customer", "events", ("c_custkey",), ("user_id",)),
    ForeignKey("orders", "pages", ("o_orderkey",), ("absent",)),
    ForeignKey("events", "sessions", ("user_id",)),
]


def fk_check(spark, sf_dir):
    return audit.fk_check(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"), "orders", "events",
        ["o_custkey"], ["user_id"])


def fk_suite(spark, sf_dir):
    names = sorted({e.child for e in EDGES} | {e.parent for e in EDGES} - {"sessions"})
    return audit.fk_suite({n: table(spark, sf_dir, n) for n in names}, EDGES, "after")


def join_quality(spark, sf_dir):
    """A feature table with one row per order, and one with many."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("session_key"), "o_custkey")
    stops = mart_queries.pit_features(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("session_key"), "l_tax")
    return feat.join_quality(orders, stops, ["session_key"], "pit").unionByName(
        feat.join_quality(orders, lines, ["session_key"], "lines"))


def missing_before_after(spark, sf_dir):
    raw = raw_lines(spark, sf_dir)
    before = profile.null_counts(raw, "lineitem")
    return profile.missingness_before_after(before, profile.null_counts(clean(raw, LINE_SPEC), "lineitem"))


def top_missing(spark, sf_dir):
    return profile.top_missing(profile.null_counts(mart_queries.mart(spark, sf_dir), "gold"), 10)


def top_k_per_group(spark, sf_dir):
    """Five most-missing columns of the raw lines and of the mart."""
    report = profile.null_counts(raw_lines(spark, sf_dir), "lineitem").unionByName(
        profile.null_counts(mart_queries.mart(spark, sf_dir), "gold"))
    return profile.top_missing_per_table(report, 5)


def union_reports(spark, sf_dir):
    """Reports with different columns, before and after cleaning."""
    raw = raw_lines(spark, sf_dir)
    key = ["l_orderkey", "l_linenumber"]
    parts = []
    for stage, df in (("before", raw), ("after", clean(raw, LINE_SPEC))):
        part = audit.union_reports([
            audit.key_duplicates(df, "lineitem", key), audit.full_row_duplicates(df, "lineitem")])
        parts.append(part.withColumn("stage", F.lit(stage)))
    return audit.union_reports(parts)


def error_taxonomy(spark, sf_dir):
    return audit.error_taxonomy({
        "duplicate": duplicate_report(spark, sf_dir), "outlier": outlier_report(spark, sf_dir),
        "temporal": temporal_report(spark, sf_dir), "referential_integrity": fk_suite(spark, sf_dir),
    })


def lookup_backfill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(-1)).cast("bigint").alias("meeting_key"))
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("nation"))
    out = feat.lookup_backfill(orders, customers, "o_custkey", "meeting_key", "c_custkey", "nation")
    return out.select("o_orderkey", "o_custkey", "meeting_key")


def metadata_star(spark, sf_dir):
    keep = ["driver_number", "full_name", "team_name", "driver_country_code", "circuit_key", "meeting_name"]
    return mart_queries.drivers(spark, sf_dir).select(*keep)


# --- checks -----------------------------------------------------------------------------------

RAW_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "string", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "string",
}


def _missing_sql(rel, label, column, dtype=None):
    kind = f"'{dtype}' as dtype, " if dtype else ""
    distinct = (
        f", count({column}) as non_missing_count, count(distinct {column}) as unique_count" if dtype else "")
    return (
        f"select '{label}' as table_name, '{column}' as column_name, {kind}"
        f"count(*) - count({column}) as missing_count, "
        f"round((count(*) - count({column})) * 100.0::double / count(*), 4) as missing_pct{distinct} from {rel}"
    )


MART_COLUMNS = (
    mart_queries.GRAIN
    + ["result_dnf", "result_dns", "result_dsq", "result_points", "points_finish", "final_position",
       "session_type", "circuit_short_name", "session_year", "session_country_name", "full_name",
       "team_name", "driver_country_code", "circuit_key", "meeting_name"]
    + mart_queries.LAP_DOUBLES + ["lap_count", "pit_out_lap_count"] + mart_queries.PIT_DOUBLES
    + ["first_pit_lap", "pit_stop_count", "early_pit_stop_flag"] + mart_queries.POS_DOUBLES
    + ["position_observation_count", "position_total_observation_count"]
    + mart_queries.WEATHER_DOUBLES + ["rainfall_flag"] + mart_queries.MSG_COUNTS
)
MART_MISSING = " union all ".join(_missing_sql("mart", "gold", c) for c in MART_COLUMNS)
RAW_NULLS = " union all ".join(_missing_sql("raw_lines", "lineitem", c) for c in LINE_COLUMNS)
CLEAN_NULLS = " union all ".join(_missing_sql("s_clean", "lineitem", c) for c in LINE_COLUMNS)


def _summary_sql(column):
    x = f"cast({column} as double)"
    qs = ", ".join(
        f"round(quantile_cont({x}, {p}), 6) as {n}" for n, p in profile.SUMMARY_QUANTILES.items())
    return (
        f"select 'lineitem' as table_name, '{column}' as column_name, count({column}) as count, "
        # an exact sum, rounded half-up on its decimal digits: the mean of l_tax ends in a 5
        f"cast(round(cast(favg({x}) as decimal(38, 12)), 6) as double) as mean, round(coalesce(stddev_samp({x}), 0), 6) as std, "
        f"round(min({x}), 6) as min, {qs}, round(max({x}), 6) as max from lineitem"
    )


NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_row(rel, columns):
    missing = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in columns)
    w = len(columns)
    return (
        f"select '{rel}' as table_name, count(*) as row_count, cast({w} as bigint) as column_count, "
        f"count(*) - (select count(*) from (select distinct * from {rel})) as duplicate_full_rows, "
        f"cast(sum({missing}) as bigint) as total_missing_cells, count(*) * {w} as total_cells, "
        f"round(cast(sum({missing}) as double) * 100.0::double / (count(*) * {w}), 4) as missing_cell_pct from {rel}"
    )


def _key_dup_sql(rel, label, keys):
    cols = ", ".join(keys)
    return f"""
        select '{label}' as table_name, 'key_duplicate' as duplicate_type, '{",".join(keys)}' as key_columns,
               count(*) filter (where n > 1) as duplicate_key_count,
               cast(coalesce(sum(n) filter (where n > 1), 0) as bigint) as affected_rows,
               round(coalesce(sum(n) filter (where n > 1), 0)::double * 100.0::double / sum(n), 4) as affected_rows_pct,
               'checked' as status
        from (select {cols}, count(*) as n from {rel} group by {cols})"""


def _full_dup_sql(rel, label, columns="*"):
    return f"""
        select '{label}' as table_name, 'full_row' as duplicate_type,
               count(*) - (select count(*) from (select distinct {columns} from {rel})) as duplicate_count,
               round((count(*) - (select count(*) from (select distinct {columns} from {rel})))
                     * 100.0::double / count(*), 4) as duplicate_pct
        from {rel}"""


def _iqr_sql(rel, label, column):
    return f"""
        select '{label}' as table_name, '{column}' as column_name, 'iqr' as method,
               round(lo, 6) as lower_bound, round(hi, 6) as upper_bound,
               count(*) filter (where {column} < lo or {column} > hi) as outlier_count,
               round(count(*) filter (where {column} < lo or {column} > hi) * 100.0::double / count(*), 4)
                 as outlier_pct,
               round(min({column}), 6) as min_value, round(max({column}), 6) as max_value
        from {rel}, (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from (
          select quantile_cont({column}, 0.25) as q1, quantile_cont({column}, 0.75) as q3 from {rel}))
        group by lo, hi"""


DOMAIN_SQL = " union all ".join(
    f"""select 'lineitem' as table_name, '{c}' as column_name, '{rule}' as rule,
        count(*) filter (where {rule}) as invalid_count,
        round(count(*) filter (where {rule}) * 100.0::double / count(*), 4) as invalid_pct from s_cast"""
    for c, rule in DOMAIN_RULES if c != "absent"
)


def _anomaly_sql(label, kind, column, condition, rel, note=None):
    text = f", '{note}' as notes" if note else ""
    return (
        f"select '{label}' as table_name, '{kind}' as anomaly_type, '{column}' as column_name, "
        f"count(*) filter (where {condition}) as anomaly_count, "
        f"round(count(*) filter (where {condition}) * 100.0::double / count(*), 4) as anomaly_pct{text} from {rel}"
    )


LAG_REL = """(select l_linenumber, lag(l_linenumber) over (
    partition by l_orderkey order by l_shipdate, l_linenumber) as before from lineitem)"""
BOUNDS_REL = "lineitem left join orders on l_orderkey = o_orderkey"
BOUNDS_IF = "o_orderdate is not null and (l_shipdate < o_orderdate or l_shipdate > o_orderdate + interval 60 day)"
LAG_NOTE = "Number decreased when ordered within its group"
BOUNDS_NOTE = "Timestamp outside the parent''s start and end"


def _temporal(note):
    return [
        _anomaly_sql("lineitem", "lap_number_decrease_within_stint", "l_linenumber",
                     "l_linenumber < before", LAG_REL, LAG_NOTE if note else None),
        _anomaly_sql("lineitem", "weather_outside_session_bounds", "l_shipdate", BOUNDS_IF, BOUNDS_REL,
                     BOUNDS_NOTE if note else None),
    ]


TEMPORAL_SQL = " union all ".join([
    _anomaly_sql("raw_lines", "unparseable_datetime", "l_shipdate",
                 "l_shipdate is not null and try_cast(l_shipdate as timestamp) is null", "raw_lines"),
    _anomaly_sql("raw_lines", "pit_lap_non_positive", "l_linenumber", "l_linenumber <= 0", "raw_lines"),
    _anomaly_sql("orders", "date_start_after_date_end", "opened,closed",
                 "o_orderdate > o_orderdate + interval 60 day", "orders"),
    *_temporal(False),
])


def _fk_sql(child, parent, ck, pk):
    return f"""
        select '{child}' as child_table, '{parent}' as parent_table, '{ck}' as key_columns,
               count(*) as distinct_child_keys,
               count(*) filter (where p is null) as unmatched_rows,
               round(count(*) filter (where p is null) * 100.0::double / count(*), 4) as unmatched_pct,
               'checked' as status
        from (select distinct {ck} as c from {child} where {ck} is not null)
        left join (select distinct {pk} as p from {parent} where {pk} is not null) on c = p"""


def _fk_skip(child, parent, ck, status):
    return f"""
        select '{child}' as child_table, '{parent}' as parent_table, '{ck}' as key_columns,
               cast(null as bigint) as distinct_child_keys, cast(0 as bigint) as unmatched_rows,
               cast(0 as double) as unmatched_pct, '{status}' as status"""


FK_SQL = " union all ".join(
    _fk_skip("orders", "pages", "o_orderkey", "skipped_missing_columns") if e.parent == "pages"
    else _fk_skip("events", "sessions", "user_id", "skipped_missing_table") if e.parent == "sessions"
    else _fk_sql(e.child, e.parent, e.columns[0], (e.parent_columns or e.columns)[0])
    for e in EDGES
)


def _join_quality_sql(group, rel):
    return f"""
        select '{group}' as feature_group, (select count(*) from orders) as rows_before,
               count(*) as rows_after, cast(0 as bigint) as unmatched_base_rows, cast(0 as double) as unmatched_pct,
               count(*) filter (where k is null) as base_rows_without_match,
               round(count(*) filter (where k is null) * 100.0::double / (select count(*) from orders), 4)
                 as without_match_pct, '' as notes
        from orders left join (select l_orderkey as k from {rel}) on o_orderkey = k"""


DUP_KEY_LINE = _key_dup_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])
KEY_NULLS = (
    "cast(null as varchar) as key_columns, cast(null as bigint) as duplicate_key_count, "
    "cast(null as bigint) as affected_rows, cast(null as double) as affected_rows_pct, cast(null as varchar) as status"
)
FULL_NULLS = "cast(null as bigint) as duplicate_count, cast(null as double) as duplicate_pct"


def _dup_pair(rel, label, keys, stage):
    out = f"select *, {KEY_NULLS}, '{stage}' as stage from ({_full_dup_sql(rel, label)})"
    if keys:
        cols = ("table_name, duplicate_type, " + FULL_NULLS + ", key_columns, duplicate_key_count, "
                "affected_rows, affected_rows_pct, status")
        out += f" union all select {cols}, '{stage}' as stage from ({_key_dup_sql(rel, label, keys)})"
    return out


DUPLICATE_REPORT_SQL = " union all ".join([
    _dup_pair("lineitem", "lineitem", ["l_orderkey", "l_linenumber"], "before"),
    _dup_pair("events", "events", ["user_id", "event_type"], "before"),
    _dup_pair("conversations", "conversations", None, "before"),
])
OUTLIER_REPORT_SQL = f"""
    select *, 'iqr' as report_type, cast(null as varchar) as rule, cast(null as bigint) as invalid_count,
           cast(null as double) as invalid_pct, 'before' as stage from (
      {_iqr_sql('s_cast', 'lineitem', 'l_extendedprice')} union all {_iqr_sql('events', 'events', 'value')})
    union all
    select table_name, column_name, null, null, null, null, null, null, null, 'domain', rule, invalid_count,
           invalid_pct, 'before' from ({DOMAIN_SQL})"""

QUERIES = {
    "missingness": missingness,
    "mart_missingness": mart_missingness,
    "numeric_summary": numeric_summary,
    "numeric_summary_approx_check": numeric_summary_approx_check,
    "table_profile": table_profile,
    "full_row_duplicates": full_row_duplicates,
    "key_duplicates": key_duplicates,
    "duplicate_report": duplicate_report,
    "iqr_outliers": iqr_outliers,
    "domain_violations": domain_violations,
    "outlier_report": outlier_report,
    "temporal_lag": temporal_lag,
    "temporal_bounds": temporal_bounds,
    "temporal_report": temporal_report,
    "fk_check": fk_check,
    "fk_suite": fk_suite,
    "join_quality": join_quality,
    "missing_before_after": missing_before_after,
    "top_missing": top_missing,
    "top_k_per_group": top_k_per_group,
    "union_reports": union_reports,
    "error_taxonomy": error_taxonomy,
    "lookup_backfill": lookup_backfill,
    "metadata_star": metadata_star,
}

#: Sketches, which SQL does not give; ``numeric_summary_approx_check`` holds what it can say of them.
UNCHECKED = {"numeric_summary_approx": numeric_summary_approx}

ORACLES = {
    "missingness": f"with {RAW_LINES_SQL} " + " union all ".join(
        _missing_sql("raw_lines", "lineitem", c, t) for c, t in RAW_TYPES.items()),
    "mart_missingness": f"with {mart_queries.MART_CTE} {MART_MISSING}",
    "numeric_summary": " union all ".join(_summary_sql(c) for c in NUMERIC),
    "numeric_summary_approx_check": " union all ".join(
        f"select '{c}' as column_name, count({c}) as count, round(cast(min({c}) as double), 6) as min, "
        f"round(cast(max({c}) as double), 6) as max, true as ranks_hold from lineitem" for c in NUMERIC),
    "table_profile": f"with {RAW_LINES_SQL} " + " union all ".join([
        _profile_row("raw_lines", LINE_COLUMNS),
        _profile_row("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
        _profile_row("conversations", ["conv_id", "turn", "role", "text"]),
        _profile_row("embeddings", ["vec_id", "embedding", "label"]),
    ]),
    "full_row_duplicates": (
        f"with {RAW_LINES_SQL} {_full_dup_sql('documents', 'documents', 'text, lang')} "
        f"union all {_full_dup_sql('raw_lines', 'lineitem')}"
    ),
    "key_duplicates": (
        f"with {RAW_LINES_SQL} {DUP_KEY_LINE} union all "
        f"{_key_dup_sql('raw_lines', 'raw_lines', ['l_orderkey', 'l_linenumber'])} union all "
        "select 'orders', 'key_duplicate', 'o_orderkey,absent', 0, 0, 0.0, 'skipped_missing_columns'"
    ),
    "duplicate_report": DUPLICATE_REPORT_SQL,
    "iqr_outliers": " union all ".join([
        _iqr_sql("lineitem", "lineitem", "l_extendedprice"), _iqr_sql("lineitem", "lineitem", "l_quantity"),
        _iqr_sql("events", "events", "value")]),
    "domain_violations": f"with {STEPS_SQL} {DOMAIN_SQL}",
    "outlier_report": f"with {STEPS_SQL} {OUTLIER_REPORT_SQL}",
    "temporal_lag": _temporal(True)[0],
    "temporal_bounds": _temporal(True)[1],
    "temporal_report": f"with {RAW_LINES_SQL} select *, 'before' as stage from ({TEMPORAL_SQL})",
    "fk_check": _fk_sql("orders", "events", "o_custkey", "user_id"),
    "fk_suite": f"select *, 'after' as stage from ({FK_SQL})",
    "join_quality": (
        _join_quality_sql("pit", "(select distinct l_orderkey from lineitem where l_returnflag = 'R')")
        + " union all " + _join_quality_sql("lines", "lineitem")),
    "missing_before_after": f"""
        with {STEPS_SQL}, b as ({RAW_NULLS}), a as ({CLEAN_NULLS})
        select table_name, column_name, b.missing_pct as missing_pct_before,
               a.missing_pct as missing_pct_after, round(a.missing_pct - b.missing_pct, 4) as missing_pct_change
        from b join a using (table_name, column_name)""",
    "top_missing": f"""
        with {mart_queries.MART_CTE} select * from ({MART_MISSING})
        order by missing_pct desc, table_name, column_name limit 10""",
    "top_k_per_group": f"""
        with {RAW_LINES_SQL}, {mart_queries.MART_CTE},
        report as ({RAW_NULLS} union all {MART_MISSING})
        select * from (select *, cast(row_number() over (
          partition by table_name order by missing_pct desc, column_name) as integer) as missing_rank from report)
        where missing_rank <= 5""",
    "union_reports": f"""
        with {STEPS_SQL} {_dup_pair('raw_lines', 'lineitem', ['l_orderkey', 'l_linenumber'], 'before')} union all
        {_dup_pair('s_clean', 'lineitem', ['l_orderkey', 'l_linenumber'], 'after')}""",
    "error_taxonomy": f"""
        with {STEPS_SQL} select 'duplicate' as report_type, count(*) as issue_rows, 'duplicate' as source_file
        from ({DUPLICATE_REPORT_SQL})
        union all select 'outlier', count(*), 'outlier' from ({OUTLIER_REPORT_SQL})
        union all select 'temporal', count(*), 'temporal' from ({TEMPORAL_SQL})
        union all select 'referential_integrity', count(*), 'referential_integrity' from ({FK_SQL})""",
    "lookup_backfill": """
        select o_orderkey, o_custkey,
               case when o_orderstatus = 'F' then cast(-1 as bigint) else cast(c_nationkey as bigint) end as meeting_key
        from orders left join customer on o_custkey = c_custkey""",
    "metadata_star": """
        select c_custkey as driver_number, c_name as full_name, c_mktsegment as team_name,
               n_name as driver_country_code, cast(n_regionkey as bigint) as circuit_key, r_name as meeting_name
        from customer left join nation on c_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey""",
}
