"""Manifests, reconciliation, landing and file scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakeaudit.functions.durable import scratch_path
from lakeaudit.operators import checks, reconcile as ops
from lakeaudit.operators.clean import clean
from lakeaudit.plans import jobs, race
from lakeaudit.sources import files, landing
from workload.common import table

TYPES = ("click", "error", "purchase", "signup", "view")
OPTIONAL = ("signup",)
SESSION = ("click", "error", "purchase", "signup")

# A slice is one event type on one day; a slice without a day is global. What the manifest and the
# disk say about a slice deviates on some days of the month, so that every outcome occurs.
SLICES_SQL = """
slices as (
  select event_type as endpoint, cast(year(ts) as bigint) as year, cast(day(ts) as bigint) as session_key,
         count(*) as n
  from events group by 1, 2, 3
  union all
  select event_type, cast(year(ts) as bigint), cast(null as bigint), count(*) from events group by 1, 2
),
manifest as (
  select endpoint, year, session_key, concat(endpoint, '/', cast(coalesce(session_key, 0) as varchar(9))) as output_path,
         case when session_key in (5, 20) then 0 when session_key = 9 then n + 1 else n end as record_count,
         case when session_key in (5, 20) or (session_key is null and endpoint = 'view') then 'failed'
              else 'success' end as status,
         case when session_key in (5, 20) then 'timeout' else '' end as error_message,
         '2024-02-01T10:00:00+00:00' as ingestion_timestamp_utc
  from slices where session_key is null or session_key <> 12
  union all
  select endpoint, year, session_key, concat(endpoint, '/again'), 0, 'failed', 'refused',
         '2024-02-02T10:00:00+00:00'
  from slices where session_key in (20, 22)
),
files as (
  select endpoint, year, session_key, concat(endpoint, '/', cast(coalesce(session_key, 0) as varchar(9)), '.jsonl') as file_path,
         n as row_count, n * 100 as file_size_bytes
  from slices where (session_key is null and endpoint <> 'view') or session_key not in (15, 20)
  union all
  select endpoint, year, session_key, concat(endpoint, '/copy.jsonl'), n - 1, n * 90
  from slices where session_key = 22
),
retries as (
  select endpoint, year, session_key, concat(endpoint, '/retry') as output_path,
         case when endpoint in ('click', 'view') then n else 0 end as record_count,
         case when endpoint in ('click', 'view') then 'success' else 'failed' end as status,
         case when endpoint in ('click', 'view') then '' else 'timeout' end as error_message,
         '2024-02-03T10:00:00+00:00' as ingestion_timestamp_utc
  from slices where session_key in (5, 20)
)
"""


def _frame(spark, sf_dir, name):
    query = SLICES_SQL.replace("from events", "from {events}")
    return spark.sql(f"with {query} select * from {name}", events=table(spark, sf_dir, "events"))


def _manifest(spark, sf_dir):
    return _frame(spark, sf_dir, "manifest")


def _reconciled(spark, sf_dir):
    return ops.reconcile(_manifest(spark, sf_dir), _frame(spark, sf_dir, "files"), OPTIONAL, SESSION)


def latest_preferred(spark, sf_dir):
    return ops.latest_per_slice(_manifest(spark, sf_dir))


def largest_per_key(spark, sf_dir):
    return ops.largest_per_slice(_frame(spark, sf_dir, "files"))


def reconcile(spark, sf_dir):
    return _reconciled(spark, sf_dir)


def reconcile_rollup(spark, sf_dir):
    return ops.rollup(_reconciled(spark, sf_dir))


def layer_gate(spark, sf_dir):
    return ops.layer_gate(_reconciled(spark, sf_dir))


def overlay_upsert(spark, sf_dir):
    return ops.overlay(_manifest(spark, sf_dir), _frame(spark, sf_dir, "retries"))


def retry_plan(spark, sf_dir):
    return ops.retry_plan(_manifest(spark, sf_dir), optional=OPTIONAL, session=TYPES)


def manifest_summary(spark, sf_dir):
    return ops.manifest_summary(_manifest(spark, sf_dir))


def manifest_totals(spark, sf_dir):
    return ops.manifest_totals(_manifest(spark, sf_dir), ("click", "view"))


def retry_summary(spark, sf_dir):
    return ops.retry_summary(_frame(spark, sf_dir, "retries"))


def retry_status_pivot(spark, sf_dir):
    return ops.retry_status_pivot(_frame(spark, sf_dir, "retries"))


def coverage_check(spark, sf_dir):
    original, retries = _manifest(spark, sf_dir), _frame(spark, sf_dir, "retries")
    return ops.coverage(original, retries, ops.overlay(original, retries), _frame(spark, sf_dir, "files"))


def _schema_lines(spark, sf_dir):
    """One JSON line per order, filed by status and year; high prices lack a key, some are text."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderstatus").alias("endpoint"), F.year("o_orderdate").cast("string").alias("file_path"),
        F.to_json(F.struct(
            "o_orderkey", "o_orderpriority",
            F.when(F.year("o_orderdate") > 1996, F.col("o_custkey")).alias("o_custkey"),
            F.when(F.col("o_totalprice") > 250000, F.lit(True)).alias("large"),
        )).alias("value"),
    )


def schema_profile(spark, sf_dir):
    return files.schema_profile(_schema_lines(spark, sf_dir)).drop("filled_pct")


def schema_drift(spark, sf_dir):
    return ops.schema_drift(files.schema_profile(_schema_lines(spark, sf_dir)))


def schema_drift_flags(spark, sf_dir):
    row_counts = _frame(spark, sf_dir, "files")
    return checks.bronze_checks(row_counts, drift=schema_drift(spark, sf_dir))["schema_drift_flags"]


def _bronze(spark, sf_dir, name):
    files_frame = _frame(spark, sf_dir, "files")
    return checks.bronze_checks(
        files_frame, inventory=files_frame, reconciled=_reconciled(spark, sf_dir))[name]


def _bronze_query(name):
    return lambda spark, sf_dir: _bronze(spark, sf_dir, name)


# --- landing and scans ------------------------------------------------------------------------

EVENT_DDL = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def slice_files(spark, sf_dir):
    return _frame(spark, sf_dir, "files")


def _records(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("endpoint"), F.year("ts").cast("bigint").alias("year"),
        F.day("ts").cast("bigint").alias("session_key"),
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type",
        "value", "props",
    )


def _land(spark, sf_dir):
    """All slices; day 5 is a slice without a session."""
    root = scratch_path(spark, "landed")
    records = _records(spark, sf_dir).withColumn("session_key", F.nullif("session_key", F.lit(5)))
    manifest = landing.land(records, records.select(*ops.SLICE_KEYS).distinct(), root)
    return root, manifest


def landing_manifest(spark, sf_dir):
    """Slices of the feed plus, per type, an empty slice (day 0) and a failed one (day 13)."""
    records = _records(spark, sf_dir)
    keys = records.select(*ops.SLICE_KEYS).distinct()
    empty = records.select("endpoint", "year", F.lit(0).cast("bigint").alias("session_key")).distinct()
    failures = keys.where("session_key = 13").withColumn("error_message", F.lit("timeout"))
    root = scratch_path(spark, "landed")
    manifest = landing.land(records, keys.unionByName(empty), root, failures)
    return manifest.select(*ops.SLICE_KEYS, "record_count", "status", "error_message")


def landed_matches_manifest(spark, sf_dir):
    """What was landed, reconciled with the files really written."""
    root, manifest = _land(spark, sf_dir)
    on_disk = files.rows_per_slice(files.rows_per_file(spark, root))
    return ops.reconcile(manifest, on_disk, (), TYPES).select(
        *ops.SLICE_KEYS, "manifest_record_count", "file_row_count", "reconciliation_status")


def land_twice(spark, sf_dir):
    """A first run lands the days up to 20, a second one lands day 20 again and the days after it."""
    root = scratch_path(spark, "landed")
    records = _records(spark, sf_dir)
    for part in (records.where("session_key <= 20").withColumn("value", F.lit(-1.0)), records.where("session_key >= 20")):
        landing.land(part, part.select(*ops.SLICE_KEYS).distinct(), root)
    found = files.json_scan(spark, root, EVENT_DDL + ", session_key bigint")
    return found.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value") == -1).alias("first_run"), F.sum("event_id").alias("ids"))


def land_then_clean(spark, sf_dir):
    """Events landed as position records, read back as bronze and cleaned."""
    root = scratch_path(spark, "landed")
    records = table(spark, sf_dir, "events").select(
        F.lit("position").alias("endpoint"), F.year("ts").cast("bigint").alias("year"), F.day("ts").cast("bigint").alias("session_key"),
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("driver_number"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"), F.lit(1).cast("bigint").alias("meeting_key"),
        (F.col("event_id") % 23 - 1).alias("position"))
    landing.land(records, records.select(*ops.SLICE_KEYS).distinct(), root)
    bronze = jobs.read_bronze(spark, root)
    cleaned = clean(bronze["position"], race.SPECS["position"])
    counts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows")) for n, df in bronze.items() if n != "position"]
    kept = cleaned.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("driver_number").alias("drivers"), F.min("position").alias("least"))
    empty = reduce(lambda a, b: a.unionByName(b), counts).agg(F.sum("rows").alias("others"))
    return kept.withColumn("others", empty.scalar())


def file_inventory(spark, sf_dir):
    root, _ = _land(spark, sf_dir)
    inventory = files.file_inventory(spark, root)
    return inventory.groupBy(*ops.SLICE_KEYS).agg(
        (F.sum("file_size_bytes") > 0).alias("has_bytes"), (F.count("modified_utc") > 0).alias("has_time"))


def rows_per_file(spark, sf_dir):
    root, _ = _land(spark, sf_dir)
    return files.rows_per_slice(files.rows_per_file(spark, root)).select(*ops.SLICE_KEYS, "row_count")


def path_metadata(spark, sf_dir):
    """Slice keys parsed back from paths of both layouts and from a path without a year."""
    ev = table(spark, sf_dir, "events")
    day = F.day("ts").cast("string")
    path = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("/lake/view/year=2024/session_key="), day, F.lit(".jsonl")))
        .when(F.col("event_type") == "click", F.concat(F.lit("s3://b/endpoint=click/year=2023/session_key="), day, F.lit("/part-0.json")))
        .when(F.col("event_type") == "error", F.lit("/lake/error/year=2022/error.jsonl"))
        .otherwise(F.concat(F.lit("/lake/"), F.col("event_type"), F.lit("/all.jsonl")))
    )
    return files.path_metadata(ev.select("event_id", path.alias("file_path"))).drop("file_path")


def json_scan(spark, sf_dir):
    root, _ = _land(spark, sf_dir)
    return files.json_scan(spark, root, EVENT_DDL)


def strict_json_scan(spark, sf_dir):
    root, _ = _land(spark, sf_dir)
    return files.json_scan_strict(spark, root, EVENT_DDL).select("event_id", "value")


def malformed_lines(spark, sf_dir):
    """Lines cut short by the sender, found in one file per event type."""
    ev = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct("event_id", "value"))
    line = F.when(F.col("value") > 20, F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))).otherwise(whole)
    root = scratch_path(spark, "lines")
    ev.select("event_type", line.alias("value")).write.partitionBy("event_type").text(root)
    return files.malformed_lines(spark, root).select("value")


def provenance_columns(spark, sf_dir):
    root, _ = _land(spark, sf_dir)
    scanned = files.with_provenance(files.json_scan(spark, root, EVENT_DDL))
    return scanned.select("event_id", "source_endpoint", "source_year", "source_session_key")


def roundtrip_sinks(spark, sf_dir):
    """Rows and sums after writing and reading Parquet, CSV, JSON and an empty table."""
    root = scratch_path(spark, "sinks")
    orders = table(spark, sf_dir, "orders")
    files.parquet_sink(orders, f"{root}/orders.parquet")
    report = ops.rollup(_reconciled(spark, sf_dir))
    files.csv_sink(report, f"{root}/report.csv")
    files.empty_table_sink(spark, "a bigint, b string", f"{root}/empty.parquet")
    files.jsonl_sink(_records(spark, sf_dir), f"{root}/events")
    read = [
        ("parquet", files.parquet_optional(spark, f"{root}/orders.parquet"), F.sum("o_orderkey")),
        ("csv", files.csv_source(spark, f"{root}/report.csv", report.schema), F.sum("count")),
        ("empty", files.parquet_optional(spark, f"{root}/empty.parquet"), F.sum("a")),
        ("absent", files.parquet_optional(spark, f"{root}/none.parquet", "a bigint"), F.sum("a")),
        ("json", files.json_scan(spark, f"{root}/events", EVENT_DDL), F.sum("event_id")),
    ]
    out = None
    for name, df, total in read:
        part = df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(total, F.lit(0)).alias("total")).select(
            F.lit(name).alias("sink"), "row_count", "total")
        out = part if out is None else out.unionByName(part)
    return out


def sorted_report_files(spark, sf_dir):
    """A report written in order over several files, and its rows in the order of the files."""
    path = f"{scratch_path(spark, 'sorted')}/report.csv"
    lines = table(spark, sf_dir, "lineitem")
    report = lines.groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_linenumber").alias("numbers"))
    files.csv_sink(report, path, ["l_returnflag", "l_suppkey"], rows_per_file=50)
    return files.in_file_order(files.csv_source(spark, path, report.schema))


def endpoint_row_counts(spark, sf_dir):
    return ops.rows_by_endpoint(_frame(spark, sf_dir, "files"))


def first_sessions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("session_key"), F.year("o_orderdate").alias("year"))
    return ops.first_sessions(orders, 25)


# --- checks -----------------------------------------------------------------------------------

RECONCILED_SQL = f"""
{SLICES_SQL},
m as (select * from (select *, row_number() over (partition by endpoint, year, session_key
        order by case when status = 'success' then 0 else 1 end, ingestion_timestamp_utc desc) as nth
      from manifest) where nth = 1),
f as (select * from (select *, row_number() over (partition by endpoint, year, session_key
        order by row_count desc, file_path) as nth from files) where nth = 1),
j as (
  select coalesce(m.endpoint, f.endpoint) as endpoint, coalesce(m.year, f.year) as year,
         coalesce(m.session_key, f.session_key) as session_key, m.status as manifest_status,
         cast(m.record_count as bigint) as manifest_record_count, m.output_path as manifest_output_path,
         f.file_path is not null as file_exists, f.file_path, f.row_count as file_row_count,
         cast(f.row_count - m.record_count as bigint) as row_count_delta
  from m full outer join f on m.endpoint = f.endpoint and m.year = f.year
    and m.session_key is not distinct from f.session_key
),
reconciled as (
  select *,
    case when file_exists and manifest_status = 'success' and manifest_record_count = file_row_count then 'matched'
         when file_exists and manifest_status = 'success' then 'row_count_mismatch'
         when file_exists and manifest_status is not null then 'failed_manifest_file_exists'
         when file_exists then 'stale_file_not_in_success_manifest'
         when manifest_status = 'success' then 'manifest_success_missing_file'
         when endpoint = 'signup' then 'optional_missing'
         else 'manifest_failed_no_file' end as reconciliation_status,
    case when file_exists and manifest_status = 'success' and manifest_record_count = file_row_count then 'none'
         when file_exists and manifest_status = 'success' then 'row_mismatch'
         when file_exists and manifest_status is not null then 'failed_but_file_present'
         when file_exists then 'stale_file'
         when manifest_status = 'success' then 'missing_file'
         when endpoint = 'signup' then 'optional_endpoint'
         else 'manifest_only' end as issue_type,
    'scope=' || case when endpoint = 'signup' then 'optional' when endpoint = 'view' then 'global' else 'session' end
      || ' manifest=' || coalesce(manifest_status, 'none') || ' promised=' || coalesce(cast(manifest_record_count as varchar), 'none')
      || ' found=' || coalesce(cast(file_row_count as varchar), 'none') as notes
  from j
)
"""
EFFECTIVE_SQL = """
effective as (
  select *, 'original' as manifest_source from manifest m where not exists (
    select 1 from retries r where r.endpoint = m.endpoint and r.session_key = m.session_key)
  union all select *, 'retry' from retries
)"""
TOTALS_SQL = " union all ".join(
    f"select 'totals' as scope, '{name}' as key, '' as endpoint, "
    f"count(*) filter (where reconciliation_status = '{status}') as count from reconciled"
    for name, status in {
        "matched": "matched", "stale_files": "stale_file_not_in_success_manifest",
        "missing_files": "manifest_success_missing_file", "row_mismatches": "row_count_mismatch",
        "failed_but_file_present": "failed_manifest_file_exists", "optional_missing": "optional_missing",
        "manifest_failed_no_file": "manifest_failed_no_file", "unknown": "unknown"}.items()
)
ROLLUP_SQL = f"""
  select 'by_status' as scope, reconciliation_status as key, '' as endpoint, count(*) as count
  from reconciled group by 2
  union all select 'by_endpoint', reconciliation_status, endpoint, count(*) from reconciled group by 2, 3
  union all select 'by_issue_type', issue_type, '', count(*) from reconciled group by 2
  union all {TOTALS_SQL}
  union all select 'totals', 'total_rows_reconciled', '', count(*) from reconciled"""
BLOCKING = (
    "stale_file_not_in_success_manifest", "failed_manifest_file_exists", "row_count_mismatch",
    "manifest_success_missing_file",
)
SLICE_COUNTS = """
    select event_type as endpoint, cast(year(ts) as bigint) as year, cast(nullif(day(ts), 5) as bigint) as session_key,
           count(*) as {name} from events group by 1, 2, 3"""
ALL_DAYS = SLICE_COUNTS.replace("nullif(day(ts), 5)", "day(ts)")
SCHEMA_SQL = """
lines as (
  select o_orderstatus as endpoint, year(o_orderdate) as f, o_orderkey, o_orderpriority,
         case when year(o_orderdate) > 1996 then o_custkey end as o_custkey,
         case when o_totalprice > 250000 then true end as large
  from orders
),
cells as (
  select endpoint, f, 'o_orderkey' as column_name, 'BIGINT' as kind from lines
  union all select endpoint, f, 'o_orderpriority', 'STRING' from lines
  union all select endpoint, f, 'o_custkey', 'BIGINT' from lines where o_custkey is not null
  union all select endpoint, f, 'large', 'BOOLEAN' from lines where large is not null
),
report as (
  select c.endpoint, column_name, max(kind) as observed_types, count(distinct f) as files_seen,
         count(*) as non_null_count, max(t.n) as rows_sampled
  from cells c join (select endpoint, count(*) as n from lines group by endpoint) t on c.endpoint = t.endpoint
  group by c.endpoint, column_name
),
drift as (
  select endpoint, column_name, files_seen, max(files_seen) over (partition by endpoint) as max_files_seen,
         round(files_seen * 100.0::double / max(files_seen) over (partition by endpoint), 2) as file_coverage_pct,
         files_seen < max(files_seen) over (partition by endpoint) as possible_schema_drift_flag
  from report
)"""

BRONZE_CHECKS = (
    "row_counts_by_endpoint", "total_rows", "endpoint_coverage", "reconciliation_by_status",
    "reconciliation_by_endpoint", "reconciliation_issues",
)

QUERIES = {
    "sorted_report_files": sorted_report_files,
    "latest_preferred": latest_preferred,
    "largest_per_key": largest_per_key,
    "reconcile": reconcile,
    "reconcile_rollup": reconcile_rollup,
    "layer_gate": layer_gate,
    "overlay_upsert": overlay_upsert,
    "retry_plan": retry_plan,
    "manifest_summary": manifest_summary,
    "manifest_totals": manifest_totals,
    "retry_summary": retry_summary,
    "retry_status_pivot": retry_status_pivot,
    "coverage_check": coverage_check,
    "schema_profile": schema_profile,
    "schema_drift": schema_drift,
    "check_schema_drift_flags": schema_drift_flags,
    **{f"check_{n}": _bronze_query(n) for n in BRONZE_CHECKS},
    "landing_manifest": landing_manifest,
    "landed_matches_manifest": landed_matches_manifest,
    "file_inventory": file_inventory,
    "rows_per_file": rows_per_file,
    "path_metadata": path_metadata,
    "land_twice": land_twice,
    "land_then_clean": land_then_clean,
    "json_scan": json_scan,
    "strict_json_scan": strict_json_scan,
    "malformed_lines": malformed_lines,
    "provenance_columns": provenance_columns,
    "roundtrip_sinks": roundtrip_sinks,
    "endpoint_row_counts": endpoint_row_counts,
    "first_sessions": first_sessions,
}

ORACLES = {
    "sorted_report_files": "select *, row_number() over (order by l_returnflag, l_suppkey) as row_no from ("
    "select l_suppkey, l_returnflag, count(*) as line_count, cast(sum(l_linenumber) as bigint) as numbers "
    "from lineitem group by all)",
    "latest_preferred": f"with {RECONCILED_SQL} select * exclude (nth) replace (cast(record_count as bigint) as record_count) from m",
    "largest_per_key": f"with {RECONCILED_SQL} select * exclude (nth) from f",
    "reconcile": f"with {RECONCILED_SQL} select * from reconciled",
    "reconcile_rollup": f"with {RECONCILED_SQL} {ROLLUP_SQL}",
    "layer_gate": f"with {RECONCILED_SQL} select " + ", ".join(
        f"count(*) filter (where reconciliation_status = '{s}') as {s}" for s in BLOCKING)
        + f", count(*) filter (where reconciliation_status in {BLOCKING}) as blocking_rows, "
        f"count(*) filter (where reconciliation_status in {BLOCKING}) = 0 as gate_open from reconciled",
    "overlay_upsert": f"with {SLICES_SQL}, {EFFECTIVE_SQL} select * replace (cast(record_count as bigint) as record_count) from effective",
    "retry_plan": f"""
        with {SLICES_SQL} select endpoint, year, session_key, status as previous_status,
               error_message as previous_error_message, cast(1 as bigint) as retry_attempt
        from (select *, row_number() over (partition by endpoint, session_key
                order by ingestion_timestamp_utc desc) as nth
              from manifest where status = 'failed' and session_key is not null and endpoint <> 'signup')
        where nth = 1""",
    "manifest_summary": f"""
        with {SLICES_SQL} select endpoint, status, count(*) as slices, cast(sum(record_count) as bigint) as total_rows
        from manifest group by 1, 2""",
    "manifest_totals": f"""
        with {SLICES_SQL} select count(*) filter (where status = 'success') as success_count,
          count(*) filter (where status = 'failed') as failed_count,
          string_agg(distinct endpoint, ';' order by endpoint) filter (where status = 'success') as success_endpoints,
          string_agg(distinct endpoint, ';' order by endpoint) filter (where status = 'failed') as failed_endpoints,
          cast(sum(record_count) filter (where status = 'success' and endpoint = 'click') as bigint) as click_total_rows,
          cast(sum(record_count) filter (where status = 'success' and endpoint = 'view') as bigint) as view_total_rows
        from manifest""",
    "retry_summary": f"""
        with {SLICES_SQL} select endpoint, count(*) as retry_attempts,
          count(*) filter (where status = 'success') as newly_successful,
          count(*) filter (where status = 'failed') as still_failed from retries group by 1""",
    "retry_status_pivot": f"""
        with {SLICES_SQL} select endpoint, count(*) filter (where status = 'failed') as failed,
          count(*) filter (where status = 'success') as success from retries group by 1""",
    "coverage_check": f"""
        with {SLICES_SQL}, {EFFECTIVE_SQL}
        select endpoint, count(*) filter (where s = 'o') as original_success,
               count(*) filter (where s = 'r') as retry_success, count(*) filter (where s = 'e') as effective_success,
               count(*) filter (where s = 'f') as files_on_disk
        from (select endpoint, 'o' as s from manifest where status = 'success'
              union all select endpoint, 'r' from retries where status = 'success'
              union all select endpoint, 'e' from effective where status = 'success'
              union all select endpoint, 'f' from files) group by 1""",
    "schema_profile": f"with {SCHEMA_SQL} select * from report",
    "schema_drift": f"with {SCHEMA_SQL} select * from drift",
    "check_schema_drift_flags": f"with {SCHEMA_SQL} select * from drift where possible_schema_drift_flag",
    "check_row_counts_by_endpoint": f"""
        with {SLICES_SQL} select endpoint, cast(sum(row_count) as bigint) as total_rows, count(*) as file_count
        from files group by 1""",
    "check_total_rows": f"with {SLICES_SQL} select cast(sum(row_count) as bigint) as total_rows, count(*) as total_files from files",
    "check_endpoint_coverage": f"""
        with {SLICES_SQL} select endpoint, count(*) as file_count, cast(sum(file_size_bytes) as bigint) as total_bytes
        from files group by 1""",
    "check_reconciliation_by_status": f"with {RECONCILED_SQL} select reconciliation_status, count(*) as count from reconciled group by 1",
    "check_reconciliation_by_endpoint": f"with {RECONCILED_SQL} select endpoint, reconciliation_status, count(*) as count from reconciled group by 1, 2",
    "check_reconciliation_issues": f"with {RECONCILED_SQL} select * from reconciled where reconciliation_status not in ('matched', 'optional_missing')",
    "landing_manifest": f"""
        with s as ({ALL_DAYS.format(name='n')})
        select endpoint, year, session_key, case when session_key = 13 then 0 else n end as record_count,
               case when session_key = 13 then 'failed' else 'success' end as status,
               case when session_key = 13 then 'timeout' else '' end as error_message from s
        union all select distinct endpoint, year, cast(0 as bigint), cast(0 as bigint), 'success', '' from s""",
    "landed_matches_manifest": f"""
        with s as ({SLICE_COUNTS.format(name='n')})
        select endpoint, year, session_key, n as manifest_record_count, n as file_row_count,
               'matched' as reconciliation_status from s""",
    "file_inventory": f"""
        with s as ({SLICE_COUNTS.format(name='n')})
        select endpoint, year, session_key, true as has_bytes, true as has_time from s""",
    "rows_per_file": SLICE_COUNTS.format(name="row_count"),
    "path_metadata": """
        select event_id, event_type as endpoint,
               case event_type when 'view' then cast(2024 as bigint) when 'click' then 2023 when 'error' then 2022 end as year,
               case when event_type in ('view', 'click') then cast(day(ts) as bigint) end as session_key
        from events""",
    "land_twice": """
  select cast(day(ts) as bigint) as session_key, count(*) as rows, count(*) filter (where day(ts) < 20) as first_run,
         cast(sum(event_id) as bigint) as ids from events group by 1""",
    "land_then_clean": """
  with k as (
    select distinct cast(day(ts) as bigint) as session_key, user_id, date_trunc('second', ts) as at,
           min(event_id % 23 - 1) over (partition by day(ts), user_id, date_trunc('second', ts)) as position
    from events where user_id % 7 <> 0 and event_id % 23 - 1 > 0)
  select session_key, count(*) as rows, cast(sum(user_id) as bigint) as drivers, min(position) as least, cast(0 as bigint) as others
  from k group by 1""",
    "json_scan": """
        select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, user_id, event_type, value, props from events""",
    "strict_json_scan": "select event_id, value from events",
    "malformed_lines": """select '{"event_id":' || event_id as value from events where value > 20""",
    "provenance_columns": """
        select event_id, event_type as source_endpoint, cast(year(ts) as bigint) as source_year,
               cast(nullif(day(ts), 5) as bigint) as source_session_key from events""",
    "roundtrip_sinks": f"""
        with {RECONCILED_SQL}
        select 'parquet' as sink, count(*) as row_count, cast(sum(o_orderkey) as bigint) as total from orders
        union all select 'csv', count(*), cast(sum(count) as bigint) from ({ROLLUP_SQL})
        union all select 'empty', 0, 0 union all select 'absent', 0, 0
        union all select 'json', count(*), cast(sum(event_id) as bigint) from events""",
    "endpoint_row_counts": f"""
        with {SLICES_SQL} select endpoint, cast(sum(row_count) as bigint) as total_rows, count(*) as file_count
        from files group by 1""",
    "first_sessions": """
        select o_orderkey as session_key, cast(year(o_orderdate) as integer) as year from orders
        order by year, session_key limit 25""",
}
