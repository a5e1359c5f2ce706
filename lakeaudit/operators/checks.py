"""SQL cross-checks of the layers, as Spark SQL over the frames given."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeaudit.functions.columns import present, rows_frame
from lakeaudit.operators.profile import null_counts
from lakeaudit.sources.files import csv_sink


def skipped(df: DataFrame, name: str, missing: list[str]) -> DataFrame:
    return rows_frame(
        df, [(name, "skipped_missing_columns", ",".join(missing))],
        "report string, status string, missing_columns string",
    )


def guarded(df: DataFrame, name: str, needs: list[str], query: str) -> DataFrame:
    """Runs the query, or reports the columns it would need."""
    missing = [c for c in needs if c not in df.columns]
    if missing:
        return skipped(df, name, missing)
    return df.sparkSession.sql(query, t=df)


def bronze_checks(
    row_counts: DataFrame, drift: DataFrame | None = None, inventory: DataFrame | None = None,
    reconciled: DataFrame | None = None,
) -> dict[str, DataFrame]:
    sql = row_counts.sparkSession.sql
    out = {
        "row_counts_by_endpoint": sql(
            "select endpoint, sum(row_count) total_rows, count(*) file_count from {t} "
            "group by endpoint order by endpoint", t=row_counts),
        "total_rows": sql(
            "select coalesce(sum(row_count), 0) total_rows, count(*) total_files from {t}", t=row_counts),
    }
    if drift is not None:
        out["schema_drift_flags"] = guarded(
            drift, "schema_drift_flags", ["possible_schema_drift_flag"],
            "select * from {t} where possible_schema_drift_flag")
    if inventory is not None:
        out["endpoint_coverage"] = sql(
            "select endpoint, count(*) file_count, coalesce(sum(file_size_bytes), 0) total_bytes "
            "from {t} group by endpoint order by endpoint", t=inventory)
    if reconciled is not None:
        out["reconciliation_by_status"] = sql(
            "select reconciliation_status, count(*) count from {t} group by reconciliation_status "
            "order by count desc, reconciliation_status", t=reconciled)
        out["reconciliation_by_endpoint"] = sql(
            "select endpoint, reconciliation_status, count(*) count from {t} "
            "group by endpoint, reconciliation_status order by endpoint, reconciliation_status",
            t=reconciled)
        out["reconciliation_issues"] = sql(
            "select * from {t} where reconciliation_status not in ('matched', 'optional_missing') "
            "order by reconciliation_status, endpoint, year, session_key", t=reconciled)
    return out


def table_inventory(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count and status per table; an absent table is listed as missing."""
    some = next(df for df in tables.values() if df is not None)
    out = None
    for name, df in tables.items():
        if df is None:
            part = rows_frame(some, [(name, None, "missing")], "table_name string, row_count bigint, status string")
        else:
            part = df.sparkSession.sql(
                "select :name table_name, count(*) row_count, 'ok' status from {t}", args={"name": name}, t=df)
        out = part if out is None else out.unionByName(part)
    return out


def silver_checks(
    tables: dict[str, DataFrame | None], label_table: str = "session_result", points: str = "points",
    label_keys: tuple[str, ...] = ("session_key", "driver_number"),
    counted: tuple[str, ...] = ("laps", "pit", "weather"), counted_key: str = "session_key",
) -> dict[str, DataFrame]:
    out = {"table_inventory": table_inventory(tables)}
    labels = tables.get(label_table)
    if labels is not None:
        keys = ", ".join(label_keys)
        out["target_support"] = guarded(
            labels, "target_support", [points],
            f"select count(*) total_rows, count_if({points} > 0) positive_rows, "
            f"round(100.0D * count_if({points} > 0) / nullif(count(*), 0), 4) positive_pct from {{t}}")
        out["duplicate_label_keys"] = guarded(
            labels, "duplicate_label_keys", list(label_keys),
            f"select {keys}, count(*) duplicate_count from {{t}} group by {keys} having count(*) > 1")
    for name in counted:
        df = tables.get(name)
        if df is not None:
            out[f"{name}_rows_by_{counted_key}"] = rows_by_key(df, f"{name}_rows", [counted_key])
    return out


def rows_by_key(df: DataFrame, name: str, keys: list[str], limit: int = 20) -> DataFrame:
    """The most frequent keys."""
    cols = ", ".join(keys)
    return guarded(
        df, name, keys,
        f"select {cols}, count(*) row_count from {{t}} group by {cols} "
        f"order by row_count desc, {cols} limit {limit}")


def gold_checks(
    mart: DataFrame, target: str = "points_finish",
    grain: tuple[str, ...] = ("session_key", "meeting_key", "driver_number"),
    by: tuple[str, ...] = ("team_name", "circuit_short_name"),
) -> dict[str, DataFrame]:
    keys = ", ".join(grain)
    out = {
        "row_count": mart.sparkSession.sql("select count(*) row_count from {t}", t=mart),
        "duplicate_grain": guarded(
            mart, "duplicate_grain", list(grain),
            f"select {keys}, count(*) duplicate_count from {{t}} group by {keys} having count(*) > 1"),
        "target_distribution": guarded(
            mart, "target_distribution", [target],
            f"select {target}, count(*) count, "
            f"round(100.0D * count(*) / sum(count(*)) over (partition by 1), 4) pct "
            f"from {{t}} group by {target} order by {target}"),
    }
    for column in by:
        out[f"target_by_{column}"] = guarded(
            mart, f"target_by_{column}", [column, target],
            f"select {column}, {target}, count(*) count from {{t}} where {column} is not null "
            f"group by {column}, {target} order by {column}, {target}")
    out["missingness"] = null_counts(mart, "gold")
    return out


def save_reports(reports: dict[str, DataFrame], folder: str, prefix: str) -> dict[str, str]:
    paths = {}
    for name, df in reports.items():
        paths[name] = f"{folder.rstrip('/')}/check_{prefix}_{name}.csv"
        csv_sink(df, paths[name])
    return paths
