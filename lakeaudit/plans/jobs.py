"""The layer jobs a user calls, composed from the operators for the race feed.

Every job returns its frames by name and writes them where a folder is given. Tables are read with
their declared schemas, written once, and audited from what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.functions.durable import durable
from lakeaudit.operators import (
    audit, checks, clean as cleaning, evaluate, features as feat, govern, model, profile,
    reconcile as recon, report, split,
)
from lakeaudit.plans import race
from lakeaudit.sources import files, publish

MART_NAME = "driver_race_feature_mart"

#: By which columns the files of a report are sorted.
REPORT_ORDER = {
    "bronze_row_counts": ["endpoint", "file_path"],
    "bronze_schema_report": ["endpoint", "column_name"],
    "bronze_schema_drift_report": ["endpoint", "column_name"],
    "bronze_manifest_file_reconciliation": ["endpoint", "year", "session_key"],
    "silver_cleaning_rules": ["table_name", "rule_id"],
    "silver_missingness_before": ["table_name", "column_name"],
    "silver_missingness_after": ["table_name", "column_name"],
    "silver_cleaning_impact_summary": ["table_name"],
    "gold_feature_missingness": ["column_name"],
    "feature_dictionary": ["feature_name"],
}


def _save(frames: dict[str, DataFrame], folder: str | None) -> dict[str, DataFrame]:
    if folder:
        for name, df in frames.items():
            files.csv_sink(df, f"{folder.rstrip('/')}/{name}.csv", REPORT_ORDER.get(name))
    return frames


# --- bronze -----------------------------------------------------------------------------------

def landed_lines(spark: SparkSession, root: str) -> DataFrame:
    """All landed lines with endpoint and file."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files.LINE_FILES).text(root)
    path = F.col("_metadata.file_path")
    return lines.select("value", path.alias("file_path"), files.path_endpoint(path).alias("endpoint"))


def bronze_reports(spark: SparkSession, root: str, reports: str | None = None) -> dict[str, DataFrame]:
    """Inventory, rows per file, schema profile and drift: one scan for counts, one for the schema."""
    row_counts = files.rows_per_file(spark, root)
    schema = files.schema_profile(landed_lines(spark, root))
    return _save({
        "bronze_file_inventory": files.file_inventory(spark, root), "bronze_row_counts": row_counts,
        "bronze_schema_report": schema, "bronze_schema_drift_report": recon.schema_drift(schema),
    }, reports)


def reconcile_reports(
    manifest: DataFrame, row_counts: DataFrame, retries: DataFrame | None = None, reports: str | None = None
) -> dict[str, DataFrame]:
    """Manifest (with retries laid over it) against the files; both reports."""
    effective = recon.overlay(manifest, retries) if retries is not None else manifest
    reconciled = recon.reconcile(effective, files.rows_per_slice(row_counts))
    return _save({
        "bronze_manifest_file_reconciliation": reconciled,
        "bronze_manifest_file_reconciliation_summary": recon.rollup(reconciled),
    }, reports)


# --- silver -----------------------------------------------------------------------------------

def read_bronze(spark: SparkSession, root: str, infer: bool = False) -> dict[str, DataFrame]:
    """One frame per table; a table without files is empty with its declared columns."""
    out = {}
    for name in race.TABLE_ORDER:
        schema = None if infer else race.RAW_DDL[name]
        if files.folder_exists(spark, files.endpoint_folder(spark, root, name)):
            out[name] = files.endpoint_scan(spark, root, name, schema)
        else:
            out[name] = spark.createDataFrame([], race.RAW_DDL[name] + ", source_file string")
    return out


def silver_job(
    spark: SparkSession, bronze: str, silver: str, reports: str | None = None,
    reconciled: DataFrame | None = None, judge: Callable[[dict[str, DataFrame]], list[str]] | None = None,
) -> dict[str, DataFrame]:
    """Cleans and writes the ten tables as a new version, audits them before and after, and publishes.

    With ``reconciled`` (the manifest laid against the files) nothing is built while slices block. The
    JSON is parsed once, into Parquet below ``_staged`` of the version; the cleaning and every audit of
    the raw rows read that. ``judge`` names what is wrong with the reports (``silver_faults`` unless
    given); with any fault the version is not published and the current one stays.
    """
    if reconciled is not None:
        recon.assert_gate(reconciled)
    version = publish.new_version(spark, silver)
    root = publish.version_folder(silver, version)
    before, after = {}, {}
    for name, df in read_bronze(spark, bronze).items():
        files.parquet_sink(df, f"{root}/_staged/{name}.parquet")
        before[name] = spark.read.parquet(f"{root}/_staged/{name}.parquet")
    if all(df.isEmpty() for df in before.values()):
        raise FileNotFoundError(f"no landed rows below {bronze}")
    for name, df in before.items():
        path = f"{root}/{name}_clean.parquet"
        files.parquet_sink(cleaning.clean(df, race.SPECS[name]), path)
        after[name] = spark.read.parquet(path)
    frames = silver_reports(before, after)
    faults = (judge or silver_faults)(frames)
    _save(frames, reports)
    if faults:
        raise ValueError(f"version {version} of {silver} is not published: {'; '.join(faults)}")
    publish.publish(spark, silver, version)
    return frames


def silver_faults(frames: dict[str, DataFrame]) -> list[str]:
    """What must not be published: natural keys that repeat though they were made unique, and tables emptied."""
    unique = [n for n, s in race.SPECS.items() if s.dedupe_keys and set(s.dedupe_keys) <= set(race.NATURAL_KEYS[n])]
    repeated = frames["silver_duplicate_report"].where(
        "stage = 'after' and duplicate_type = 'key_duplicate' and duplicate_key_count > 0").where(F.col("table_name").isin(unique))
    emptied = frames["silver_cleaning_impact_summary"].where("rows_before > 0 and rows_after = 0")
    # a row per table at most
    return [f"{r['table_name']}: repeated keys" for r in repeated.collect()] + [
        f"{r['table_name']}: no row left" for r in emptied.collect()]


def silver_reports(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every audit of the cleaning; the log and the profiles are stored once, the rest is lazy."""
    raw = {n: df.drop("source_file") for n, df in before.items()}
    kept = {n: df.drop("source_file") for n, df in after.items()}

    def each(fn, tables: dict[str, DataFrame]) -> DataFrame:
        return audit.union_reports([fn(df, n) for n, df in tables.items()])

    def staged(fn) -> DataFrame:
        return fn(raw, "before").unionByName(fn(kept, "after"), allowMissingColumns=True)

    # a row per rule or table, each read by two reports: stored once
    log = durable(audit.union_reports([cleaning.cleaning_log(df, race.SPECS[n]) for n, df in before.items()]))
    before_profiles = durable(each(profile.table_profile, raw))
    after_profiles = durable(each(profile.table_profile, kept))
    return {
        "silver_cleaning_rules": log,
        "silver_rejected_records_summary": cleaning.rejected_records(log, list(before)),
        "silver_missingness_before": each(profile.missingness, raw),
        "silver_missingness_after": each(profile.missingness, kept),
        "silver_table_inventory": after_profiles,
        "silver_cleaning_impact_summary": profile.cleaning_impact(before_profiles, after_profiles),
        "silver_duplicate_report": staged(lambda t, s: audit.duplicate_report(t, race.NATURAL_KEYS, s)),
        "silver_outlier_report": staged(
            lambda t, s: audit.outlier_report(t, race.IQR_COLUMNS, race.DOMAIN_RULES, s)),
        "silver_temporal_anomaly_report": staged(temporal_report),
        "silver_referential_integrity_report": staged(
            lambda t, s: audit.fk_suite(t, race.FOREIGN_KEYS, s)),
    }


def temporal_report(tables: dict[str, DataFrame], stage: str) -> DataFrame:
    parts = []
    for name, df in tables.items():
        rows = audit.row_time_checks(
            df, name, ("date_start", "date_end") if name == "sessions" else None,
            "lap_number" if name == "pit" else None)
        if rows is not None:
            parts.append(rows)
    keys = ["session_key", "driver_number"]
    laps = tables.get("laps")
    if laps is not None and {*keys, "lap_number"} <= set(laps.columns):
        time = next((c for c in ("date_start", "date") if c in laps.columns), None)
        parts.append(audit.lag_decrease(laps, "laps", keys, "lap_number", time))
    weather, sessions = tables.get("weather"), tables.get("sessions")
    if weather is not None and sessions is not None and "date" in weather.columns:
        typed = cleaning.cast_columns(weather, {"date": "timestamp"})
        periods = cleaning.cast_columns(sessions, {"date_start": "timestamp", "date_end": "timestamp"})
        parts.append(audit.outside_bounds(
            typed, periods, "weather", "session_key", "date", "date_start", "date_end",
            "Informational: samples are also taken just outside a session"))
    return audit.union_reports(parts).withColumn("stage", F.lit(stage))


# --- gold -------------------------------------------------------------------------------------

def read_silver(spark: SparkSession, silver: str) -> dict[str, DataFrame]:
    """The cleaned tables that exist, all of the current version."""
    root = publish.current_folder(spark, silver)
    found = {n: files.parquet_optional(spark, f"{root}/{n}_clean.parquet") for n in race.TABLE_ORDER}
    return {n: df for n, df in found.items() if df is not None}


def gold_job(
    spark: SparkSession, silver: str, gold: str, reports: str | None = None
) -> dict[str, DataFrame]:
    """Builds and writes the mart in one plan, checks its grain, and reports on what was written."""
    tables = read_silver(spark, silver)
    if "session_result" not in tables or tables["session_result"].isEmpty():
        raise ValueError("the mart needs a filled session_result table")
    wrong = govern.non_integral_keys(tables, {n: race.GRAIN for n in tables})
    if wrong:
        raise TypeError(f"join keys must be whole numbers: {wrong}")
    mart, groups = race.build_mart(tables)
    path = f"{gold.rstrip('/')}/{MART_NAME}.parquet"
    files.parquet_sink(mart, path)
    written = spark.read.parquet(path)
    feat.assert_unique_grain(written, race.GRAIN)
    frames = {"mart": written}
    frames.update(_save(gold_reports(written, groups), reports))
    govern.assert_no_leakage(frames["feature_dictionary"], race.CATALOG)
    return frames


def gold_reports(mart: DataFrame, groups: list) -> dict[str, DataFrame]:
    keys = mart.select(*race.GRAIN)
    return {
        "gold_feature_summary_stats": profile.numeric_summary(mart, "gold"),
        "gold_feature_missingness": profile.missingness(mart, "gold"),
        "gold_target_distribution": feat.target_distribution(mart),
        "gold_join_quality_report": audit.union_reports([
            feat.join_quality(keys, features, race.GRAIN, name, on) for name, features, on in groups]),
        "gold_leakage_guard_report": govern.leakage_guard(mart, race.CATALOG),
        "feature_dictionary": govern.feature_dictionary(mart, race.CATALOG),
        "model_feature_plan": govern.feature_plan(mart.sparkSession, race.CATALOG),
    }


# --- checks, models, reports ------------------------------------------------------------------

def validate_job(
    spark: SparkSession, bronze_frames: dict[str, DataFrame] | None = None, silver: str | None = None,
    mart: DataFrame | None = None, reports: str | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """The SQL cross-checks of whichever layers are given."""
    out: dict[str, dict[str, DataFrame]] = {}
    if bronze_frames:
        out["bronze"] = checks.bronze_checks(
            bronze_frames["bronze_row_counts"], bronze_frames.get("bronze_schema_drift_report"),
            bronze_frames.get("bronze_file_inventory"),
            bronze_frames.get("bronze_manifest_file_reconciliation"))
    if silver:
        tables = read_silver(spark, silver)
        out["silver"] = checks.silver_checks({n: tables.get(n) for n in race.TABLE_ORDER})
    if mart is not None:
        out["gold"] = checks.gold_checks(mart)
    if reports:
        for layer, frames in out.items():
            checks.save_reports(frames, reports, layer)
    return out


def model_job(
    mart: DataFrame, mode: str = "full", features: list[str] | None = None, seed: int = 42,
    seasons: dict[str, list[int]] | None = None, only: list[str] | None = None,
    overrides: dict | None = None, folder: str | None = None,
) -> dict[str, DataFrame]:
    """Splits, baselines, three models and their metrics, confusion, errors and importances."""
    spark, catalog, target = mart.sparkSession, race.CATALOG, race.CATALOG.target
    features = features or govern.resolve_features(catalog, govern.feature_plan(spark, catalog))
    features = [f for f in features if f in mart.columns]
    parts, method = split.resolve_splits(
        mart, mode, "session_year", seasons or race.SEASONS, race.GRAIN)
    rows = parts.withColumn("y_true", F.col(target).cast("int"))
    context = [c for c in (*race.GRAIN, "team_name", "circuit_short_name", "session_year",
                           "first_observed_position") if c in mart.columns]
    held_out = rows.where("split <> 'train'")
    base = evaluate.stack_predictions(
        held_out, evaluate.baselines(rows, race.GRAIN), ["split", "y_true", *context])
    scored, importances, _ = model.train_all(rows, features, target, context, seed, only, overrides)
    predictions = durable(base.unionByName(scored))  # read by metrics, confusion and errors
    metrics = evaluate.class_metrics(predictions)
    is_base = F.col("model_name").isin(*evaluate.BASELINES)
    errors = evaluate.error_analysis(predictions)
    frames = {
        "split_summary": split.split_summary(parts, "session_year", target),
        "baseline_metrics": metrics.where(is_base),
        "validation_metrics": metrics.where(~is_base & (F.col("split") == "validation")),
        "test_metrics": metrics.where(~is_base & (F.col("split") == "test")),
        "confusion_matrix": evaluate.confusion_long(predictions),
        "error_analysis": errors,
        "feature_importance": importances,
    }
    if folder:
        _save(frames, folder)
        files.run_manifest_sink(spark, f"{folder.rstrip('/')}/model_run_manifest.json", {
            "mode": mode, **method, "seed": seed, "target": target, "features": features})
    return {**frames, "predictions": predictions}


def report_job(frames: dict[str, DataFrame], folder: str | None = None) -> dict[str, DataFrame]:
    tables = report.report_tables(frames)
    if folder:
        report.write_report_tables(tables, folder)
    return {**tables, **report.figure_data(frames)}
