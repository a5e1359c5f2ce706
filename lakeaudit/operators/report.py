"""Tables and figure data that close a run, built from the frames of the earlier steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.operators.evaluate import error_summary
from lakeaudit.operators.audit import error_taxonomy
from lakeaudit.operators.govern import feature_group_summary
from lakeaudit.operators.model import top_importances
from lakeaudit.operators.profile import missingness_before_after, top_missing
from lakeaudit.operators.reconcile import rows_by_endpoint, volume_by_layer
from lakeaudit.sources.files import csv_sink


def validation_test_metrics(validation: DataFrame, test: DataFrame) -> DataFrame:
    parts = []
    for split, df in (("validation", validation), ("test", test)):
        parts.append(df if "split" in df.columns else df.withColumn("split", F.lit(split)))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def metric_by_model(metrics: DataFrame, metric: str = "f1") -> DataFrame:
    """One row per model, one column per split."""
    return metrics.groupBy("model_name").pivot("split", ["validation", "test"]).agg(F.max(metric))


def confusion_grid(confusion: DataFrame, model: str, split: str) -> DataFrame:
    """2 x 2 counts of one run: a row per actual class, a column per predicted class."""
    one = confusion.where((F.col("model_name") == model) & (F.col("split") == split))
    grid = one.groupBy("actual").pivot("predicted", [0, 1]).agg(F.sum("count"))
    return grid.select("actual", F.col("0").alias("predicted_0"), F.col("1").alias("predicted_1"))


def report_tables(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The report tables whose inputs are present.

    Inputs by name: row_counts, silver_volume (entity, row_count), gold_volume, cleaning_impact,
    audit reports duplicate/outlier/temporal/referential_integrity, feature_dictionary,
    target_distribution, baseline_metrics, validation_metrics, test_metrics, confusion,
    error_analysis.
    """
    out: dict[str, DataFrame] = {}
    layers = {}
    if "row_counts" in frames:
        counts = frames["row_counts"]
        layers["bronze"] = counts.select(F.col("endpoint").alias("entity"), "row_count")
        out["bronze_endpoint_row_counts"] = rows_by_endpoint(counts)
    for layer in ("silver", "gold"):
        if f"{layer}_volume" in frames:
            layers[layer] = frames[f"{layer}_volume"]
    if layers:
        out["data_volume_by_layer"] = volume_by_layer(layers)
    audits = {k: frames[k] for k in ("duplicate", "outlier", "temporal", "referential_integrity") if k in frames}
    if audits:
        out["silver_error_taxonomy"] = error_taxonomy(audits)
    if "feature_dictionary" in frames:
        out["gold_feature_group_summary"] = feature_group_summary(frames["feature_dictionary"])
    for source, name in (
        ("cleaning_impact", "silver_cleaning_impact"), ("target_distribution", "gold_target_distribution"),
        ("baseline_metrics", "model_baseline_comparison"), ("confusion", "confusion_matrix"),
    ):
        if source in frames:
            out[name] = frames[source]
    if "validation_metrics" in frames and "test_metrics" in frames:
        out["model_validation_test_metrics"] = validation_test_metrics(
            frames["validation_metrics"], frames["test_metrics"])
    if "error_analysis" in frames:
        out["error_analysis_summary"] = error_summary(frames["error_analysis"])
    return out


def figure_data(frames: dict[str, DataFrame], model: str = "random_forest") -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}
    if "target_distribution" in frames:
        out["target_bars"] = frames["target_distribution"]
    if "metrics" in frames:
        out["f1_by_model"] = metric_by_model(frames["metrics"])
    if "confusion" in frames:
        out["confusion_grid"] = confusion_grid(frames["confusion"], model, "test")
    if "importances" in frames:
        out["top_importances"] = top_importances(frames["importances"])
    if "missing_before" in frames and "missing_after" in frames:
        out["missing_before_after"] = missingness_before_after(frames["missing_before"], frames["missing_after"])
        out["top_missing"] = top_missing(frames["missing_after"])
    return out


def write_report_tables(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """Writes each non-empty table as CSV and returns the names written."""
    written = []
    for name, df in tables.items():
        if not df.isEmpty():
            csv_sink(df, f"{folder.rstrip('/')}/{name}.csv")
            written.append(name)
    return written
