"""Landing record slices as JSON lines with an ingestion manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.sources.files import NO_SESSION, jsonl_sink
from lakeaudit.operators.reconcile import FAILED, MANIFEST_COLUMNS, SLICE_KEYS, SUCCESS


def landing_manifest(
    records: DataFrame, expected: DataFrame, root: str, failures: DataFrame | None = None,
    landed_at: str | None = None,
) -> DataFrame:
    """One row per expected slice. No records is a success with 0 rows; a failed slice is noted."""
    counts = records.groupBy(*SLICE_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    rows = _null_safe_left(expected.select(*SLICE_KEYS), counts)
    if failures is not None:
        rows = _null_safe_left(rows, failures.select(*SLICE_KEYS, F.col("error_message").alias("_error")))
    else:
        rows = rows.withColumn("_error", F.lit(None).cast("string"))
    failed = F.col("_error").isNotNull()
    year, session = F.col("year").cast("string"), F.col("session_key").cast("string")
    where = F.concat(
        F.lit(root.rstrip("/") + "/endpoint="), F.col("endpoint"), F.lit("/year="), F.coalesce(year, F.lit(NO_SESSION)),
        F.lit("/session_key="), F.coalesce(session, F.lit(NO_SESSION)),
    )
    now = F.lit(landed_at) if landed_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        *SLICE_KEYS, where.alias("output_path"),
        F.when(failed, F.lit(0)).otherwise(F.coalesce("_n", F.lit(0))).cast("bigint").alias("record_count"),
        F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
        F.coalesce("_error", F.lit("")).alias("error_message"), now.alias("ingestion_timestamp_utc"),
    ).select(*MANIFEST_COLUMNS)


def _null_safe_left(left: DataFrame, right: DataFrame) -> DataFrame:
    renamed = right.select(
        *[F.col(k).alias("_r_" + k) for k in SLICE_KEYS], *[c for c in right.columns if c not in SLICE_KEYS]
    )
    match = F.lit(True)
    for k in SLICE_KEYS:
        match = match & left[k].eqNullSafe(renamed["_r_" + k])
    return left.join(renamed, match, "left").drop(*["_r_" + k for k in SLICE_KEYS])


def land(
    records: DataFrame, expected: DataFrame, root: str, failures: DataFrame | None = None,
    landed_at: str | None = None,
) -> DataFrame:
    """Writes ``records`` (slice keys plus payload) below ``root`` and returns the manifest.

    All slices are written by one job; a failed slice is left out and does not stop the others.
    """
    if failures is not None:
        bad = failures.select(*[F.col(k).alias("_f_" + k) for k in SLICE_KEYS])
        match = F.lit(True)
        for k in SLICE_KEYS:
            match = match & records[k].eqNullSafe(bad["_f_" + k])
        records = records.join(bad, match, "left_anti")
    jsonl_sink(records, root, SLICE_KEYS)
    return landing_manifest(records, expected, root, failures, landed_at)
