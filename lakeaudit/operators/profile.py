"""Table profiles. Every report is one pass over its table, whatever the number of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.functions.brackets import column_stats
from lakeaudit.functions.columns import (
    CELL_PARTS, as_text, double_cell, dtype_of, groupable, is_numeric, name_at, not_nan, number_cells, pct, quoted,
    row_digest, rows_frame, value_cells,
)

# The percentiles of the numeric summary.
SUMMARY_QUANTILES = {
    "p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
}


def _column_catalog(df: DataFrame, names: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    return rows_frame(
        df, [(i, n, types[n]) for i, n in enumerate(names)],
        "ordinal int, column_name string, dtype string",
    )


def missingness(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """Per column: type, nulls, percentage, non-nulls and distinct non-null values.

    Exact distinct counts need each distinct value once. Cells are unpivoted to (column, value)
    and counted map-side first, so a value that fills a third of a column crosses the network once
    per task. ``approx`` replaces this by one HyperLogLog sketch per column and no unpivoting.
    """
    names = df.columns
    if approx:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, n in enumerate(names):
            cell = groupable(not_nan(quoted(n), dtype_of(df, n)), dtype_of(df, n))
            aggs += [F.count(not_nan(quoted(n), dtype_of(df, n))).alias(f"n{i}"), F.approx_count_distinct(cell).alias(f"d{i}")]
        cells = [
            F.struct(
                F.lit(n).alias("column_name"), F.col("_rows"), F.col(f"n{i}").alias("filled"),
                F.col(f"d{i}").alias("unique_count"),
            )
            for i, n in enumerate(names)
        ]
        stats = df.agg(*aggs).select(F.inline(F.array(*cells)))
    else:
        values = value_cells(df, names).groupBy("column_no", *CELL_PARTS).agg(F.count(F.lit(1)).alias("_n"))
        has_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in CELL_PARTS])
        stats = values.groupBy("column_no").agg(
            F.sum("_n").alias("_rows"),
            F.coalesce(F.sum(F.when(has_value, F.col("_n"))), F.lit(0)).alias("filled"),
            F.count_if(has_value).alias("unique_count"),
        ).withColumn("column_name", name_at(names))
    # both sides have one row per column of the schema
    joined = _column_catalog(df, names).join(F.broadcast(stats), "column_name", "left")
    rows, filled = F.coalesce("_rows", F.lit(0)), F.coalesce("filled", F.lit(0))
    return joined.select(
        F.lit(table).alias("table_name"), "column_name", "dtype",
        (rows - filled).alias("missing_count"), pct(rows - filled, rows).alias("missing_pct"),
        filled.alias("non_missing_count"),
        F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"),
    )


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """Missing counts only: a single aggregate without shuffling any cell."""
    filled = [F.count(not_nan(quoted(n), dtype_of(df, n))).alias(f"f{i}") for i, n in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *filled)
    cells = ", ".join(f"struct({i} as _place, _rows - f{i} as missing_count, _rows)" for i in range(len(df.columns)))
    return counts.selectExpr(f"inline(array({cells}))").select(
        F.lit(table).alias("table_name"), name_at(df.columns, "_place").alias("column_name"),
        "missing_count", pct(F.col("missing_count"), F.col("_rows")).alias("missing_pct"),
    )


def numeric_summary(
    df: DataFrame, table: str, columns: list[str] | None = None, approx: bool = False
) -> DataFrame:
    """count, mean, std, min, percentiles and max per numeric column, to 6 decimals.

    The default is exact for any size: sketches give brackets round the percentiles, and the few
    values inside are ranked. ``approx`` uses one sketch per column.
    """
    names = [
        c for c in (columns or df.columns)
        if c in df.columns and is_numeric(dtype_of(df, c))
    ]
    if not names:
        return rows_frame(
            df, [], "table_name string, column_name string, count bigint, mean double, std double, "
            "min double, p01 double, p05 double, p25 double, median double, p75 double, "
            "p95 double, p99 double, max double")
    if approx:
        cells, v = number_cells(df, names, "cell").where("cell is not null"), F.col("cell")
        probs = F.array(*[F.lit(p) for p in SUMMARY_QUANTILES.values()])
        stats = cells.groupBy("column_no").agg(
            F.count(F.lit(1)).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
            F.percentile_approx(v, probs, 10000).alias("_q"),
        )
        for i, q in enumerate(SUMMARY_QUANTILES):
            stats = stats.withColumn(q, F.col("_q")[i])
    else:
        found = column_stats(df, [double_cell(df, n) for n in names], SUMMARY_QUANTILES)
        stats = rows_frame(
            df, [(i, s.count, s.mean, s.std, s.least, s.most, *s.quantiles.values()) for i, s in enumerate(found) if s.count],
            "column_no int, count bigint, mean double, std double, min double, max double, "
            + ", ".join(f"{q} double" for q in SUMMARY_QUANTILES))
    stats = stats.withColumn("column_name", name_at(names))
    rounded = ["mean", "std", "min", *SUMMARY_QUANTILES, "max"]
    return stats.withColumn("std", F.coalesce("std", F.lit(0.0))).select(
        F.lit(table).alias("table_name"), "column_name", F.col("count"),
        # the last bits of a mean do not decide which way a tie is rounded
        *[F.round(F.round(F.col(c), 12) if c == "mean" else F.col(c), 6).alias(c) for c in rounded],
    )


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns, copies beyond the first of identical rows, empty cells.

    Rows are grouped on a digest of their content, which carries their number of empty cells along.
    """
    nulls = sum((not_nan(quoted(c), dtype_of(df, c)).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    rows = df.select(row_digest(df, df.columns).alias("_row"), nulls.alias("_nulls"))
    groups = rows.groupBy("_row", "_nulls").agg(F.count(F.lit(1)).alias("_copies"))
    width = F.lit(len(df.columns)).cast("bigint")
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    empty = F.coalesce(F.sum(F.col("_copies") * F.col("_nulls")), F.lit(0))
    return groups.agg(
        rows.alias("row_count"), F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_full_rows"),
        empty.alias("total_missing_cells"),
    ).select(
        F.lit(table).alias("table_name"), "row_count", width.alias("column_count"),
        "duplicate_full_rows", "total_missing_cells",
        (F.col("row_count") * width).alias("total_cells"),
        pct(F.col("total_missing_cells"), F.col("row_count") * width).alias("missing_cell_pct"),
    )


def mixed_type_columns(df: DataFrame) -> DataFrame:
    """Nested values to JSON text; text columns holding only numbers to double.

    Deciding on a text column needs to see all of it: one aggregate over all text columns at once.
    """
    types = dict(df.dtypes)
    texts = [c for c in df.columns if types[c] == "string"]
    numeric: set[str] = set()
    if texts:
        tests = [
            F.bool_and(quoted(c).isNull() | quoted(c).try_cast("double").isNotNull())
            & F.bool_or(quoted(c).isNotNull())
            for c in texts
        ]
        verdict = df.agg(F.array(*[F.coalesce(t, F.lit(False)) for t in tests]).alias("v")).first()["v"]
        numeric = {c for c, ok in zip(texts, verdict) if ok}
    out = []
    for c in df.columns:
        if c in numeric:
            out.append(quoted(c).try_cast("double").alias(c))
        elif types[c].startswith(("array", "map", "struct", "variant")):
            out.append(as_text(quoted(c), dtype_of(df, c)).alias(c))
        else:
            out.append(quoted(c))
    return df.select(*out)


def cleaning_impact(before: DataFrame, after: DataFrame) -> DataFrame:
    """Pairs two table_profile frames."""
    b, a = before.alias("b"), after.alias("a")
    removed = F.col("b.row_count") - F.col("a.row_count")
    return b.join(a, F.col("b.table_name") == F.col("a.table_name")).select(
        F.col("b.table_name"), F.col("b.row_count").alias("rows_before"),
        F.col("a.row_count").alias("rows_after"), removed.alias("rows_removed"),
        pct(removed, F.col("b.row_count")).alias("row_removal_pct"),
        F.col("b.column_count").alias("columns_before"), F.col("a.column_count").alias("columns_after"),
        F.col("b.total_missing_cells").alias("missing_cells_before"),
        F.col("a.total_missing_cells").alias("missing_cells_after"),
        F.col("b.missing_cell_pct").alias("missing_cell_pct_before"),
        F.col("a.missing_cell_pct").alias("missing_cell_pct_after"),
        F.col("b.duplicate_full_rows").alias("duplicate_rows_before"),
        F.col("a.duplicate_full_rows").alias("duplicate_rows_after"),
    )


def top_missing_per_table(report: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("table_name").orderBy(F.desc("missing_pct"), "column_name")
    return report.withColumn("missing_rank", F.row_number().over(w)).where(F.col("missing_rank") <= k)


def top_missing(report: DataFrame, k: int = 10) -> DataFrame:
    return report.orderBy(F.desc("missing_pct"), "table_name", "column_name").limit(k)


def missingness_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    keys = ["table_name", "column_name"]
    b = before.select(*keys, F.col("missing_pct").alias("missing_pct_before"))
    a = after.select(*keys, F.col("missing_pct").alias("missing_pct_after"))
    return b.join(a, keys).select(
        *keys, "missing_pct_before", "missing_pct_after",
        F.round(F.col("missing_pct_after") - F.col("missing_pct_before"), 4).alias("missing_pct_change"),
    )
