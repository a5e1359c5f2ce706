"""Data-quality audits that report and never change rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions.brackets import column_stats
from lakeaudit.functions.columns import (
    as_text, content_key, double_cell, dtype_of, is_numeric, name_at, pct, present, quoted, row_digest, rows_frame, stacked,
)
from lakeaudit.functions.ordered import falls_in_time
from lakeaudit.functions.skew import left_join
from lakeaudit.spec import ForeignKey

KEY_DUPLICATES_DDL = (
    "table_name string, duplicate_type string, key_columns string, duplicate_key_count bigint, "
    "affected_rows bigint, affected_rows_pct double, status string"
)


# --- duplicates -------------------------------------------------------------------------------

def full_row_duplicates(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Copies beyond the first of rows with equal content."""
    names = columns or df.columns
    copies = df.select(row_digest(df, names).alias("_row")).groupBy("_row").agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("_extra"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("_rows"),
    ).select(
        F.lit(table).alias("table_name"), F.lit("full_row").alias("duplicate_type"),
        F.col("_extra").alias("duplicate_count"), pct(F.col("_extra"), F.col("_rows")).alias("duplicate_pct"),
    )


def key_duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys held by more than one row and the rows that hold them; a null key is a key."""
    label = ",".join(keys)
    if len(present(df, keys)) < len(keys):
        return rows_frame(
            df, [(table, "key_duplicate", label, 0, 0, 0.0, "skipped_missing_columns")],
            KEY_DUPLICATES_DDL,
        )
    groups = df.groupBy(*[content_key(quoted(k), dtype_of(df, k)).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    many = F.col("_rows") > 1
    return groups.agg(
        F.count_if(many).alias("duplicate_key_count"),
        F.coalesce(F.sum(F.when(many, F.col("_rows"))), F.lit(0)).alias("affected_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_total"),
    ).select(
        F.lit(table).alias("table_name"), F.lit("key_duplicate").alias("duplicate_type"),
        F.lit(label).alias("key_columns"), "duplicate_key_count", "affected_rows",
        pct(F.col("affected_rows"), F.col("_total")).alias("affected_rows_pct"),
        F.when(F.col("_total") == 0, "skipped_empty").otherwise("checked").alias("status"),
    )


def duplicate_report(tables: dict[str, DataFrame], keys: dict[str, list[str]], stage: str) -> DataFrame:
    parts = []
    for name, df in tables.items():
        parts.append(full_row_duplicates(df, name))
        if name in keys:
            parts.append(key_duplicates(df, name, keys[name]))
    return union_reports(parts).withColumn("stage", F.lit(stage))


def union_reports(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- outliers ---------------------------------------------------------------------------------

def iqr_outliers(
    df: DataFrame, table: str, columns: list[str], multiplier: float = 1.5, approx: bool = False
) -> DataFrame:
    """Values beyond ``multiplier`` interquartile ranges; percentages are of all rows.

    Exact quartiles come from brackets, or from one sketch with ``approx``; a pass then counts what
    lies outside the fences.
    """
    names = present(df, columns)
    if not names:
        return rows_frame(
            df, [], "table_name string, column_name string, method string, lower_bound double, "
            "upper_bound double, outlier_count bigint, outlier_pct double, min_value double, "
            "max_value double")
    values = [double_cell(df, n) for n in names]
    if approx:
        quarters = [F.percentile_approx(v, F.array(F.lit(0.25), F.lit(0.75)), 10000).alias(f"q{i}") for i, v in enumerate(values)]
        row = df.agg(*quarters).first()
        bounds = [(None, None) if q is None else tuple(q) for q in row]
    else:
        bounds = [tuple(s.quantiles.values()) for s in column_stats(df, values, {"q1": 0.25, "q3": 0.75})]
    judged = [(n, v, q1 - (q3 - q1) * multiplier, q3 + (q3 - q1) * multiplier)
              for n, v, (q1, q3) in zip(names, values, bounds) if q1 is not None]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, v, low, high) in enumerate(judged):
        aggs += [F.count_if((v < F.lit(low)) | (v > F.lit(high))).alias(f"o{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    cells = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(n).alias("column_name"), F.lit("iqr").alias("method"),
            F.round(F.lit(low), 6).alias("lower_bound"), F.round(F.lit(high), 6).alias("upper_bound"),
            F.col(f"o{i}").alias("outlier_count"), pct(F.col(f"o{i}"), F.col("_rows")).alias("outlier_pct"),
            F.round(f"l{i}", 6).alias("min_value"), F.round(f"h{i}", 6).alias("max_value"))
        for i, (n, _, low, high) in enumerate(judged)
    ]
    if not cells:
        return iqr_outliers(df, table, [])
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def domain_violations(df: DataFrame, table: str, rules: list[tuple[str, str]]) -> DataFrame:
    """Rows breaking each (column, SQL condition that marks a bad value); nulls never do."""
    rules = [(c, bad) for c, bad in rules if c in df.columns]
    if not rules:
        return rows_frame(
            df, [], "table_name string, column_name string, rule string, invalid_count bigint, "
            "invalid_pct double")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.expr(bad)).alias(f"b{i}") for i, (_, bad) in enumerate(rules)]
    cells = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(bad).alias("rule"),
            F.col(f"b{i}").alias("invalid_count"),
            pct(F.col(f"b{i}"), F.col("_rows")).alias("invalid_pct"), F.col("_rows").alias("_rows"),
        )
        for i, (c, bad) in enumerate(rules)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells))).where("_rows > 0").drop("_rows")


def outlier_report(
    tables: dict[str, DataFrame], iqr_columns: dict[str, list[str]],
    domain_rules: dict[str, list[tuple[str, str]]], stage: str,
) -> DataFrame:
    parts = []
    for name, df in tables.items():
        if present(df, iqr_columns.get(name, [])):
            parts.append(
                iqr_outliers(df, name, iqr_columns[name]).withColumn("report_type", F.lit("iqr"))
            )
        if any(c in df.columns for c, _ in domain_rules.get(name, [])):
            parts.append(
                domain_violations(df, name, domain_rules[name]).withColumn("report_type", F.lit("domain"))
            )
    return union_reports(parts).withColumn("stage", F.lit(stage))


# --- time -------------------------------------------------------------------------------------

def _anomaly_rows(df: DataFrame, table: str, checks: list[tuple[str, str, Column, str]]) -> DataFrame:
    """(type, column, condition, note) checks in one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(f"a{i}") for i, (_, _, c, _) in enumerate(checks)])
    return _anomaly_report(counts, table, [(kind, column, note) for kind, column, _, note in checks])


def _anomaly_report(counts: DataFrame, table: str, checks: list[tuple[str, str, str]]) -> DataFrame:
    """The report of one row with ``_rows`` and a count ``a0``, ``a1``… per (type, column, note)."""
    cells = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(kind).alias("anomaly_type"),
            F.lit(column).alias("column_name"), F.col(f"a{i}").alias("anomaly_count"),
            pct(F.col(f"a{i}"), F.col("_rows")).alias("anomaly_pct"), F.lit(note).alias("notes"),
            F.col("_rows").alias("_rows"),
        )
        for i, (kind, column, note) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*cells))).where("_rows > 0").drop("_rows")


def unparseable(df: DataFrame, column: str) -> Column:
    """True where a text date is present but is not a date."""
    if dict(df.dtypes)[column] != "string":
        return F.lit(False)
    return quoted(column).isNotNull() & F.try_to_timestamp(quoted(column)).isNull()


def row_time_checks(
    df: DataFrame, table: str, start_end: tuple[str, str] | None = None, positive: str | None = None
) -> DataFrame | None:
    """Checks that need no other row: unparseable dates, start after end, non-positive number."""
    checks: list[tuple[str, str, Column, str]] = []
    for c in df.columns:
        if "date" in c.lower():
            checks.append((
                "unparseable_datetime", c, unparseable(df, c),
                f"{c}: text that is not a date",
            ))
    if start_end and len(present(df, start_end)) == 2:
        types = dict(df.dtypes)
        start, end = (
            F.try_to_timestamp(quoted(c)) if types[c] == "string" else quoted(c) for c in start_end
        )
        checks.append((
            "date_start_after_date_end", ",".join(start_end), start > end, "Start lies after the end",
        ))
    if positive and positive in df.columns:
        checks.append((
            "pit_lap_non_positive", positive, quoted(positive).try_cast("double") <= 0,
            "The number should be positive",
        ))
    return _anomaly_rows(df, table, checks) if checks else None


def lag_decrease(
    df: DataFrame, table: str, keys: list[str], number: str, time: str | None
) -> DataFrame:
    """Rows whose number is below that of the row before in time (or in number, without a time)."""
    if time:
        counts = falls_in_time(df, keys, time, number).select(F.col("rows").alias("_rows"), F.col("falls").alias("a0"))
    else:  # in its own order a number never falls
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), F.lit(0).cast("bigint").alias("a0"))
    return _anomaly_report(counts, table, [(
        "lap_number_decrease_within_stint", number, "Number decreased when ordered within its group")])


def outside_bounds(
    child: DataFrame, parent: DataFrame, table: str, key: str, moment: str, start: str, end: str,
    note: str = "Timestamp outside the parent's start and end",
) -> DataFrame:
    """Child timestamps outside the period of their parent; each parent key counts once."""
    bounds = parent.groupBy(key).agg(
        F.min(start).alias("_start"), F.max(end).alias("_end")
    )
    # both sides come straight out of a shuffle on the key, so adaptive execution splits a hot key
    joined = child.select(key, moment).join(bounds.repartition(key), key, "left")
    at = quoted(moment)
    outside = F.col("_start").isNotNull() & ((at < F.col("_start")) | (at > F.col("_end")))
    return _anomaly_rows(joined, table, [("weather_outside_session_bounds", moment, outside, note)])


# --- referential integrity --------------------------------------------------------------------

FK_DDL = (
    "child_table string, parent_table string, key_columns string, distinct_child_keys bigint, "
    "unmatched_rows bigint, unmatched_pct double, status string"
)


def fk_check(
    child: DataFrame | None, parent: DataFrame | None, child_table: str, parent_table: str,
    child_keys: list[str], parent_keys: list[str] | None = None,
) -> DataFrame:
    """Distinct non-null child keys without a parent.

    Both sides are reduced to distinct keys first, so a hot key is one row in the join, and the
    join reuses the partitioning of the two distincts.
    """
    parent_keys = parent_keys or child_keys
    label = ",".join(child_keys)
    frame = child if child is not None else parent
    skipped = None
    if child is None or parent is None:
        skipped = "skipped_missing_table"
    elif len(present(child, child_keys)) < len(child_keys) or len(present(parent, parent_keys)) < len(parent_keys):
        skipped = "skipped_missing_columns"
    if skipped:
        return rows_frame(frame, [(child_table, parent_table, label, None, 0, 0.0, skipped)], FK_DDL)

    # Level 1 keeps one row per key and side, nulls included, so that emptiness shows as well.
    kids = child.groupBy(*[quoted(c).alias(f"k{i}") for i, c in enumerate(child_keys)]).agg(
        F.lit(True).alias("_child")
    )
    elders = parent.groupBy(*[quoted(c).alias(f"k{i}") for i, c in enumerate(parent_keys)]).agg(
        F.lit(True).alias("_parent")
    )
    names = [f"k{i}" for i in range(len(child_keys))]
    whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    joined = kids.join(elders, names, "full_outer")
    valid_child = F.col("_child") & whole
    return joined.agg(
        F.count("_child").alias("_kids"), F.count("_parent").alias("_elders"),
        F.count_if(valid_child).alias("_keys"),
        F.count_if(valid_child & F.col("_parent").isNull()).alias("_unmatched"),
    ).select(
        F.lit(child_table).alias("child_table"), F.lit(parent_table).alias("parent_table"),
        F.lit(label).alias("key_columns"),
        F.when((F.col("_kids") > 0) & (F.col("_elders") > 0), F.col("_keys")).alias("distinct_child_keys"),
        F.when(F.col("_elders") > 0, F.col("_unmatched")).otherwise(0).alias("unmatched_rows"),
        F.when(F.col("_elders") > 0, pct(F.col("_unmatched"), F.col("_keys"))).otherwise(0.0).alias("unmatched_pct"),
        F.when(F.col("_kids") == 0, "skipped_empty_child")
        .when(F.col("_elders") == 0, "skipped_empty_parent").otherwise("checked").alias("status"),
    )


def _is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _common_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The number type in which keys of two types are compared, as a join on them would; else None."""
    if _is_whole(one) and _is_whole(other):
        return T.LongType()
    if is_numeric(one) and is_numeric(other):
        return one if one == other else T.DoubleType()
    for number, text in ((one, other), (other, one)):
        if is_numeric(number) and isinstance(text, T.StringType):
            return T.LongType() if _is_whole(number) else T.DoubleType()
    return None


def _key_cell(df: DataFrame, name: str, common: T.DataType | None, whole_only: bool) -> Column:
    """The key in the edge's common type: as bigint where all keys are whole numbers, else as text."""
    value, dtype = quoted(name), dtype_of(df, name)
    if common is not None:
        value, dtype = value.try_cast(common), common
    return value if whole_only else as_text(value, dtype)


def fk_suite(tables: dict[str, DataFrame], edges: list[ForeignKey], stage: str) -> DataFrame:
    """All edges in one job: each table is read once, whatever the number of its edges.

    A row is listed under every edge it takes part in, as (edge, key, side); one grouping by edge
    and key, mostly done before the shuffle, then shows which child keys have no parent.
    """
    spark = next(iter(tables.values())).sparkSession
    width = max(len(e.columns) for e in edges)
    names = [f"k{i}" for i in range(width)]
    used = [(tables.get(t), c) for e in edges for t, cs in (
        (e.child, e.columns), (e.parent, e.parent_columns or e.columns)) for c in cs]
    whole_only = all(_is_whole(dtype_of(df, c)) for df, c in used if df is not None and c in df.columns)
    filler = F.lit(0).cast("bigint") if whole_only else F.lit("")
    catalog, listed = [], {}
    for no, edge in enumerate(edges):
        sides = ((edge.child, edge.columns, True), (edge.parent, edge.parent_columns or edge.columns, False))
        frames = [tables.get(t) for t, _, _ in sides]
        status = None
        if None in frames:
            status = "skipped_missing_table"
        elif any(len(present(df, c)) < len(c) for df, (_, c, _) in zip(frames, sides)):
            status = "skipped_missing_columns"
        catalog.append((no, edge.child, edge.parent, ",".join(edge.columns), status))
        if status:
            continue
        common = [_common_type(dtype_of(frames[0], a), dtype_of(frames[1], b)) for a, b in zip(sides[0][1], sides[1][1])]
        for df, (table, columns, is_child) in zip(frames, sides):
            keys = [_key_cell(df, c, t, whole_only) for c, t in zip(columns, common)]
            keys += [filler] * (width - len(keys))
            listed.setdefault(table, []).append([F.lit(2 * no + is_child), *keys])
    parts = [stacked(tables[t], cells, ["edge_side", *names]) for t, cells in listed.items()]
    edge_rows = rows_frame(
        spark, catalog, "edge int, child_table string, parent_table string, key_columns string, skipped string")
    if parts:
        rows = reduce(lambda x, y: x.unionByName(y), parts)
        whole = reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in names])
        is_child = (F.col("edge_side") % 2) == 1
        # incomplete keys only show that a side has rows, so they become one group per edge
        rows = rows.select(
            F.floor(F.col("edge_side") / 2).cast("int").alias("edge"), is_child.alias("is_child"),
            whole.alias("whole"), *[F.when(whole, F.col(n)).alias(n) for n in names])
        keys = rows.groupBy("edge", "whole", *names).agg(
            F.bool_or("is_child").alias("child"), F.bool_or(~F.col("is_child")).alias("parent"))
        kid = F.col("whole") & F.col("child")
        counts = keys.groupBy("edge").agg(
            F.bool_or("child").alias("has_child"), F.bool_or("parent").alias("has_parent"),
            F.count_if(kid).alias("keys"), F.count_if(kid & ~F.col("parent")).alias("unmatched"))
    else:
        counts = spark.createDataFrame([], "edge int, has_child boolean, has_parent boolean, keys bigint, unmatched bigint")
    no_child, no_parent = ~F.coalesce("has_child", F.lit(False)), ~F.coalesce("has_parent", F.lit(False))
    status = (
        F.when(F.col("skipped").isNotNull(), F.col("skipped")).when(no_child, "skipped_empty_child")
        .when(no_parent, "skipped_empty_parent").otherwise("checked"))
    checked = status == "checked"
    return edge_rows.join(F.broadcast(counts), "edge", "left").select(  # counts: one row per edge
        "child_table", "parent_table", "key_columns",
        F.when(checked, F.col("keys")).alias("distinct_child_keys"),
        F.when(checked, F.col("unmatched")).otherwise(0).alias("unmatched_rows"),
        F.when(checked, pct(F.col("unmatched"), F.col("keys"))).otherwise(0.0).alias("unmatched_pct"),
        status.alias("status"), F.lit(stage).alias("stage"),
    )


def error_taxonomy(reports: dict[str, DataFrame]) -> DataFrame:
    """Number of rows in each report."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("issue_rows")).select(
            F.lit(label).alias("report_type"), "issue_rows", F.lit(label).alias("source_file")
        )
        for label, df in reports.items()
    ]
    return union_reports(parts)
