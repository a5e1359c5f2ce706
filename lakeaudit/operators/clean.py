"""Declarative cleaning: one lazy plan for the rows, one aggregate for the log of every rule.

Rules run in order and each row leaves at the first rule it breaks, so the row counts of all rules
follow from a single tag per row. Duplicates are counted by grouping, never by ordering, and the
surviving row of a key is the first in a total order, so reruns and shuffled inputs agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions.columns import (
    cast_columns, content_key, dtype_of, groupable, present, quoted, rows_frame, snake_case,
)
from lakeaudit.spec import TableSpec

LOG_DDL = (
    "table_name string, rule_id string, rule_description string, rows_before bigint, "
    "rows_after bigint, rows_removed bigint, values_imputed bigint, columns_affected string, "
    "severity string, rationale string"
)

# Rule identifiers readers of the log rely on.
RENAME_RULE = "SIL_RENAME"
NULL_KEY_RULE = "SIL_DROP_NULL_KEYS"
EXACT_RULE = "SIL_DUP_FULL"
KEY_RULE = "SIL_DUP_KEY"
RETAINED_RULE = "SIL_RC_DUP_CHECK_RETAINED"
EMPTY_RULE = "SIL_EMPTY"
OPTIONAL_EMPTY_RULE = "SIL_OPTIONAL_EMPTY"
NOTHING_REJECTED_RULE = "SIL_NONE"


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Snake-case names, add aliased columns, cast."""
    df = snake_case(df)
    for new, source in spec.defaults_from.items():
        if new not in df.columns and source in df.columns:
            df = df.withColumn(new, F.col(source))
    return cast_columns(df, spec.casts)


def _filters(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str, str, str, Column]]:
    """(rule_id, description, columns, severity, rationale, keep) of the applicable row rules."""
    steps = []
    keys = present(df, spec.not_null)
    if keys:
        keep = reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys])
        steps.append((
            NULL_KEY_RULE, "Drop rows with a null in " + ", ".join(keys), ",".join(keys), "high",
            f"a {spec.name} row is identified by these columns", keep,
        ))
    for rule in spec.rules:
        keep = rule.keep(df.columns)
        if keep is not None:
            columns = ",".join(present(df, rule.columns) or rule.columns)
            steps.append((
                rule.rule_id, rule.description, columns, rule.severity, rule.rationale, keep,
            ))
    return steps


def _business(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns that make two rows the same row; where a row was read from does not."""
    return [c for c in df.columns if c not in spec.provenance]


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    keys = present(df, keys)
    return df.dropna(how="any", subset=keys) if keys else df


def dedupe_exact(df: DataFrame, ignore: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """One row per distinct content; of the ignored columns the smallest value is kept."""
    ignored = present(df, ignore)
    content = [c for c in df.columns if c not in ignored]
    nested = {c for c in content if isinstance(dtype_of(df, c), (T.MapType, T.VariantType))}
    if not ignored and not nested:
        return df.dropDuplicates()
    keys = [groupable(quoted(c), dtype_of(df, c)).alias(c) for c in content]
    picks = [F.min(quoted(c)).alias(c) for c in ignored]
    if not nested:
        return df.groupBy(*keys).agg(*picks).select(*df.columns)
    tagged = df.withColumns({"_k_" + c: groupable(quoted(c), dtype_of(df, c)) for c in nested})
    group = [quoted("_k_" + c) if c in nested else quoted(c) for c in content]
    picks += [F.any_value(quoted(c)).alias(c) for c in nested]
    if not picks:
        picks = [F.count(F.lit(1)).alias("_rows")]
    return tagged.groupBy(*group).agg(*picks).select(*df.columns)


def dedupe_key(
    df: DataFrame, keys: list[str], order: list[Column] | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """First row of each key in a total order: ``order``, then ``tie_break`` (all columns).

    ``row_number() = 1`` straight above the window lets Spark keep one candidate row per key and
    input task before the shuffle, so a hot key costs a task no more than the number of tasks.
    """
    keys = present(df, keys)
    if not keys:
        return df
    rest = [
        groupable(quoted(c), dtype_of(df, c)).asc_nulls_first()
        for c in (tie_break or df.columns) if c not in keys
    ]
    w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*(order or []), *rest)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The cleaned rows."""
    df = prepare(df, spec)
    for *_, keep in _filters(df, spec):
        df = df.where(keep)
    keys = present(df, spec.dedupe_keys)
    if keys and len(keys) == len(spec.dedupe_keys):
        # The order covers every column, so identical rows collapse here as well.
        order = [quoted(c).asc_nulls_first() for c in present(df, spec.dedupe_order)]
        tie_break = _business(df, spec) + present(df, spec.provenance)
        return dedupe_key(df, list(keys), order, tie_break)
    return dedupe_exact(df, spec.provenance)


def _tagged(df: DataFrame, spec: TableSpec, steps: list) -> DataFrame:
    tag = F.lit(0)
    for number in range(len(steps), 0, -1):
        keep = steps[number - 1][-1]
        tag = F.when(F.coalesce(keep, F.lit(False)), tag).otherwise(F.lit(number))
    return df.withColumn("_tag", tag)


def cleaning_log(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Row impact of each rule, from one scan of the raw table.

    Level 1 counts copies of identical rows, level 2 the distinct rows per key, level 3 everything.
    Rows that broke a rule carry nulls in place of their content, so they collapse into one group
    per rule before the shuffle.
    """
    df = prepare(raw, spec)
    steps = _filters(df, spec)
    key_names = present(df, spec.dedupe_keys)
    by_key = bool(spec.dedupe_keys) and len(key_names) == len(spec.dedupe_keys)
    repeat_keys = present(df, spec.repeats_checked)
    group_keys = list(key_names) if by_key else list(repeat_keys)
    content = _business(df, spec)

    tagged = _tagged(df, spec, steps)
    cells = [
        F.when(F.col("_tag") == 0, content_key(quoted(c), dtype_of(df, c))).alias(c) for c in content
    ]
    copies = (
        tagged.select("_tag", *cells).groupBy("_tag", *[quoted(c) for c in content])
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    if group_keys:
        per_key = copies.groupBy("_tag", *[quoted(k) for k in group_keys]).agg(
            F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_distinct")
        )
    else:
        per_key = copies.select("_tag", "_rows", F.lit(1).alias("_distinct"))

    survived = F.col("_tag") == 0
    repeated = survived & (F.col("_distinct") > 1)
    counts = [F.coalesce(F.sum("_rows"), F.lit(0)).alias("total")]
    for number in range(1, len(steps) + 1):
        counts.append(
            F.coalesce(F.sum(F.when(F.col("_tag") == number, F.col("_rows"))), F.lit(0)).alias(f"r{number}")
        )
    counts += [
        F.coalesce(F.sum(F.when(survived, F.col("_rows") - F.col("_distinct"))), F.lit(0)).alias("exact"),
        F.coalesce(F.sum(F.when(survived, F.col("_distinct") - 1)), F.lit(0)).alias("key"),
        F.count_if(repeated).alias("repeat_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_distinct"))), F.lit(0)).alias("repeat_rows"),
    ]
    totals = per_key.agg(*counts)
    return totals.select(F.inline(F.array(*_log_rows(spec, df, steps, by_key, repeat_keys)))).where(
        "applies"
    ).drop("applies")


def _log_rows(spec: TableSpec, df: DataFrame, steps: list, by_key: bool, repeat_keys: list) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    has_rows = F.col("total") > 0
    left = F.col("total")
    rows: list[Column] = []

    def add(rule, text, columns, severity, rationale, removed, applies):
        nonlocal left
        after = left - removed
        description = text if isinstance(text, Column) else F.lit(text)
        rows.append(F.struct(
            F.lit(spec.name).alias("table_name"), F.lit(rule).alias("rule_id"),
            description.alias("rule_description"), left.alias("rows_before"),
            after.alias("rows_after"), removed.alias("rows_removed"), zero.alias("values_imputed"),
            F.lit(columns).alias("columns_affected"), F.lit(severity).alias("severity"),
            F.lit(rationale).alias("rationale"), applies.alias("applies"),
        ))
        left = after

    empty_rule = OPTIONAL_EMPTY_RULE if spec.optional else EMPTY_RULE
    add(empty_rule, f"No input rows for {spec.name}", "", "low", "", zero, ~has_rows)
    add(RENAME_RULE, "Column names to snake_case", "", "low", "", zero, has_rows)
    casts = present(df, spec.casts)
    add(
        spec.cast_rule_id, "Cast columns; values that do not parse become null", ",".join(casts),
        "low", "", zero, has_rows,
    )
    for number, (rule, text, columns, severity, rationale, _) in enumerate(steps, 1):
        add(rule, text, columns, severity, rationale, F.col(f"r{number}"), has_rows)
    add(EXACT_RULE, "Drop further copies of identical rows", "", "medium", "", F.col("exact"), has_rows)
    if by_key:
        keys = ",".join(spec.dedupe_keys)
        add(KEY_RULE, f"Keep one row per {keys}", keys, "high", "", F.col("key"), has_rows)
    elif repeat_keys:
        note = F.format_string(
            "%d keys repeat in %d rows; all kept", F.col("repeat_keys"), F.col("repeat_rows")
        )
        add(
            RETAINED_RULE, note, ",".join(repeat_keys), "low",
            "an event may legitimately be reported more than once", zero, has_rows,
        )
    return rows


def empty_table(spark, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.empty_ddl)


def rejected_records(log: DataFrame, table_names: list[str]) -> DataFrame:
    """Rules that removed rows, or one placeholder row per table when none did."""
    removed = log.where("rows_removed > 0").select(
        "table_name", "rule_id", F.col("rule_description").alias("reason"),
        F.col("rows_removed").alias("rejected_count"),
    )
    none = rows_frame(
        log,
        [(t, NOTHING_REJECTED_RULE, "No records rejected in this run", 0) for t in table_names],
        "table_name string, rule_id string, reason string, rejected_count bigint",
    )
    any_removed = log.agg(F.coalesce(F.bool_or(F.col("rows_removed") > 0), F.lit(False)))
    return removed.unionByName(none.where(~any_removed.scalar()))


def zero_fill(df: DataFrame, names: list[str]) -> DataFrame:
    return df.fillna(0, subset=present(df, names))


def with_optional(df: DataFrame, wanted: dict[str, tuple[list[str], str, object]]) -> DataFrame:
    """Adds columns from the first non-null of the sources that exist, else a typed default.

    ``wanted[name] = (sources, type, default)``.
    """
    columns = {}
    for name, (sources, dtype, default) in wanted.items():
        parts = [quoted(c).try_cast(dtype) for c in present(df, sources)]
        if default is not None or not parts:
            parts.append(F.lit(default).cast(dtype))
        columns[name] = F.coalesce(*parts)
    return df.withColumns(columns)


def event_sessions(
    df: DataFrame, name_col: str, type_col: str, allowed: list[str], key: str,
    keep: dict[str, str], latest: list[Column],
) -> DataFrame:
    """Rows whose name or type is in ``allowed`` (case-insensitive), the last per key, projected."""
    names = [a.lower() for a in allowed]
    tests = [F.lower(quoted(c)).isin(names) for c in present(df, [name_col, type_col])]
    hit = reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(False))
    rows = dedupe_key(df.where(hit), [key], latest)
    types = dict(df.dtypes)
    return rows.select(*[
        quoted(c).alias(c) if c in types else F.lit(None).cast(t).alias(c) for c, t in keep.items()
    ])
