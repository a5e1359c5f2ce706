"""Ordered computations over data of any size: ranks, running totals and lags.

A window without PARTITION BY (or with one hot key) puts everything in one task. Here the rows are
range-partitioned on the whole order instead, so a hot key is spread over many slices; each slice
works alone and is then shifted by a total per slice. The layout is checkpointed because the slice
numbers are read twice and must not change between the reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions.columns import quoted
from lakeaudit.functions.durable import durable

SLICE = "_slice"
SEAT = "_seat"
_SLICE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def range_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in range partitions of ``order`` with slice number and 0-based seat in the slice."""
    row_id = F.monotonically_increasing_id()
    laid = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    laid = laid.withColumn("_row_id", row_id)
    laid = laid.withColumns({
        SLICE: F.shiftright("_row_id", _SLICE_BITS),
        SEAT: F.col("_row_id").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)),
    }).drop("_row_id")
    return durable(laid)


def row_rank(df: DataFrame, order: Sequence[str], name: str = "row_rank") -> DataFrame:
    """0-based global position of every row. ``order`` should identify a row."""
    laid = range_slices(df, order)
    sizes = laid.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: bounded by the partition count, so safe to broadcast
    starts = sizes.select(SLICE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        laid.join(F.broadcast(starts), SLICE)
        .withColumn(name, F.col("_start") + F.col(SEAT))
        .drop(SLICE, SEAT, "_start")
    )


def _same_slice(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> Column:
    match = left[SLICE] == right["_r" + SLICE]
    for g in groups:
        match = match & left[g].eqNullSafe(right["_r_" + g])
    return match


def _prefixed(df: DataFrame, groups: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.select(
        F.col(SLICE).alias("_r" + SLICE), *[F.col(g).alias("_r_" + g) for g in groups], *keep
    )


def prefix_sums(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Adds ``<value>_before`` (total of the group's earlier rows) and ``<value>_total``."""
    laid = range_slices(df, [*groups, *order])
    seen = (
        Window.partitionBy(SLICE, *groups).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = laid.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(seen), F.lit(0)) for v in values})
    totals = laid.groupBy(SLICE, *groups).agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    # at most one row per slice and group here
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumns({
        **{f"_start_{v}": F.coalesce(F.sum(f"_tot_{v}").over(earlier), F.lit(0)) for v in values},
        **{f"{v}_total": F.sum(f"_tot_{v}").over(whole) for v in values},
    })
    shifts = [c for v in values for c in (f"_start_{v}", f"{v}_total")]
    starts = _prefixed(starts, groups, shifts)
    joined = inside.join(starts, _same_slice(inside, starts, groups))
    out = [joined[c] for c in df.columns]
    for v in values:
        out.append((F.col(f"_in_{v}") + F.col(f"_start_{v}")).alias(f"{v}_before"))
        out.append(F.col(f"{v}_total"))
    return joined.select(*out)


def lagged(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Previous ``value`` of the same group in ``order``, also across slice borders."""
    laid = range_slices(df, [*groups, *order])
    w = Window.partitionBy(SLICE, *groups).orderBy(SEAT)
    inside = laid.withColumns({"_prev": F.lag(value).over(w), "_nth": F.row_number().over(w)})
    # last seen value per (group, slice); a struct keeps null values apart from "no row"
    last = laid.groupBy(SLICE, *groups).agg(F.max(F.struct(SEAT, value)).alias("_last"))
    carry = last.withColumn(
        "_carry", F.lag(F.col("_last")[value]).over(Window.partitionBy(*groups).orderBy(SLICE))
    )
    carry = _prefixed(carry, groups, ["_carry"])
    joined = inside.join(carry, _same_slice(inside, carry, groups))
    previous = F.when(F.col("_nth") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    return joined.select(*[joined[c] for c in df.columns], previous.alias(name))


# ---------------------------------------------------------------- neighbours in time

#: Rows of a time bucket, about; buckets of a table at most, and how many cuts are compared at a time.
BUCKET_ROWS, MOST_BUCKETS, _STEP = 1_000_000, 4096, 64


def _position(df: DataFrame, column: str) -> Column:
    """A double that never falls when the column rises. Texts are placed by seven bytes behind what all share."""
    kind, value = df.schema[column].dataType, quoted(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if not isinstance(kind, T.StringType):
        return value.cast("double")
    ends = df.agg(F.min(value.cast("binary")).alias("a"), F.max(value.cast("binary")).alias("b")).first()
    if ends["a"] is None:
        return F.lit(None).cast("double")
    shared = next((i for i, (x, y) in enumerate(zip(ends["a"], ends["b"])) if x != y), min(len(ends["a"]), len(ends["b"])))
    seven = F.rpad(F.hex(F.substring(value.cast("binary"), shared + 1, 7)), 14, "0")
    return F.conv(seven, 16, 10).cast("double")


def time_bucket(df: DataFrame, column: str) -> Column:
    """A number per row that follows the column's order; equal moments share a bucket, a null is first.

    The cuts come from a sketch, so that buckets hold about as many rows however the moments lie.
    """
    rows = df.agg(F.count(quoted(column)).alias("n")).first()["n"]
    buckets = min(MOST_BUCKETS, rows // BUCKET_ROWS + 1)
    if buckets == 1:
        return F.when(quoted(column).isNotNull(), 0).otherwise(-1)
    at = _position(df, column)
    sketch = F.kll_sketch_agg_double(at, F.lit(MOST_BUCKETS))
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = sorted(set(df.agg(F.kll_sketch_get_quantile_double(sketch, probs).alias("q")).first()["q"]))
    steps = [cuts[i:i + _STEP] for i in range(0, len(cuts), _STEP)]
    whole = F.size(F.filter(F.array(*[F.lit(s[-1]) for s in steps]), lambda c: c < at))
    part = F.element_at(F.array(*[F.array(*[F.lit(c) for c in s]) for s in [*steps, steps[-1]]]), whole + 1)
    inside = F.when(whole < len(steps), F.size(F.filter(part, lambda c: c < at))).otherwise(0)
    return F.when(at.isNull(), -1).otherwise(whole * _STEP + inside)


def falls_in_time(df: DataFrame, keys: Sequence[str], time: str, number: str) -> DataFrame:
    """One row: ``rows``, and ``falls``: rows whose number is below that of the row before, per key, in time.

    Rows of one moment are ordered by number, so they cannot fall among themselves, and a moment is known
    by its least and its largest number. Moments are compared within (key, time bucket) groups; of every
    bucket the first and the last moment are then compared with its neighbours. A null number comes first.
    """
    bucket = time_bucket(df, time).alias("_bucket")
    key_columns = [quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    keys = [f"_k{i}" for i in range(len(keys))]
    value = quoted(number).try_cast("double")
    slim = df.select(*key_columns, bucket, quoted(time).alias("_t"), value.alias("_v"))
    moments = slim.groupBy(*keys, "_bucket", "_t").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_v").alias("_last"),
        F.when(F.count("_v") == F.count(F.lit(1)), F.min("_v")).alias("_first"))
    before = F.lag("_last").over(Window.partitionBy(*keys, "_bucket").orderBy(F.col("_t").asc_nulls_first()))
    compared = moments.withColumn("_falls", (F.col("_first") < before).cast("long"))
    buckets = compared.groupBy(*keys, "_bucket").agg(
        F.sum("_rows").alias("_rows"), F.sum("_falls").alias("_falls"),
        F.min(F.struct("_t", "_first")).getField("_first").alias("_first"),
        F.max(F.struct("_t", "_last")).getField("_last").alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))
    met = buckets.withColumn("_met", (F.col("_first") < before).cast("long"))
    return met.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        (F.coalesce(F.sum("_falls"), F.lit(0)) + F.coalesce(F.sum("_met"), F.lit(0))).alias("falls"))
