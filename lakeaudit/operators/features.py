"""Feature aggregates and the joins that assemble a mart.

Each ``*_aggregates`` function returns plain aggregate columns, so groups fed by the same table
and key can share one ``groupBy``; ``*_features`` wraps one group on its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.functions.brackets import group_medians
from lakeaudit.functions.columns import pct, present, quoted
from lakeaudit.functions.skew import left_join

# Search terms per message count. A term matches anywhere in the upper-cased
# "message flag" text, so a virtual safety car counts in both of its terms.
MESSAGE_TERMS: dict[str, tuple[str, ...]] = {
    "yellow_flag_count": ("YELLOW",),
    "red_flag_count": ("RED",),
    "green_flag_count": ("GREEN",),
    "safety_car_message_count": ("SAFETY CAR", "VIRTUAL SAFETY CAR"),
    "pit_exit_message_count": ("PIT EXIT",),
}

# Event counts that mean "none" when nothing was recorded.
EVENT_COUNT_COLUMNS = (
    "pit_stop_count", "early_pit_stop_flag", "lap_count", "pit_out_lap_count",
    "race_control_message_count", "flag_message_count", "yellow_flag_count", "red_flag_count",
    "green_flag_count", "safety_car_message_count", "pit_exit_message_count",
)


# --- label ------------------------------------------------------------------------------------

def label(points: Column) -> Column:
    """1 where points are positive, else 0; unknown points count as none."""
    return F.when(points > 0, 1).otherwise(0)


# --- laps and stops ---------------------------------------------------------------------------

def lap_aggregates(
    columns: list[str], number: str, duration: str, means: dict[str, str],
    flag: tuple[str, str] | None, early: int,
) -> list[Column]:
    """Lap count, time statistics, means of further measures, and the first ``early`` laps."""
    time = quoted(duration)
    first = F.when(quoted(number) <= early, time)
    aggs = [
        F.count(quoted(number)).alias("lap_count"),
        F.avg(time).alias("avg_lap_duration"),
        F.min(time).alias("best_lap_duration"),
        F.stddev_samp(time).alias("std_lap_duration"),
        F.avg(first).alias("avg_first5_lap_duration"),
        F.min(first).alias("best_first5_lap_duration"),
        F.stddev_samp(first).alias("std_first5_lap_duration"),
    ]
    aggs += [F.avg(quoted(c)).alias(out) for out, c in means.items() if c in columns]
    if flag and flag[1] in columns:
        aggs.append(F.count_if(quoted(flag[1])).alias(flag[0]))
    return aggs


def grouped_with_median(
    df: DataFrame, keys: list[str], value: str, name: str, aggs: list[Column], approx: bool = False
) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` plus the median of ``value``: exact, or sketched with ``approx``."""
    if approx:
        return df.groupBy(*keys).agg(*aggs, F.percentile_approx(value, 0.5).alias(name))
    return group_medians(df, keys, value, name, aggs)


def lap_features(
    laps: DataFrame, keys: list[str], means: dict[str, str], number: str = "lap_number",
    duration: str = "lap_duration", flag: tuple[str, str] | None = ("pit_out_lap_count", "is_pit_out_lap"),
    early: int = 5, approx_median: bool = False,
) -> DataFrame:
    aggs = lap_aggregates(laps.columns, number, duration, means, flag, early)
    return grouped_with_median(laps, keys, duration, "median_lap_duration", aggs, approx_median)


def pit_aggregates(number: str, duration: str, early: int, only: Column | None = None) -> list[Column]:
    """Stop count, duration statistics, first stop and whether it came early."""
    def of(value: Column) -> Column:
        return value if only is None else F.when(only, value)

    first = F.min(of(quoted(number)))
    return [
        F.count(of(F.lit(1))).alias("pit_stop_count"),
        F.avg(of(quoted(duration))).alias("avg_pit_duration"),
        F.min(of(quoted(duration))).alias("min_pit_duration"),
        F.max(of(quoted(duration))).alias("max_pit_duration"),
        first.alias("first_pit_lap"),
        F.when(first <= early, 1).otherwise(0).alias("early_pit_stop_flag"),
    ]


def pit_features(
    pit: DataFrame, keys: list[str], number: str = "lap_number", duration: str = "pit_duration",
    early: int = 10,
) -> DataFrame:
    return pit.groupBy(*keys).agg(*pit_aggregates(number, duration, early))


# --- observations in time ---------------------------------------------------------------------

def first_observations(
    df: DataFrame, keys: list[str], time: str, tie_break: list[str], n: int = 5
) -> DataFrame:
    """First n rows per key in time. Spark keeps n candidates per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(
        F.col(time).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]
    )
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n)


def position_features(
    positions: DataFrame, keys: list[str], time: str = "date", position: str = "position",
    tie_break: list[str] | None = None, n: int = 5,
) -> DataFrame:
    """First, mean, extremes and count over the first n observations, and the last observed value.

    First and last skip null positions. ``position_total_observation_count`` counts all rows.
    """
    tie_break = tie_break if tie_break is not None else [position]
    value = quoted(position)
    rows = positions.select(*keys, time, position, *[c for c in tie_break if c not in (position, time)])
    first = first_observations(rows, keys, time, tie_break, n).groupBy(*keys).agg(
        F.min_by(value, F.when(value.isNotNull(), F.col("_nth"))).alias("first_observed_position"),
        F.avg(value).alias("early_avg_position"),
        F.min(value).alias("early_min_position"),
        F.max(value).alias("early_max_position"),
        F.count(value).alias("position_observation_count"),
    )
    moment = F.struct(quoted(time), *[quoted(c) for c in tie_break])
    usable = value.isNotNull() & quoted(time).isNotNull()
    last = rows.groupBy(*keys).agg(
        F.max_by(value, F.when(usable, moment)).alias("diagnostic_final_observed_position"),
        F.count(F.lit(1)).alias("position_total_observation_count"),
    )
    return _join_same_keys(first, last, keys)


def _join_same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join of two sides that were grouped on ``keys`` from the same rows."""
    renamed = right.select(
        *[F.col(k).alias("_r_" + k) for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed["_r_" + k]) for k in keys])
    return left.join(renamed, match, "left").drop(*["_r_" + k for k in keys])


# --- session grain ----------------------------------------------------------------------------

def weather_features(
    weather: DataFrame, keys: list[str], means: dict[str, str], rainfall: str = "rainfall"
) -> DataFrame:
    """Session means of the measures that exist, and whether it ever rained."""
    aggs = [F.avg(quoted(c)).alias(out) for out, c in means.items() if c in weather.columns]
    if rainfall in weather.columns:
        aggs += [
            F.avg(quoted(rainfall)).alias("rainfall_mean"),
            F.when(F.max(quoted(rainfall)) > 0, 1).otherwise(0).alias("rainfall_flag"),
        ]
    return weather.groupBy(*keys).agg(*aggs)


def message_features(
    messages: DataFrame, keys: list[str], message: str = "message", flag: str | None = "flag",
    terms: dict[str, tuple[str, ...]] | None = None, whole_words: bool = False,
) -> DataFrame:
    """Counts of messages, of flagged messages and of each search term.

    Every term of an entry adds its own hits. ``whole_words`` makes RED miss CLEARED.
    """
    terms = MESSAGE_TERMS if terms is None else terms
    flag_value = quoted(flag) if flag and flag in messages.columns else F.lit(None).cast("string")
    text = F.upper(F.concat_ws(" ", F.coalesce(quoted(message), F.lit("")), F.coalesce(flag_value, F.lit(""))))

    def hits(term: str) -> Column:
        if whole_words:
            return F.count_if(text.rlike(r"(?<![A-Z0-9])" + term + r"(?![A-Z0-9])"))
        return F.count_if(text.contains(term))

    aggs = [
        F.count(F.lit(1)).alias("race_control_message_count"),
        F.count_if(flag_value.isNotNull() & (flag_value != "")).alias("flag_message_count"),
    ]
    for out, entries in terms.items():
        aggs.append(reduce(lambda a, b: a + b, [hits(t) for t in entries]).alias(out))
    return messages.groupBy(*keys).agg(*aggs)


# --- joins ------------------------------------------------------------------------------------

def lookup_backfill(
    df: DataFrame, lookup: DataFrame, key: str, value: str, lookup_key: str | None = None,
    lookup_value: str | None = None,
) -> DataFrame:
    """Fills ``value`` where absent or null from one row per key of the lookup table."""
    lookup_key, lookup_value = lookup_key or key, lookup_value or value
    found = lookup.where(quoted(lookup_key).isNotNull()).groupBy(quoted(lookup_key).alias(key)).agg(
        F.min(quoted(lookup_value)).alias("_found")
    )
    own = quoted(value) if value in df.columns else F.lit(None)
    return left_join(df, found, [key]).withColumn(value, F.coalesce(own, F.col("_found"))).drop("_found")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Dimension rows, unique per key (the smallest row wins), without a sort of hot keys."""
    from lakeaudit.operators.clean import dedupe_key

    return dedupe_key(df, keys)


def star(facts: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Left joins onto de-duplicated dimensions, each given with its key columns."""
    for dim, on in dims:
        facts = left_join(facts, one_per_key(dim, on), on)
    return facts


def feature_left_join(
    base: DataFrame, features: DataFrame | None, on: list[str], one_base_row_per_key: bool = False
) -> DataFrame:
    """base ⟕ features; unchanged when there is no feature table or it lacks the keys.

    Where the keys are coarser than the base's grain, hot keys of the base are spread.
    """
    if features is None or len(present(features, on)) < len(on):
        return base
    new = [c for c in features.columns if c not in base.columns]
    features = features.select(*on, *new)
    return base.join(features, on, "left") if one_base_row_per_key else left_join(base, features, on)


def join_quality(
    base: DataFrame, features: DataFrame, keys: list[str], group: str, on: list[str] | None = None,
    notes: str = "",
) -> DataFrame:
    """What a feature join does to the base rows, from the key counts of both sides.

    ``rows_after`` shows fan-out, ``unmatched_base_rows`` base rows lost by the join (a left join
    loses none), ``base_rows_without_match`` those left with null features.
    """
    on = on or keys
    left = base.groupBy(*on).agg(F.count(F.lit(1)).alias("_base"))
    right = features.where(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    ).groupBy(*on).agg(F.count(F.lit(1)).alias("_feat"))
    joined = left.join(right, on, "left")
    without = F.col("_feat").isNull()
    return joined.agg(
        F.coalesce(F.sum("_base"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("_base") * F.coalesce("_feat", F.lit(1))), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.when(without, F.col("_base"))), F.lit(0)).alias("base_rows_without_match"),
    ).select(
        F.lit(group).alias("feature_group"), "rows_before", "rows_after",
        F.lit(0).cast("bigint").alias("unmatched_base_rows"), F.lit(0.0).alias("unmatched_pct"),
        "base_rows_without_match",
        pct(F.col("base_rows_without_match"), F.col("rows_before")).alias("without_match_pct"),
        F.lit(notes).alias("notes"),
    )


# --- guards and distributions -----------------------------------------------------------------

def duplicate_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def assert_unique_grain(df: DataFrame, keys: list[str]) -> None:
    if not duplicate_grain(df, keys).isEmpty():
        raise ValueError(f"more than one row for some {keys}")


def share_of_total(df: DataFrame, column: str, count: str = "count", share: str = "pct") -> DataFrame:
    """Count and percentage per value, null included; the window sees one row per value's group.

    The total is a scalar over the grouped counts, not a window over rows.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(column, count, pct(F.col(count), total).alias(share))


def target_distribution(df: DataFrame, target: str = "points_finish") -> DataFrame:
    return share_of_total(df, target)


def top_keys(df: DataFrame, keys: list[str], k: int = 20) -> DataFrame:
    """Most frequent keys."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), *keys).limit(k)
