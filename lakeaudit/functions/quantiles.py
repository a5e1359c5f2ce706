"""Exact (linearly interpolated) quantiles without holding a column or a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.ordered import prefix_sums


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def placed_counts(counts: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(group, value, _n) rows with the number of values before each and in its group."""
    return prefix_sums(counts, groups, [value], ["_n"])


def quantile_columns(value: str, probs: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates over placed counts, and the quantiles computed from them and ``_size``.

    For probability p over n values the answer lies between 0-based ranks floor((n-1)p) and
    ceil((n-1)p). Running counts give each distinct value its rank interval, so the two values
    are picked by comparison and the aggregate keeps two numbers per probability.
    """
    size, first = F.col("_n_total"), F.col("_n_before")
    after = first + F.col("_n")
    picks, results = [], []
    for name, p in probs.items():
        place = (size - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            inside = (first <= rank) & (rank < after)
            picks.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
        at = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picks, results


def quantiles_from_counts(
    counts: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Quantiles per group from (group, value, _n) rows; one output column per entry of probs."""
    picks, results = quantile_columns(value, probs)
    placed = placed_counts(counts, groups, value)
    picked = placed.groupBy(*groups).agg(F.max("_n_total").alias("_size"), *picks)
    return picked.select(*groups, *results)


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    return quantiles_from_counts(value_counts(df, groups, value), groups, value, probs)
