"""Train/validation/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.ordered import row_rank

SPLITS = ("train", "validation", "test")


def season_split(df: DataFrame, year: str, seasons: dict[str, list[int]]) -> DataFrame:
    """Rows of the listed years with their split; other years drop out."""
    chain = None
    for split, years in seasons.items():
        hit = F.col(year).isin(*years)
        chain = F.when(hit, split) if chain is None else chain.when(hit, split)
    return df.withColumn("split", chain).where("split is not null")


def contiguous_split(
    df: DataFrame, order: list[str], train: float = 0.6, validation: float = 0.2
) -> DataFrame:
    """First 60 %, next 20 % and the rest in ``order`` (which should identify a row).

    Ranks come from range partitions and one count per partition, so no task sees all rows.
    """
    ranked = row_rank(df, order, "_rank")
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    train_end = F.floor(n * F.lit(train))
    validation_end = train_end + F.floor(n * F.lit(validation))
    split = (
        F.when(F.col("_rank") < train_end, "train")
        .when(F.col("_rank") < validation_end, "validation").otherwise("test")
    )
    return ranked.withColumn("split", split).drop("_rank")


def split_summary(df: DataFrame, year: str, target: str) -> DataFrame:
    """Seasons, rows and positives per split."""
    y = F.col(target)
    return df.groupBy("split").agg(
        F.array_join(F.array_sort(F.collect_set(F.col(year).cast("string"))), ";").alias("seasons"),
        F.count(F.lit(1)).alias("n_rows"), F.count_if(y == 1).alias("positives"),
        F.count_if(y == 0).alias("negatives"), F.round(F.avg(y.cast("double")), 4).alias("positive_rate"),
    )


def resolve_splits(
    df: DataFrame, mode: str, year: str, seasons: dict[str, list[int]], order: list[str]
) -> tuple[DataFrame, dict[str, str]]:
    """``full`` needs every season split filled; ``smoke`` falls back to a contiguous split."""
    if mode not in ("full", "smoke"):
        raise ValueError(f"unknown mode {mode!r}")
    split = season_split(df, year, seasons)
    found = {r["split"] for r in split.select("split").distinct().collect()}  # at most three
    missing = [s for s in SPLITS if s not in found]
    if not missing:
        tier = "full_evidence" if mode == "full" else "smoke_season_split"
        return split, {"split_method": "season", "evidence_tier": tier}
    if mode == "full":
        raise ValueError(f"season split leaves {missing} empty")
    return contiguous_split(df, order), {
        "split_method": "smoke_fallback", "evidence_tier": "smoke_wiring_only",
    }
