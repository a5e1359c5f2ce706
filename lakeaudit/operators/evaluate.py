"""Baselines and classification metrics over one long prediction frame.

Predictions have (model_name, split, y_true, y_pred, score) and may carry context columns. Every
metric groups by (model_name, split), so any number of models is measured in the same jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.columns import present, quoted
from lakeaudit.functions.ordered import prefix_sums

RUN = ["model_name", "split"]
BASELINES = ("random_baseline", "heuristic_position", "majority_class")

# Bins of the first observed position in the error analysis, upper bound inclusive.
POSITION_BINS = ((0, 5, "1-5"), (5, 10, "6-10"), (10, 15, "11-15"), (15, 20, "16-20"), (20, 100, "21+"))


# --- baselines --------------------------------------------------------------------------------

Prediction = tuple[Column, Column]


def stack_predictions(df: DataFrame, models: dict[str, Prediction], keep: list[str] | None = None) -> DataFrame:
    """Long predictions of several models given as (predicted class, score), in one pass."""
    cells = [
        F.struct(
            F.lit(name).alias("model_name"), pred.cast("int").alias("y_pred"),
            value.cast("double").alias("score"),
        )
        for name, (pred, value) in models.items()
    ]
    columns = [quoted(c) for c in (keep or df.columns)]
    return df.select(*columns, F.inline(F.array(*cells)))


def uniform_draw(parts: list[Column], seed: int) -> Column:
    """A number in [0, 1) fixed by the row's key, so it survives retries and reruns."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def random_prediction(train: DataFrame, keys: list[str], target: str = "y_true", seed: int = 42) -> Prediction:
    """Positive with the training share of positives; draws differ between splits."""
    rate = train.agg(F.coalesce(F.avg(F.col(target).cast("double")), F.lit(0.0))).scalar()
    draw = uniform_draw([*[F.col(k) for k in keys], F.col("split")], seed)
    return draw < rate, rate


def heuristic_prediction(column: str = "first_observed_position", threshold: float = 10) -> Prediction:
    """Positive up to the threshold; a missing value counts as negative."""
    hit = F.coalesce(quoted(column) <= threshold, F.lit(False)).cast("int")
    return hit, hit


def majority_prediction(train: DataFrame, target: str = "y_true") -> Prediction:
    """The most frequent training class (the smaller one on a tie), scored by its share."""
    y = F.col(target)
    stats = train.agg(F.struct(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )).scalar()
    pos, neg = stats.getField("pos"), stats.getField("neg")
    share = F.try_divide(F.greatest(pos, neg).cast("double"), (pos + neg).cast("double"))
    return F.when(pos > neg, 1).otherwise(0), share


def baselines(df: DataFrame, keys: list[str], target: str = "y_true", seed: int = 42) -> dict[str, Prediction]:
    """The three baselines, fitted on the rows whose split is train."""
    train = df.where("split = 'train'")
    return {
        "random_baseline": random_prediction(train, keys, target, seed),
        "heuristic_position": heuristic_prediction(),
        "majority_class": majority_prediction(train, target),
    }


# --- metrics ----------------------------------------------------------------------------------

def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _cells_by_score(pred: DataFrame) -> DataFrame:
    """Outcome counts per run and score: all that the metrics need, in one grouping."""
    y, p = F.col("y_true"), F.col("y_pred")
    return pred.groupBy(*RUN, "score").agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & F.col("score").isNotNull()).alias("pos"),
        F.count_if((y == 0) & F.col("score").isNotNull()).alias("neg"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _auc_columns() -> Column:
    """Rank AUC with ties: pairs won, half for equal scores, over all pairs."""
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    return F.try_divide(F.sum(wins), pairs).alias("roc_auc")


def _placed(pred: DataFrame) -> DataFrame:
    # running totals over range partitions of (run, score): no task sorts all scores
    return prefix_sums(_cells_by_score(pred), RUN, ["score"], ["pos", "neg"])


def roc_auc(pred: DataFrame) -> DataFrame:
    """Rank AUC per run; null where only one class occurs."""
    return _placed(pred).groupBy(*RUN).agg(_auc_columns())


def class_metrics(pred: DataFrame, with_auc: bool = True) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 where undefined), AUC and class shares per run."""
    by_score = _placed(pred) if with_auc else _cells_by_score(pred)
    auc = _auc_columns() if with_auc else F.lit(None).cast("double").alias("roc_auc")
    cells = by_score.groupBy(*RUN).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "n_rows")], auc
    )
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n_rows"))
    return cells.select(
        *RUN, F.round(_ratio(tp + tn, n), 4).alias("accuracy"),
        F.round(_ratio(tp, tp + fp), 4).alias("precision"), F.round(_ratio(tp, tp + fn), 4).alias("recall"),
        F.round(_ratio(tp * 2, tp * 2 + fp + fn), 4).alias("f1"), F.round("roc_auc", 4).alias("roc_auc"),
        F.round(_ratio(tp + fn, n), 4).alias("positive_rate_true"),
        F.round(_ratio(tp + fp, n), 4).alias("positive_rate_pred"), "n_rows",
    )


def confusion_long(pred: DataFrame) -> DataFrame:
    """All four (actual, predicted) cells per run, empty ones with 0."""
    y, p = F.col("y_true"), F.col("y_pred")
    pairs = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = pred.groupBy(*RUN).agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a, b in pairs]
    )
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("count"))
        for a, b in pairs
    ]
    return counts.select(*RUN, F.inline(F.array(*cells)))


def position_bin(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for low, high, name in reversed(POSITION_BINS):
        inside = (value >= low if low == 0 else value > low) & (value <= high)
        out = F.when(inside, name).otherwise(out)
    return out


def error_analysis(
    pred: DataFrame, group_columns: tuple[str, ...] = ("team_name", "circuit_short_name", "session_year"),
    position: str = "first_observed_position",
) -> DataFrame:
    """False positives and negatives by context value (null included) and by position bin.

    Bins without errors appear with 0 for every run that has errors.
    """
    kind = (
        F.when((F.col("y_true") == 0) & (F.col("y_pred") == 1), "false_positive")
        .when((F.col("y_true") == 1) & (F.col("y_pred") == 0), "false_negative")
    )
    names = present(pred, group_columns)
    binned = position in pred.columns
    errors = pred.withColumn("error_type", kind).where("error_type is not null").select(
        *RUN, "error_type", *[quoted(c).cast("string").alias(c) for c in names],
        (position_bin(quoted(position).try_cast("double")) if binned else F.lit(None).cast("string")).alias("_bin"),
    )
    # one scan: count combinations, then list each once per group column
    combined = errors.groupBy(*RUN, "error_type", *names, "_bin").agg(F.count(F.lit(1)).alias("_n"))

    def cell(error_type: Column, column: str, value: Column, count: Column) -> Column:
        return F.struct(
            error_type.alias("error_type"), F.lit(column).alias("group_column"),
            value.alias("group_value"), count.alias("count"),
        )

    own, zero = F.col("error_type"), F.lit(0).cast("bigint")
    cells = [cell(own, c, quoted(c), F.col("_n")) for c in names]
    if binned:
        cells.append(cell(own, "_position_bin", F.col("_bin"), F.col("_n")))
        cells += [
            cell(F.lit(k), "_position_bin", F.lit(b[2]), zero)
            for k in ("false_positive", "false_negative") for b in POSITION_BINS
        ]
    return combined.select(*RUN, F.inline(F.array(*cells))).groupBy(
        *RUN, "error_type", "group_column", "group_value"
    ).agg(F.sum("count").alias("count"))


def error_summary(errors: DataFrame, group_column: str = "session_year") -> DataFrame:
    """Errors per run and type. Each error is listed once per group column, so one is summed."""
    return errors.where(F.col("group_column") == group_column).groupBy(*RUN, "error_type").agg(
        F.sum("count").alias("count")
    )
