"""Classification with pyspark.ml: preprocessing, three models, scores and importances."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.columns import dtype_of, is_numeric, quoted, rows_frame
from lakeaudit.functions.durable import durable
from lakeaudit.operators.forest import RandomForest

WEIGHT = "class_weight"
#: Training rows of a task at least: every pass of a fit starts its tasks anew.
ROWS_PER_TASK = 50_000


def split_types(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    numeric = [c for c in features if is_numeric(dtype_of(df, c)) or dict(df.dtypes)[c] == "boolean"]
    return numeric, [c for c in features if c not in numeric]


def class_weight(df: DataFrame, target: str) -> Column:
    """Balanced weight n / (2 n_class) of each row, from one aggregate."""
    y = F.col(target)
    stats = df.agg(F.struct(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))).scalar()
    pos, neg = stats.getField("pos").cast("double"), stats.getField("neg").cast("double")
    own = F.when(y == 1, pos).otherwise(neg)
    return F.coalesce(F.try_divide(pos + neg, own * 2.0), F.lit(1.0))


def as_inputs(df: DataFrame, features: list[str]) -> DataFrame:
    """Numeric features as double (NaN as null), others as text."""
    numeric, text = split_types(df, features)
    exprs: dict[str, Column] = {}
    for c in numeric:
        value = quoted(c).cast("double")
        exprs[c] = F.when(F.isnan(value), None).otherwise(value)
    for c in text:
        exprs[c] = quoted(c).cast("string")
    return df.withColumns(exprs)


def usable_features(train: DataFrame, features: list[str]) -> list[str]:
    """Features with at least one value in the training rows (one aggregate)."""
    filled = train.agg(*[F.count(quoted(c)).alias(f"f{i}") for i, c in enumerate(features)]).first()
    return [c for i, c in enumerate(features) if filled[f"f{i}"] > 0]


def in_few_tasks(train: DataFrame) -> DataFrame:
    """Small tables in few partitions, without a shuffle; large ones keep theirs."""
    return train.coalesce(max(1, -(-train.count() // ROWS_PER_TASK)))


def most_frequent(df: DataFrame, text: list[str]) -> dict[str, str]:
    """Mode of each text column (the smallest on a tie); one small row per column reaches the driver.

    Values are counted map-side before they are compared.
    """
    values = df.select(*[quoted(c).alias(str(i)) for i, c in enumerate(text)]).unpivot(
        [], [str(i) for i in range(len(text))], "_place", "cell")
    counts = values.where("cell is not null").groupBy("_place", "cell").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy("_place").agg(
        F.min_by("cell", F.struct(-F.col("n"), F.col("cell"))).alias("mode")).collect()
    return {text[int(r["_place"])]: r["mode"] for r in rows}


def preprocess_stages(
    train: DataFrame, features: list[str], scale: bool
) -> tuple[list, dict[str, str]]:
    """Stages (median imputation, optional scaling, one-hot) and the modes that fill text nulls."""
    numeric, text = split_types(train, features)
    stages, inputs = [], []
    if numeric:
        filled = [f"{c}__filled" for c in numeric]
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=filled))
        stages.append(VectorAssembler(inputCols=filled, outputCol="_numeric"))
        name = "_numeric"
        if scale:
            stages.append(StandardScaler(withMean=True, withStd=True, inputCol="_numeric", outputCol="_scaled"))
            name = "_scaled"
        inputs.append(name)
    modes: dict[str, str] = {}
    if text:
        modes = most_frequent(train, text)
        for c in text:
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__index", handleInvalid="keep"))
        stages.append(OneHotEncoder(
            inputCols=[f"{c}__index" for c in text], outputCols=[f"{c}__hot" for c in text],
            dropLast=True, handleInvalid="keep",
        ))
        inputs += [f"{c}__hot" for c in text]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages, modes


def classifiers(target: str, seed: int = 42, forest_depth: int = 30) -> dict[str, object]:
    """Iteration counts, tree counts, step size and seed of the three models.

    ``forest_depth`` is the engine's own maximum, so trees end where their leaves are pure.
    """
    common = {"labelCol": target, "featuresCol": "features", "weightCol": WEIGHT}
    return {
        "logistic_regression": LogisticRegression(maxIter=1000, **common),
        "random_forest": RandomForest(numTrees=200, seed=seed, maxDepth=forest_depth, **common),
        "boosted_trees": GBTClassifier(maxIter=200, stepSize=0.05, seed=seed, maxDepth=5, **common),
    }


def fit(
    train: DataFrame, features: list[str], target: str, classifier, scale: bool
) -> tuple[PipelineModel, dict[str, str], list[str]]:
    """A classifier passes over its rows again and again, so their vectors are built once and stored."""
    train = as_inputs(train, features)
    features = usable_features(train, features)
    stages, modes = preprocess_stages(train, features, scale)
    weighted = train.fillna(modes).withColumn(WEIGHT, class_weight(train, target))
    rows = in_few_tasks(weighted)
    prepared = Pipeline(stages=stages).fit(rows)
    fitted = classifier.fit(durable(prepared.transform(rows).select("features", target, WEIGHT)))
    return PipelineModel([*prepared.stages, fitted]), modes, features


def score(
    model: PipelineModel, df: DataFrame, features: list[str], modes: dict[str, str], name: str,
    target: str, keep: list[str],
) -> DataFrame:
    prepared = PipelineModel(model.stages[:-1]).transform(as_inputs(df, features).fillna(modes))
    out = model.stages[-1].transform(prepared.select(*dict.fromkeys([*keep, target, "features"])))
    return out.select(
        *keep, F.col(target).cast("int").alias("y_true"), F.lit(name).alias("model_name"),
        F.col("prediction").cast("int").alias("y_pred"), vector_to_array("probability")[1].alias("score"),
    )


def train_all(
    split: DataFrame, features: list[str], target: str, keep: list[str], seed: int = 42,
    only: list[str] | None = None, overrides: dict[str, object] | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, PipelineModel]]:
    """Fits each model on the training rows; scores of the other splits and importances.

    Fitting passes over the rows many times, so they are materialised once on shared storage.
    """
    split = durable(split)
    train, rest = split.where("split = 'train'"), split.where("split <> 'train'")
    specs = overrides or classifiers(target, seed)
    predictions = importances = None
    models = {}
    for name, classifier in specs.items():
        if only and name not in only:
            continue
        model, modes, used = fit(train, features, target, classifier, scale=name == "logistic_regression")
        models[name] = model
        part = score(model, rest, used, modes, name, target, ["split", *[k for k in keep if k != "split"]])
        weights = feature_importance(model, name, rest, used, modes)
        predictions = part if predictions is None else predictions.unionByName(part)
        importances = weights if importances is None else importances.unionByName(weights)
    return predictions, importances, models


def _slot_names(schema, features: list[str]) -> list[str]:
    attrs = schema["features"].metadata["ml_attr"]
    found = [a for kind in attrs.get("attrs", {}).values() for a in kind]
    names = {a["idx"]: a.get("name", str(a["idx"])) for a in found}
    return [names.get(i, str(i)) for i in range(attrs["num_attrs"])]


def feature_importance(
    model: PipelineModel, name: str, df: DataFrame, features: list[str], modes: dict[str, str]
) -> DataFrame:
    """Tree importances or absolute coefficients per input slot, largest first."""
    last = model.stages[-1]
    weights = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    values = [abs(float(v)) for v in weights.toArray()]
    numeric, _ = split_types(df, features)
    prepared = PipelineModel(model.stages[:-1]).transform(as_inputs(df, features).fillna(modes).limit(0))
    slots = _slot_names(prepared.schema, features)
    labels = []
    for i, slot in enumerate(slots):
        label = numeric[i] if i < len(numeric) else slot.replace("__hot_", "=")
        labels.append(label)
    rows = sorted(zip(labels, values), key=lambda r: (-r[1], r[0]))
    return rows_frame(
        df, [(name, label, value) for label, value in rows],
        "model_name string, feature_name string, importance double",
    )


def top_importances(importances: DataFrame, k: int = 20) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "model_name", "feature_name").limit(k)
