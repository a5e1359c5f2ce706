"""Splits, baselines, metrics, governance, models and closing reports."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakeaudit.functions.durable import durable
from lakeaudit.operators import checks, evaluate, features as feat, govern, model, profile, report, split
from lakeaudit.plans.race import CATALOG
from workload import mart as mart_queries
from workload.audits import MART_COLUMNS, MART_MISSING
from workload.common import stable_doubles, table

SEASONS = {"train": [1995, 1996, 1997], "validation": [1998, 1999], "test": [2000, 2001]}
KEYS = ["session_key"]
CONTEXT = ["team_name", "circuit_short_name", "session_year", "first_observed_position"]


# --- rows to evaluate -------------------------------------------------------------------------

def _split_orders(spark, sf_dir):
    return split.season_split(mart_queries.base(spark, sf_dir), "session_year", SEASONS)


def _eval_rows(spark, sf_dir):
    """Split orders with the customer's segment and first observed position."""
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driver_number"), F.col("c_mktsegment").alias("team_name"))
    first = feat.position_features(
        mart_queries._events(spark, sf_dir), ["driver_number"], "ts", "value", ["event_id"])
    people = feat.feature_left_join(
        people, first.select("driver_number", "first_observed_position"), ["driver_number"])
    rows = feat.feature_left_join(_split_orders(spark, sf_dir), people, ["driver_number"])
    keep = ["session_key", "split", *CONTEXT]
    return rows.select(*keep, F.col("points_finish").alias("y_true"), "final_position", "o_orderdate")


def _predictions(spark, sf_dir):
    """The three baselines and a score with few ties: days since 1995 plus priority."""
    rows = _eval_rows(spark, sf_dir)
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    models = evaluate.baselines(_split_orders(spark, sf_dir), KEYS, "points_finish")
    models["date_score"] = (days > 1200, days + F.col("final_position") / 10.0)
    return evaluate.stack_predictions(rows, models)


def _baseline(name):
    def run(spark, sf_dir):
        models = evaluate.baselines(_split_orders(spark, sf_dir), KEYS, "points_finish")
        out = evaluate.stack_predictions(_eval_rows(spark, sf_dir), {name: models[name]})
        return out.select(
            "session_key", "split", "model_name", "y_true", "y_pred", F.round("score", 6).alias("score"))
    return run


def season_split(spark, sf_dir):
    return _split_orders(spark, sf_dir).select("session_key", "session_year", "split")


def split_summary(spark, sf_dir):
    return split.split_summary(_split_orders(spark, sf_dir), "session_year", "points_finish")


def contiguous_split(spark, sf_dir):
    rows = mart_queries.base(spark, sf_dir).select("session_key", "o_orderdate")
    out = split.contiguous_split(rows, ["o_orderdate", "session_key"])
    return out.select("session_key", "split")


def class_metrics(spark, sf_dir):
    return evaluate.class_metrics(_predictions(spark, sf_dir))


def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(_predictions(spark, sf_dir)).withColumn("roc_auc", F.round("roc_auc", 6))


def confusion_long(spark, sf_dir):
    return evaluate.confusion_long(_predictions(spark, sf_dir))


def error_analysis(spark, sf_dir):
    return evaluate.error_analysis(_predictions(spark, sf_dir))


def error_summary(spark, sf_dir):
    return evaluate.error_summary(evaluate.error_analysis(_predictions(spark, sf_dir)))


def metrics_pivot(spark, sf_dir):
    metrics = evaluate.class_metrics(_predictions(spark, sf_dir), with_auc=False)
    return report.metric_by_model(metrics)


def metric_reports(spark, sf_dir):
    """Validation and test metrics as one table, the split column added where it is absent."""
    metrics = evaluate.class_metrics(_predictions(spark, sf_dir), with_auc=False).drop("roc_auc")
    validation = metrics.where("split = 'validation'").drop("split")
    return report.validation_test_metrics(validation, metrics.where("split = 'test'"))


def confusion_grid(spark, sf_dir):
    return report.confusion_grid(confusion_long(spark, sf_dir), "heuristic_position", "test")


# --- mart checks ------------------------------------------------------------------------------

def target_distribution(spark, sf_dir):
    return feat.target_distribution(mart_queries.mart(spark, sf_dir))


def share_of_total(spark, sf_dir):
    return feat.share_of_total(table(spark, sf_dir, "events"), "event_type")


def top_keys(spark, sf_dir):
    return feat.top_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def duplicate_grain(spark, sf_dir):
    return feat.duplicate_grain(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _gold_query(name):
    return lambda spark, sf_dir: checks.gold_checks(mart_queries.mart(spark, sf_dir))[name]


def _silver(spark, sf_dir):
    labels = mart_queries.base(spark, sf_dir).select(
        "session_key", "driver_number", F.col("result_points").alias("points"))
    laps = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "session_key")
    pit = laps.where("l_returnflag = 'R'")
    weather = table(spark, sf_dir, "events").withColumnRenamed("user_id", "session_key")
    return checks.silver_checks({
        "session_result": labels, "laps": laps, "pit": pit, "weather": weather, "starting_grid": None})


def _silver_query(name):
    return lambda spark, sf_dir: _silver(spark, sf_dir)[name]


def skipped_check(spark, sf_dir):
    """The same check on a table that has its column and on one that lacks it."""
    query = "select 'labels' as report, count(points) as labelled_rows from {t}"
    orders = table(spark, sf_dir, "orders")
    labels = orders.withColumn("points", F.col("o_totalprice"))
    ran = checks.guarded(labels, "labels", ["points"], query)
    return ran.unionByName(checks.guarded(orders, "orders", ["points"], query), allowMissingColumns=True)


# --- governance -------------------------------------------------------------------------------

def leakage_guard(spark, sf_dir):
    """The guard, next to how empty each column is."""
    mart = mart_queries.mart(spark, sf_dir)
    missing = profile.null_counts(mart, "gold").select("column_name", "missing_count")
    return govern.leakage_guard(mart, CATALOG).join(missing, "column_name")


def feature_dictionary(spark, sf_dir):
    out = govern.feature_dictionary(mart_queries.mart(spark, sf_dir), CATALOG)
    return out.drop("description", "dtype")


def feature_plan(spark, sf_dir):
    """The plan with the missing share of each planned column in the mart."""
    plan = govern.feature_plan(spark, CATALOG).drop("reason")
    missing = profile.null_counts(mart_queries.mart(spark, sf_dir), "gold").select(
        F.col("column_name").alias("feature_name"), "missing_pct")
    return plan.join(missing, "feature_name", "left")


def feature_group_summary(spark, sf_dir):
    out = govern.feature_group_summary(govern.feature_dictionary(mart_queries.mart(spark, sf_dir), CATALOG))
    return stable_doubles(out)


def leaked_features(spark, sf_dir):
    """A dictionary that wrongly allows everything: outcomes and the target are caught."""
    out = govern.feature_dictionary(mart_queries.mart(spark, sf_dir), CATALOG)
    wrong = out.withColumn("allowed_for_modeling", F.lit(True))
    return govern.leaked_features(wrong, CATALOG).select("feature_name", "missing_pct")


# --- models -----------------------------------------------------------------------------------

MODELS = ("logistic_regression", "random_forest", "boosted_trees")
MODEL_CONTEXT = ["session_key", "team_name", "circuit_short_name", "session_year"]


def _model_rows(spark, sf_dir):
    mart = mart_queries.mart(spark, sf_dir)
    names = govern.resolve_features(CATALOG, plan=govern.feature_plan(spark, CATALOG))
    chosen = govern.select_features(mart, names, "points_finish", keep=tuple(MODEL_CONTEXT))
    return split.season_split(chosen, "session_year", SEASONS), names + ["team_name"]


def _sized(name: str):
    """Fewer rounds than the library's defaults, for checks only; the queries themselves fit in full."""
    common = {"labelCol": "points_finish", "featuresCol": "features", "weightCol": model.WEIGHT}
    return {
        "logistic_regression": LogisticRegression(maxIter=50, **common),
        "random_forest": RandomForestClassifier(numTrees=20, seed=42, maxDepth=6, **common),
        "boosted_trees": GBTClassifier(maxIter=10, stepSize=0.05, seed=42, maxDepth=4, **common),
    }[name]


def _trained(spark, sf_dir, name, overrides=None):
    """Scores and importances of one model, at the library's own settings unless others are given."""
    rows, names = _model_rows(spark, sf_dir)
    scored, importances, _ = model.train_all(
        rows, names, "points_finish", MODEL_CONTEXT, only=[name], overrides=overrides)
    return scored, importances


def _model_metrics(name):
    # the metrics pass over the scores more than once
    return lambda spark, sf_dir: evaluate.class_metrics(durable(_trained(spark, sf_dir, name)[0]))


def _from_confusion(scored):
    """Accuracy, precision, recall, f1 and the positive rate of every split, from its confusion counts."""
    def n(y, p):
        return F.coalesce(F.sum(F.when((F.col("y_true") == y) & (F.col("y_pred") == p), 1)), F.lit(0))

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn, tn = n(1, 1), n(0, 1), n(1, 0), n(0, 0)
    return scored.groupBy("split").agg(
        F.array(share(tp + tn, tp + fp + fn + tn), share(tp, tp + fp), share(tp, tp + fn), share(2 * tp, 2 * tp + fp + fn),
                share(tp + fp, tp + fp + fn + tn)).alias("counted"),
        F.bool_and(F.col("score").between(0, 1)).alias("scores_hold"))


def _model_check(name):
    """What SQL can say of a model's metrics: rows, base rates, bounds, and metrics that follow from the confusion counts."""
    def run(spark, sf_dir):
        # the forest is checked as its query grows it, the others with fewer rounds
        scored = durable(_trained(spark, sf_dir, name, None if name == "random_forest" else {name: _sized(name)})[0])
        given = ("accuracy", "precision", "recall", "f1", "positive_rate_pred")
        holds = [F.col(c).between(0, 1) for c in (*given, "roc_auc")]
        holds += [F.abs(F.col(c) - F.col("counted")[i]) <= 0.0001 for i, c in enumerate(given)]
        return evaluate.class_metrics(scored).join(_from_confusion(scored), "split").select(
            "model_name", "split", "n_rows", "positive_rate_true", "scores_hold",
            reduce(lambda a, b: a & b, holds).alias("shares_hold"))
    return run


def preprocess(spark, sf_dir):
    """Imputed, scaled and one-hot encoded inputs of every order: two scaled values and the team's place."""
    from pyspark.ml import Pipeline

    rows, names = _model_rows(spark, sf_dir)
    rows = durable(rows)
    train = model.as_inputs(rows.where("split = 'train'"), names)
    names = model.usable_features(train, names)
    stages, modes = model.preprocess_stages(train, names, scale=True)
    fitted = Pipeline(stages=stages).fit(train.fillna(modes))
    out = fitted.transform(model.as_inputs(rows, names).fillna(modes))
    numeric, text = model.split_types(train, names)
    cells = vector_to_array("features")
    return out.select("session_key", "split", *[
        F.round(cells[numeric.index(c)] + 1e-7, 4).alias(c) for c in ("lap_count", "pit_stop_count")
    ], *[F.aggregate(F.slice(cells, len(numeric) + 1, F.size(cells) - len(numeric)), F.lit(0.0), lambda a, x: a + x).alias("team_name")])


def feature_importance(spark, sf_dir):
    return model.top_importances(_trained(spark, sf_dir, "random_forest")[1])


def feature_importance_check(spark, sf_dir):
    _, importances = _trained(spark, sf_dir, "random_forest", {"random_forest": _sized("random_forest")})
    top = model.top_importances(importances)
    whole = importances.agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("sum_holds"), F.bool_and(F.col("importance") >= 0).alias("signs_hold"))
    return top.groupBy("model_name").agg(F.count(F.lit(1)).alias("listed")).withColumns({
        "sum_holds": whole.select("sum_holds").scalar(), "signs_hold": whole.select("signs_hold").scalar()})


def class_weights(spark, sf_dir):
    rows = _split_orders(spark, sf_dir).where("split = 'train'")
    weighted = rows.withColumn("class_weight", model.class_weight(rows, "points_finish"))
    return weighted.groupBy("points_finish").agg(
        F.round(F.max("class_weight"), 6).alias("class_weight"), F.count(F.lit(1)).alias("n_rows"))


# --- checks -----------------------------------------------------------------------------------

ROWS_SQL = f"""
{mart_queries.EVENTS_CTE},
orders_split as (
  select o_orderkey as session_key, o_custkey as driver_number, o_orderdate,
         cast(substr(o_orderpriority, 1, 1) as bigint) as final_position,
         o_orderpriority as circuit_short_name, cast(year(o_orderdate) as bigint) as session_year,
         case when round(o_totalprice - 250000, 2) > 0 then 1 else 0 end as y_true,
         case when year(o_orderdate) <= 1997 then 'train' when year(o_orderdate) <= 1999 then 'validation'
              else 'test' end as split
  from orders where year(o_orderdate) between 1995 and 2001
),
eval_rows as (
  select o.*, c_mktsegment as team_name, first_observed_position
  from orders_split o left join customer on driver_number = c_custkey
  left join pos on pos.driver_number = c_custkey
),
train as (select avg(y_true) as rate, count(*) filter (where y_true = 1) as pos,
                 count(*) filter (where y_true = 0) as neg from eval_rows where split = 'train'),
p_random as (
  select e.*, 'random_baseline' as model_name, rate as score,
         cast(cast('0x' || substr(md5(session_key || '|' || split || '|42'), 1, 8) as bigint) / 4294967296.0 < rate as integer) as y_pred
  from eval_rows e, train
),
p_heuristic as (
  select *, 'heuristic_position' as model_name,
         cast(coalesce(first_observed_position <= 10, false) as integer)::double as score,
         cast(coalesce(first_observed_position <= 10, false) as integer) as y_pred from eval_rows
),
p_majority as (
  select e.*, 'majority_class' as model_name, greatest(pos, neg) / (pos + neg)::double as score,
         case when pos > neg then 1 else 0 end as y_pred from eval_rows e, train
),
p_date as (
  select *, 'date_score' as model_name,
         date_diff('day', date '1995-01-01', cast(o_orderdate as date)) + final_position / 10.0::double as score,
         cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) > 1200 as integer) as y_pred
  from eval_rows
),
predictions as (
  select model_name, split, y_true, y_pred, score, team_name, circuit_short_name, session_year,
         first_observed_position from p_random
  union all select model_name, split, y_true, y_pred, score, team_name, circuit_short_name, session_year,
         first_observed_position from p_heuristic
  union all select model_name, split, y_true, y_pred, score, team_name, circuit_short_name, session_year,
         first_observed_position from p_majority
  union all select model_name, split, y_true, y_pred, score, team_name, circuit_short_name, session_year,
         first_observed_position from p_date
),
ranked as (
  select *, rank() over (partition by model_name, split order by score)
          + (count(*) over (partition by model_name, split, score) - 1) / 2.0 as r
  from predictions
),
auc as (
  select model_name, split,
         case when sum(y_true) > 0 and sum(y_true) < count(*) then
           (sum(r) filter (where y_true = 1) - sum(y_true) * (sum(y_true) + 1) / 2.0)
             / (sum(y_true) * (count(*) - sum(y_true)))::double end as roc_auc
  from ranked group by 1, 2
),
cells as (
  select model_name, split, count(*) as n_rows, count(*) filter (where y_true = 1 and y_pred = 1) as tp,
         count(*) filter (where y_true = 0 and y_pred = 1) as fp,
         count(*) filter (where y_true = 1 and y_pred = 0) as fn,
         count(*) filter (where y_true = 0 and y_pred = 0) as tn
  from predictions group by 1, 2
),
metrics as (
  select model_name, split, round((tp + tn) / n_rows::double, 4) as accuracy,
         round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 4) as "precision",
         round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 4) as recall,
         round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), 4) as f1,
         round(roc_auc, 4) as roc_auc, round((tp + fn) / n_rows::double, 4) as positive_rate_true,
         round((tp + fp) / n_rows::double, 4) as positive_rate_pred, n_rows
  from cells join auc using (model_name, split)
),
errors as (
  select *, case when y_true = 0 then 'false_positive' else 'false_negative' end as error_type,
         case when first_observed_position < 0 then null when first_observed_position <= 5 then '1-5'
              when first_observed_position <= 10 then '6-10' when first_observed_position <= 15 then '11-15'
              when first_observed_position <= 20 then '16-20' when first_observed_position <= 100 then '21+' end as bin
  from predictions where y_true <> y_pred
),
bins as (
  select model_name, split, error_type, bin
  from (select distinct model_name, split from errors),
       (values ('false_positive'), ('false_negative')) k(error_type),
       (values ('1-5'), ('6-10'), ('11-15'), ('16-20'), ('21+')) b(bin)
)
"""
CONFUSION_SQL = " union all ".join(
    f"select model_name, split, {a} as actual, {p} as predicted, {c} as count from cells"
    for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")))
ERRORS_SQL = " union all ".join(
    f"select model_name, split, error_type, '{c}' as group_column, cast({c} as varchar) as group_value, "
    f"count(*) as count from errors group by 1, 2, 3, 5"
    for c in ("team_name", "circuit_short_name", "session_year")
) + """
  union all select model_name, split, error_type, '_position_bin', bin, count(*) from errors
  where bin is null group by 1, 2, 3, 5
  union all select b.model_name, b.split, b.error_type, '_position_bin', b.bin, count(e.bin)
  from bins b left join errors e on b.model_name = e.model_name and b.split = e.split
    and b.error_type = e.error_type and b.bin = e.bin group by 1, 2, 3, 5"""


def _baseline_sql(rel, digits=True):
    value = "round(score, 6)" if digits else "score"
    return f"with {ROWS_SQL} select session_key, split, model_name, y_true, y_pred, {value} as score from {rel}"


def _role(c):
    """(risk, allowed) by the order in which roles decide."""
    if c in ("session_key", "meeting_key", "driver_number"):
        return "none", False, "grain key"
    if c == "points_finish":
        return "target", False, "the label itself"
    if c.startswith("diagnostic_") or c in CATALOG.forbidden:
        return "high", False, "known only after the event"
    if c in CATALOG.metadata:
        return "low", False, "descriptive; encode on purpose if wanted"
    return "low", True, "engineered feature"


GROUP_OF = {
    "identifiers": ["session_key", "meeting_key", "driver_number"], "target": ["points_finish"],
    "diagnostic_outcome": ["final_position", "result_points", "result_dnf", "result_dns", "result_dsq",
                           "diagnostic_final_observed_position"],
    "metadata": list(CATALOG.metadata), "laps": mart_queries.LAP_DOUBLES + ["lap_count", "pit_out_lap_count"],
    "pit": mart_queries.PIT_DOUBLES + ["first_pit_lap", "pit_stop_count", "early_pit_stop_flag"],
    "position": ["first_observed_position", "early_avg_position", "early_min_position", "early_max_position",
                 "position_observation_count", "position_total_observation_count"],
    "weather": mart_queries.WEATHER_DOUBLES + ["rainfall_flag"], "race_control": mart_queries.MSG_COUNTS,
}
SOURCE_OF = {**CATALOG.sources, "engineered": "gold_mart"}


def _group(c):
    return next(g for g, names in GROUP_OF.items() if c in names)


def _tier(c):
    return "tier1_early" if c in CATALOG.tier1 else "tier2_full_session" if c in CATALOG.tier2 else "none"


def _dictionary_values():
    rows = []
    for c in MART_COLUMNS:
        risk, allowed, _ = _role(c)
        group = _group(c)
        role = {"identifiers": "identifier", "target": "target", "diagnostic_outcome": "diagnostic_outcome",
                "metadata": "metadata"}.get(group, "predictive_feature")
        rows.append(f"('{c}', '{group}', '{_tier(c)}', '{SOURCE_OF[group]}', '{role}', {str(allowed).lower()})")
    return ", ".join(rows)


DICTIONARY_SQL = f"""
dictionary as (
  select d.feature_name, feature_group, feature_tier, source_table, modeling_role, allowed_for_modeling, missing_pct
  from (values {_dictionary_values()}) d(feature_name, feature_group, feature_tier, source_table, modeling_role,
       allowed_for_modeling) join ({MART_MISSING}) m on m.column_name = d.feature_name
)"""


def _plan_values():
    rows = []
    for c in CATALOG.identifiers:
        rows.append((c, "none", "identifiers", "false", "false"))
    rows.append(("points_finish", "none", "target", "false", "false"))
    for c in CATALOG.diagnostics:
        rows.append((c, "none", "diagnostic_outcome", "false", "false"))
    for c in CATALOG.default_numeric:
        rows.append((c, _tier(c), _group(c), "true", "true"))
    for c in CATALOG.metadata:
        rows.append((c, "none", "metadata", "false", str(c in CATALOG.optional_categoricals).lower()))
    return ", ".join(f"('{c}', '{t}', '{g}', {d}, {a})" for c, t, g, d, a in rows)


GOLD_CHECKS = ("row_count", "duplicate_grain", "target_distribution", "target_by_team_name",
               "target_by_circuit_short_name", "missingness")
SILVER_CHECKS = ("table_inventory", "target_support", "duplicate_label_keys", "laps_rows_by_session_key",
                 "pit_rows_by_session_key", "weather_rows_by_session_key")


def _top_sql(rel, key, where=""):
    return f"""select {key} as session_key, count(*) as row_count from {rel} {where} group by 1
               order by row_count desc, session_key limit 20"""


QUERIES = {
    "season_split": season_split,
    "split_summary": split_summary,
    "contiguous_split": contiguous_split,
    "random_baseline": _baseline("random_baseline"),
    "heuristic_baseline": _baseline("heuristic_position"),
    "majority_baseline": _baseline("majority_class"),
    "class_metrics": class_metrics,
    "roc_auc": roc_auc,
    "confusion_long": confusion_long,
    "error_analysis": error_analysis,
    "error_summary": error_summary,
    "metrics_pivot": metrics_pivot,
    "metric_reports": metric_reports,
    "confusion_grid": confusion_grid,
    "target_distribution": target_distribution,
    "share_of_total": share_of_total,
    "top_keys": top_keys,
    "duplicate_grain": duplicate_grain,
    **{f"check_gold_{n}": _gold_query(n) for n in GOLD_CHECKS},
    **{f"check_silver_{n}": _silver_query(n) for n in SILVER_CHECKS},
    "check_skipped_columns": skipped_check,
    "leakage_guard": leakage_guard,
    "feature_dictionary": feature_dictionary,
    "feature_plan": feature_plan,
    "feature_group_summary": feature_group_summary,
    "leaked_features": leaked_features,
    "class_weights": class_weights,
    "preprocess": preprocess,
    **{f"{name}_check": _model_check(name) for name in MODELS},
    "feature_importance_check": feature_importance_check,
}

#: Trained models: SQL cannot say their results; the queries named ..._check hold what it can.
UNCHECKED = {**{name: _model_metrics(name) for name in MODELS}, "feature_importance": feature_importance}

ORACLES = {
    "season_split": f"with {ROWS_SQL} select session_key, session_year, split from orders_split",
    "split_summary": f"""
        with {ROWS_SQL} select split, string_agg(distinct session_year::varchar, ';' order by session_year::varchar) as seasons,
          count(*) as n_rows, count(*) filter (where y_true = 1) as positives,
          count(*) filter (where y_true = 0) as negatives, round(avg(y_true), 4) as positive_rate
        from orders_split group by split""",
    "contiguous_split": """
        select o_orderkey as session_key,
               case when r <= floor(n * 0.6) then 'train'
                    when r <= floor(n * 0.6) + floor(n * 0.2) then 'validation' else 'test' end as split
        from (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as r,
                     count(*) over () as n from orders)""",
    "random_baseline": _baseline_sql("p_random"),
    "heuristic_baseline": _baseline_sql("p_heuristic", False),
    "majority_baseline": _baseline_sql("p_majority"),
    "class_metrics": f"with {ROWS_SQL} select * from metrics",
    **{f"{name}_check": f"""
        with {ROWS_SQL} select '{name}' as model_name, split, count(*) as n_rows, round(avg(y_true), 4) as positive_rate_true,
               true as scores_hold, true as shares_hold from eval_rows where split <> 'train' group by split"""
       for name in MODELS},
    "feature_importance_check": "select 'random_forest' as model_name, cast(20 as bigint) as listed, true as sum_holds, true as signs_hold",
    "preprocess": f"""
        with {mart_queries.MART_CTE}, parts as (
          select session_key, lap_count, pit_stop_count,
                 case when session_year <= 1997 then 'train' when session_year <= 1999 then 'validation' else 'test' end as split
          from mart where session_year between 1995 and 2001),
        s as (select avg(lap_count) as m1, stddev_samp(lap_count) as s1, avg(pit_stop_count) as m2,
                     stddev_samp(pit_stop_count) as s2 from parts where split = 'train')
        select session_key, split, round((lap_count - m1) / s1 + 1e-7, 4) as lap_count,
               round((pit_stop_count - m2) / s2 + 1e-7, 4) as pit_stop_count, 1.0::double as team_name from parts, s""",
    "roc_auc": f"with {ROWS_SQL} select model_name, split, round(roc_auc, 6) as roc_auc from auc",
    "confusion_long": f"with {ROWS_SQL} {CONFUSION_SQL}",
    "error_analysis": f"with {ROWS_SQL} {ERRORS_SQL}",
    "error_summary": f"with {ROWS_SQL} select model_name, split, error_type, count(*) as count from errors group by 1, 2, 3",
    "metrics_pivot": f"""
        with {ROWS_SQL} select model_name, max(f1) filter (where split = 'validation') as validation,
          max(f1) filter (where split = 'test') as test from metrics group by 1""",
    "metric_reports": f"with {ROWS_SQL} select * exclude (roc_auc) from metrics where split <> 'train'",
    "confusion_grid": f"""
        with {ROWS_SQL}, c as ({CONFUSION_SQL})
        select actual, cast(sum(count) filter (where predicted = 0) as bigint) as predicted_0,
               cast(sum(count) filter (where predicted = 1) as bigint) as predicted_1
        from c where model_name = 'heuristic_position' and split = 'test' group by actual""",
    "target_distribution": f"""
        with {mart_queries.MART_CTE} select points_finish, count(*) as count,
          round(count(*) * 100.0::double / sum(count(*)) over (), 4) as pct from mart group by 1""",
    "share_of_total": """
        select event_type, count(*) as count, round(count(*) * 100.0::double / sum(count(*)) over (), 4) as pct
        from events group by 1""",
    "top_keys": """
        select l_orderkey, count(*) as row_count from lineitem group by 1 order by 2 desc, 1 limit 20""",
    "duplicate_grain": """
        select l_orderkey, l_linenumber, count(*) as duplicate_count from lineitem group by 1, 2 having count(*) > 1""",
    "check_gold_row_count": "select count(*) as row_count from orders",
    "check_gold_duplicate_grain": f"""
        with {mart_queries.MART_CTE} select session_key, meeting_key, driver_number, count(*) as duplicate_count
        from mart group by 1, 2, 3 having count(*) > 1""",
    "check_gold_target_distribution": f"""
        with {mart_queries.MART_CTE} select points_finish, count(*) as count,
          round(count(*) * 100.0::double / sum(count(*)) over (), 4) as pct from mart group by 1""",
    "check_gold_target_by_team_name": f"""
        with {mart_queries.MART_CTE} select team_name, points_finish, count(*) as count from mart
        where team_name is not null group by 1, 2""",
    "check_gold_target_by_circuit_short_name": f"""
        with {mart_queries.MART_CTE} select circuit_short_name, points_finish, count(*) as count from mart
        where circuit_short_name is not null group by 1, 2""",
    "check_gold_missingness": f"with {mart_queries.MART_CTE} {MART_MISSING}",
    "check_silver_table_inventory": """
        select 'session_result' as table_name, count(*) as row_count, 'ok' as status from orders
        union all select 'laps', count(*), 'ok' from lineitem
        union all select 'pit', count(*), 'ok' from lineitem where l_returnflag = 'R'
        union all select 'weather', count(*), 'ok' from events
        union all select 'starting_grid', null, 'missing'""",
    "check_silver_target_support": """
        select count(*) as total_rows, count(*) filter (where round(o_totalprice - 250000, 2) > 0) as positive_rows,
          round(100.0::double * count(*) filter (where round(o_totalprice - 250000, 2) > 0) / nullif(count(*), 0), 4)
            as positive_pct from orders""",
    "check_silver_duplicate_label_keys": """
        select o_orderkey as session_key, o_custkey as driver_number, count(*) as duplicate_count
        from orders group by 1, 2 having count(*) > 1""",
    "check_silver_laps_rows_by_session_key": _top_sql("lineitem", "l_orderkey"),
    "check_silver_pit_rows_by_session_key": _top_sql("lineitem", "l_orderkey", "where l_returnflag = 'R'"),
    "check_silver_weather_rows_by_session_key": _top_sql("events", "user_id"),
    "check_skipped_columns": """
        select 'labels' as report, count(o_totalprice) as labelled_rows, cast(null as varchar) as status,
               cast(null as varchar) as missing_columns from orders
        union all select 'orders', null, 'skipped_missing_columns', 'points'""",
    "leakage_guard": f"with {mart_queries.MART_CTE} select g.*, missing_count from (values " + ", ".join(
        f"('{c}', '{_role(c)[0]}', {str(_role(c)[1]).lower()}, '{_role(c)[2]}')" for c in MART_COLUMNS)
        + f") g(column_name, leakage_risk, allowed_for_modeling, reason) join ({MART_MISSING}) using (column_name)",
    "feature_dictionary": f"with {mart_queries.MART_CTE}, {DICTIONARY_SQL} select * from dictionary",
    "feature_plan": f"""
        with {mart_queries.MART_CTE} select p.*, missing_pct
        from (values {_plan_values()}) p(feature_name, feature_tier, feature_group, default_include, allowed_for_modeling)
        left join ({MART_MISSING}) m on m.column_name = p.feature_name""",
    "feature_group_summary": f"""
        with {mart_queries.MART_CTE}, {DICTIONARY_SQL}
        select feature_group, count(*) as feature_count,
               count(*) filter (where allowed_for_modeling) as allowed_for_modeling_count,
               round(avg(missing_pct) + 1e-7, 4) as avg_missing_pct from dictionary group by 1""",
    "leaked_features": f"""
        with {mart_queries.MART_CTE}, {DICTIONARY_SQL} select feature_name, missing_pct from dictionary
        where feature_group in ('target', 'diagnostic_outcome')""",
    "class_weights": f"""
        with {ROWS_SQL} select y_true as points_finish, n_rows,
               round(sum(n_rows) over () / (2.0::double * n_rows), 6) as class_weight
        from (select y_true, count(*) as n_rows from orders_split where split = 'train' group by 1)""",
}
