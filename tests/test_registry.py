"""Registered queries: every SQL check at the smallest scale, and properties of the plans."""

import pytest

import __spark_entry__ as entry
from lakeaudit.operators import forest
from tests.compare import connect, differences
from workload import evaluation, registry as own

SF = "/root/testdata/sf0.001"
CHECKED = sorted(own.ORACLES)  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_check_has_a_query():
    assert set(CHECKED) <= set(own.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(own.QUERIES) == set(CHECKED)


@pytest.mark.parametrize("name", CHECKED)
def test_result(spark, con, name):
    assert differences(own.QUERIES[name](spark, SF), con, own.ORACLES[name]) == []


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "order_feature_mart", "clean_table", "clean_rules_log", "missingness", "numeric_summary", "fk_suite",
    "reconcile", "class_metrics", "error_analysis", "temporal_bounds", "contiguous_split", "schema_profile",
])
def test_plan_stays_in_the_jvm_and_joins_on_keys(spark, name):
    text = plan(own.QUERIES[name](spark, SF))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["key_dedupe", "clean_table", "first_n_features", "latest_preferred"])
def test_first_rows_are_limited_before_the_shuffle(spark, name):
    text = plan(own.QUERIES[name](spark, SF))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_scans_read_only_what_they_need(spark):
    text = plan(own.QUERIES["pit_features"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    schema = text[text.index("ReadSchema"):]
    assert "l_comment" not in schema and "l_tax" not in schema


def test_one_scan_per_audit(spark):
    assert plan(own.QUERIES["domain_violations"](spark, SF)).count("FileScan") == 2  # the feed unions two reads
    assert plan(own.QUERIES["key_duplicates"](spark, SF)).count("FileScan") == 3


def test_sketches_are_checked_without_shuffling_cells(spark):
    """Only partial aggregates and the sketches, a row per column, leave the scan of the cells."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(own.QUERIES["numeric_summary_approx_check"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_models_and_sketches_give_whole_results(spark, monkeypatch):
    """Queries without SQL give their values at the library's settings; the checks stand beside them."""
    queries = entry.queries()
    assert set(own.UNCHECKED) <= set(queries) and not set(own.UNCHECKED) & set(own.ORACLES)
    assert {f"{name}_check" for name in own.UNCHECKED} <= set(own.ORACLES)
    asked, fit = [], evaluation.model.train_all

    def smaller(*args, only, overrides):
        asked.append(overrides)
        return fit(*args, only=only, overrides={only[0]: evaluation._sized(only[0])})

    monkeypatch.setattr(evaluation.model, "train_all", smaller)
    metrics = queries["random_forest"](spark, SF).collect()
    assert {r["split"] for r in metrics} == {"validation", "test"}
    assert all(0 <= r[c] <= 1 for r in metrics for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "positive_rate_pred"))
    top = queries["feature_importance"](spark, SF).collect()
    assert len(top) == 20 and top[0]["importance"] > 0
    assert asked == [None, None]  # no settings but the library's
    summary = queries["numeric_summary_approx"](spark, SF)
    assert {"mean", "std", "p01", "median", "p99"} <= set(summary.columns) and summary.count() > 1


def test_the_check_of_the_forest_grows_the_forest_of_its_query(spark, monkeypatch):
    """Before, it fitted 20 of Spark's trees of depth 6 instead of the library's 200 of full depth."""
    asked, fit = [], evaluation.model.train_all

    def smaller(*args, only, overrides):
        specs = overrides or evaluation.model.classifiers("points_finish")
        asked.append((type(specs[only[0]]), overrides))
        specs[only[0]].trees, specs[only[0]].depth = 3, 2
        return fit(*args, only=only, overrides={only[0]: specs[only[0]]})

    monkeypatch.setattr(evaluation.model, "train_all", smaller)
    rows = own.QUERIES["random_forest_check"](spark, SF).collect()
    assert asked == [(forest.RandomForest, None)]
    assert {r["split"] for r in rows} == {"validation", "test"} and all(r["scores_hold"] and r["shares_hold"] for r in rows)
