"""Small literal frames for each semantic choice."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lakeaudit.functions import skew
from lakeaudit.functions.columns import cast_columns, snake_case
from lakeaudit.operators import audit, checks, clean, evaluate, features as feat, govern, model, profile, split
from lakeaudit.plans import race
from lakeaudit.spec import ForeignKey, TableSpec


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_casts_turn_junk_into_null(spark):
    df = spark.createDataFrame([("1",), ("x",), ("7.0",), (None,)], "a string")
    assert [r[0] for r in cast_columns(df, {"a": "bigint"}).collect()] == [1, None, 7, None]
    assert [r[0] for r in cast_columns(df, {"a": "double"}).collect()] == [1.0, None, 7.0, None]


def test_timestamps_with_and_without_fraction(spark):
    df = spark.createDataFrame(
        [("2024-03-02T15:00:00+00:00",), ("2024-03-02T15:00:00.123000+00:00",), ("soon",), (None,)], "d string")
    got = [r[0] for r in cast_columns(df, {"d": "timestamp"}).select(F.date_format("d", "HH:mm:ss.SSS")).collect()]
    assert got == ["15:00:00.000", "15:00:00.123", None, None]
    bad = audit.row_time_checks(df.withColumnRenamed("d", "date"), "t")
    assert one(bad)["anomaly_count"] == 1


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Lap Number` int, `driverNumber` int, `st-speed` int")
    assert snake_case(df).columns == ["lap_number", "driver_number", "st_speed"]


def test_points_label(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(feat.label(F.col("p"))).collect()] == [0, 1, 1, 0]


def test_positions_skip_nulls_and_break_ties(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 12, m)
    rows = [(1, t(0), None), (1, t(1), 4), (1, t(1), 3), (1, t(2), 6), (1, t(3), 5), (1, t(4), 9), (1, t(5), None)]
    df = spark.createDataFrame(rows, "k int, date timestamp, position bigint")
    got = one(feat.position_features(df, ["k"]))
    assert got["first_observed_position"] == 3
    assert got["early_avg_position"] == (3 + 4 + 6 + 5) / 4
    assert (got["early_min_position"], got["early_max_position"]) == (3, 6)
    assert got["position_observation_count"] == 4
    assert got["position_total_observation_count"] == 7
    assert got["diagnostic_final_observed_position"] == 9


def test_messages_are_substrings(spark):
    rows = [("VIRTUAL SAFETY CAR", None), ("safety car", ""), ("TRACK CLEARED", "YELLOW"), (None, "RED"), (None, None)]
    df = spark.createDataFrame([(1, m, f) for m, f in rows], "k int, message string, flag string")
    got = one(feat.message_features(df, ["k"]))
    assert got["race_control_message_count"] == 5
    assert got["flag_message_count"] == 2
    assert got["safety_car_message_count"] == 3  # the virtual one counts in both terms
    assert got["red_flag_count"] == 2  # CLEARED and RED
    assert one(feat.message_features(df, ["k"], whole_words=True))["red_flag_count"] == 1


def test_key_survivor_does_not_depend_on_order(spark):
    rows = [(1, "b", 2), (1, "a", 3), (1, None, 9), (2, "z", 1)]
    seen = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, a string, b int").repartition(3)
        seen.add(tuple(sorted(map(tuple, clean.dedupe_key(df, ["k"]).collect()), key=str)))
    assert len(seen) == 1 and (1, None, 9) in seen.pop()


def test_exact_dedupe_ignores_provenance(spark):
    rows = [(1, [1, 2], "b"), (1, [1, 2], "a"), (2, [3], "c")]
    df = spark.createDataFrame(rows, "k int, xs array<int>, source_file string")
    got = sorted(map(tuple, clean.dedupe_exact(df).collect()))
    assert got == [(1, [1, 2], "a"), (2, [3], "c")]


def test_exact_dedupe_with_maps(spark):
    df = spark.sql("select 1 k, map('a', 1, 'b', 2) m union all select 1, map('b', 2, 'a', 1) union all select 2, map('a', 1)")
    assert clean.dedupe_exact(df, ()).count() == 2
    assert one(audit.full_row_duplicates(df, "t"))["duplicate_count"] == 1


def test_array_cells_duplicates(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [3])], "k int, xs array<int>")
    assert one(audit.full_row_duplicates(df, "t"))["duplicate_count"] == 1
    assert one(profile.table_profile(df, "t"))["duplicate_full_rows"] == 1


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    got = one(audit.key_duplicates(df, "t", ["k"]))
    assert (got["duplicate_key_count"], got["affected_rows"]) == (1, 2)


def test_single_row_deviation(spark):
    df = spark.createDataFrame([(5.0,)], "v double")
    assert one(profile.numeric_summary(df, "t"))["std"] == 0.0
    laps = spark.createDataFrame([(1, 1, 90.0)], "k int, lap_number int, lap_duration double")
    assert one(feat.lap_features(laps, ["k"], {}, flag=None))["std_lap_duration"] is None


def test_missingness_excludes_null_from_distinct(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (0.0, None), (-0.0, "b")], "x double, s string")
    got = {r["column_name"]: r for r in profile.missingness(df, "t").collect()}
    assert (got["x"]["missing_count"], got["x"]["unique_count"]) == (1, 2)
    assert (got["s"]["missing_pct"], got["s"]["unique_count"]) == (25.0, 2)


def test_missingness_of_empty_table(spark):
    got = profile.missingness(spark.createDataFrame([], "x double, s string"), "t").collect()
    assert [r["missing_count"] for r in got] == [0, 0] and [r["missing_pct"] for r in got] == [0.0, 0.0]


def test_missingness_approx_agrees_on_small_data(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.when(F.col("id") > 10, "x").alias("b"))
    exact = sorted(map(tuple, profile.missingness(df, "t").collect()))
    assert exact == sorted(map(tuple, profile.missingness(df, "t", approx=True).collect()))


def test_iqr_with_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "v double")
    got = one(audit.iqr_outliers(df, "t", ["v"]))
    assert (got["lower_bound"], got["upper_bound"], got["outlier_count"]) == (-1.0, 7.0, 1)
    assert got["outlier_pct"] == 16.6667  # of all rows, nulls included


def test_fk_statuses(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    got = one(audit.fk_check(child, parent, "c", "p", ["k"]))
    assert (got["distinct_child_keys"], got["unmatched_rows"], got["unmatched_pct"], got["status"]) == (2, 1, 50.0, "checked")
    assert one(audit.fk_check(empty, parent, "c", "p", ["k"]))["status"] == "skipped_empty_child"
    assert one(audit.fk_check(child, empty, "c", "p", ["k"]))["status"] == "skipped_empty_parent"
    assert one(audit.fk_check(child, parent, "c", "p", ["z"]))["status"] == "skipped_missing_columns"
    assert one(audit.fk_check(child, None, "c", "p", ["k"]))["status"] == "skipped_missing_table"


@pytest.mark.parametrize("kind", ["int", "string"])
def test_fk_suite_equals_single_checks(spark, kind):
    tables = {
        "a": spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 1)], "x int, y int"),
        "b": spark.createDataFrame([(1, 1), (5, 5)], "x bigint, y bigint"),
        "e": spark.createDataFrame([], "x int, y int"),
    }
    if kind == "string":
        tables = {n: df.select(F.col("x").cast("string"), "y") for n, df in tables.items()}
    edges = [
        ForeignKey("a", "b", ("x",)), ForeignKey("a", "b", ("x", "y")), ForeignKey("b", "a", ("x", "y")),
        ForeignKey("a", "e", ("x",)), ForeignKey("e", "a", ("x",)), ForeignKey("e", "e", ("x",)),
        ForeignKey("a", "b", ("z",)), ForeignKey("a", "gone", ("x",)), ForeignKey("a", "b", ("y",), ("x",)),
    ]
    got = sorted(map(tuple, audit.fk_suite(tables, edges, "s").drop("stage").collect()), key=str)
    want = []
    for e in edges:
        want.append(tuple(one(audit.fk_check(
            tables.get(e.child), tables.get(e.parent), e.child, e.parent, list(e.columns), list(e.parent_columns)))))
    assert got == sorted(want, key=str)


def test_bounds_count_each_child_once(spark):
    ts = lambda h: dt.datetime(2024, 1, 1, h)
    child = spark.createDataFrame([(1, ts(1)), (1, ts(5)), (2, ts(5)), (1, None)], "k int, d timestamp")
    parent = spark.createDataFrame([(1, ts(2), ts(4)), (1, ts(2), ts(4))], "k int, s timestamp, e timestamp")
    got = one(audit.outside_bounds(child, parent, "w", "k", "d", "s", "e"))
    assert (got["anomaly_count"], got["anomaly_pct"]) == (2, 50.0)


def test_lookup_backfill_keeps_own_value(spark):
    df = spark.createDataFrame([(1, 10), (1, None), (2, None)], "session_key int, meeting_key int")
    look = spark.createDataFrame([(1, 99), (1, 99)], "session_key int, meeting_key int")
    got = sorted(map(tuple, feat.lookup_backfill(df, look, "session_key", "meeting_key").collect()), key=str)
    assert got == [(1, 10), (1, 99), (2, None)]
    bare = feat.lookup_backfill(df.select("session_key"), look, "session_key", "meeting_key")
    assert sorted((r["session_key"], r["meeting_key"]) for r in bare.where("session_key = 1").collect()) == [(1, 99), (1, 99)]


def test_join_quality_sees_missing_and_fan_out(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    feats = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "k int, v int")
    got = one(feat.join_quality(base, feats, ["k"], "g"))
    assert (got["rows_before"], got["rows_after"], got["base_rows_without_match"]) == (3, 4, 1)


def test_left_join_with_hot_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0), (3, 0), (None, 0)], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = sorted(map(tuple, skew.left_join(left, right, ["k"]).collect()), key=str)
    want = [(k, i, {1: "a", 2: "b"}.get(k)) for k, i in map(tuple, left.collect())]
    assert got == sorted(want, key=str)


def test_left_join_of_keys_alone(spark):
    left = spark.createDataFrame([(1,)] * 9 + [(2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    got = sorted(map(tuple, skew.left_join(left, right, ["k"]).collect()), key=str)
    assert got == sorted([(1, "a")] * 9 + [(2, None), (None, None)], key=str)


def test_left_join_neither_copies_nor_broadcasts(spark):
    left = spark.range(100).selectExpr("id % 7 as k", "id as i")
    right = spark.range(5).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("v"))
    df = skew.left_join(left, right, ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Broadcast" not in plan
    # both sides are shuffled for the join itself, where a hot key can be split
    assert plan.count("hashpartitioning(k") == 2
    assert sorted(map(tuple, df.collect())) == sorted((i % 7, i, i % 7 if i % 7 < 5 else None) for i in range(100))


@pytest.mark.parametrize("kinds", [("double", "double"), ("int", "bigint"), ("string", "int"), ("string collate UTF8_LCASE",) * 2])
def test_left_join_keys_that_are_equal_but_not_alike(spark, kinds):
    given = [("a", "A")] if "collate" in kinds[0] else [("0", "-0"), ("7", "7")]
    left = spark.createDataFrame([(a,) for a, _ in given], "k string").select(F.col("k").cast(kinds[0]))
    right = spark.createDataFrame([(b, "x") for _, b in given], "k string, v string").select(F.col("k").cast(kinds[1]), "v")
    assert [r["v"] for r in skew.left_join(left, right, ["k"]).collect()] == ["x"] * len(given)


def test_building_a_join_runs_no_job(spark):
    left = spark.createDataFrame([(1, i) for i in range(9)] + [(2, 0)], "k int, i int")
    look = spark.createDataFrame([(1, 5), (2, 6)], "k int, m int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    df = feat.lookup_backfill(left, look, "k", "m")
    assert list(tracker.getJobIdsForGroup("plan")) == []
    assert sorted(map(tuple, df.collect())) == [(1, i, 5) for i in range(9)] + [(2, 0, 6)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    row = one(profile.missingness(df, "t"))
    assert (row["missing_count"], row["unique_count"]) == (2, 2)
    row = one(profile.numeric_summary(df, "t"))
    assert (row["count"], row["mean"], row["max"], row["p99"]) == (2, 2.0, 3.0, 2.98)
    assert one(profile.null_counts(df, "t"))["missing_count"] == 2
    assert one(profile.table_profile(df, "t"))["total_missing_cells"] == 2


def test_maps_of_maps(spark):
    df = spark.sql("select map('a', map('x', 1)) as m union all select map('a', map('x', 1)) union all select map('b', map('x', 1))")
    assert one(profile.table_profile(df, "t"))["duplicate_full_rows"] == 1


@pytest.mark.parametrize("kind", ["double", "string", "decimal(10,2)"])
def test_foreign_keys_of_different_types(spark, kind):
    child = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    parent = spark.sql(f"select cast(v as {kind}) as k from values (1), (2) as t(v)")
    edges = [ForeignKey("child", "parent", ("k",)), ForeignKey("child", "child", ("k",))]
    rows = {r["parent_table"]: r for r in audit.fk_suite({"child": child, "parent": parent}, edges, "s").collect()}
    assert (rows["parent"]["unmatched_rows"], rows["child"]["unmatched_rows"]) == (1, 0)


def test_long_texts_are_compared_whole(spark):
    long = "x" * 500
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "a",), (None,)], "t string")
    assert one(audit.full_row_duplicates(df, "t"))["duplicate_count"] == 1
    assert one(profile.missingness(df, "t"))["unique_count"] == 2
    assert one(audit.key_duplicates(df, "t", ["t"]))["affected_rows"] == 2


def test_most_frequent_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", None), ("a", "z"), (None, "z")], "s string, t string")
    assert model.most_frequent(df, ["s", "t"]) == {"s": "a", "t": "z"}


def test_feature_join_skips_unkeyed_features(spark):
    base = spark.createDataFrame([(1,)], "k int")
    assert feat.feature_left_join(base, None, ["k"]).columns == ["k"]
    assert feat.feature_left_join(base, base.withColumnRenamed("k", "z"), ["k"]).columns == ["k"]


def test_grain_guard(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        feat.assert_unique_grain(df, ["k"])


# --- cleaning log -----------------------------------------------------------------------------

def stepwise(df, spec):
    """The same log by applying and counting one rule at a time."""
    df = clean.prepare(df, spec)
    out, n = [], df.count()
    for rule, *_, keep in clean._filters(df, spec):
        df = df.where(keep)
        out.append((rule, n, df.count()))
        n = out[-1][2]
    df = clean.dedupe_exact(df)
    out.append(("SIL_DUP_FULL", n, df.count()))
    if spec.dedupe_keys:
        out.append(("SIL_DUP_KEY", out[-1][2], clean.dedupe_key(df, list(spec.dedupe_keys)).count()))
    return out


def raw_laps(spark):
    rows = []
    for s in (1, None):
        for d in (1, 2, 44):
            for lap in (None, "0", "1", "2", "x"):
                for t in ("90.5", "-1", None, "n/a"):
                    rows += [(s, d, lap, t, "2024-01-01T00:00:00+00:00", [1, 2], f"f{d % 2}")] * (1 + d % 2)
    return spark.createDataFrame(
        rows, "session_key bigint, driver_number bigint, lap_number string, lap_duration string, "
        "date_start string, segments_sector_1 array<bigint>, source_file string")


def test_log_equals_step_by_step(spark):
    df = raw_laps(spark)
    spec = race.SPECS["laps"]
    log = clean.cleaning_log(df, spec).collect()
    got = [(r["rule_id"], r["rows_before"], r["rows_after"]) for r in log][2:]
    assert got == stepwise(df, spec)
    cleaned = clean.clean(df, spec)
    assert log[-1]["rows_after"] == cleaned.count()
    assert sum(r["rows_removed"] for r in log) == df.count() - cleaned.count()


def test_cleaned_table_is_a_fixed_point(spark):
    once = clean.clean(raw_laps(spark), race.SPECS["laps"])
    twice = clean.clean(once, race.SPECS["laps"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_log_of_empty_tables(spark):
    for name, rule in (("laps", "SIL_EMPTY"), ("starting_grid", "SIL_OPTIONAL_EMPTY")):
        spec = race.SPECS[name]
        log = clean.cleaning_log(clean.empty_table(spark, spec), spec)
        assert [r["rule_id"] for r in log.collect()] == [rule]


def test_repeats_are_logged_and_kept(spark):
    rows = [(1, "d1", "A", 1), (1, "d1", "A", 2), (1, "d2", "B", 1)]
    df = spark.createDataFrame(rows, "session_key int, date string, message string, sector int")
    log = {r["rule_id"]: r for r in clean.cleaning_log(df, race.SPECS["race_control"]).collect()}
    assert log["SIL_RC_DUP_CHECK_RETAINED"]["rows_removed"] == 0
    assert log["SIL_RC_DUP_CHECK_RETAINED"]["rule_description"].startswith("1 keys repeat in 2 rows")
    assert clean.clean(df, race.SPECS["race_control"]).count() == 3


def test_grid_position_alias(spark):
    df = spark.createDataFrame([(1, 44, "3"), (None, 44, "3")], "session_key int, driver_number int, position string")
    got = one(clean.clean(df, race.SPECS["starting_grid"]))
    assert got["grid_position"] == 3


def test_nothing_rejected(spark):
    spec = TableSpec("t", ("k",), not_null=("k",), dedupe_keys=("k",))
    log = clean.cleaning_log(spark.createDataFrame([(1,), (2,)], "k int"), spec)
    got = clean.rejected_records(log, ["t", "u"]).collect()
    assert [(r["table_name"], r["rule_id"], r["rejected_count"]) for r in got] == [("t", "SIL_NONE", 0), ("u", "SIL_NONE", 0)]


# --- evaluation -------------------------------------------------------------------------------

def predictions(spark, rows):
    return spark.createDataFrame(
        [("m", "test", *r) for r in rows], "model_name string, split string, y_true int, y_pred int, score double")


def test_auc_with_ties(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.9), (1, 1, 0.8), (0, 0, 0.1), (1, 0, 0.1), (0, 0, 0.05)]
    pairs = [(p, n) for y, _, p in rows if y for z, _, n in rows if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    got = one(evaluate.class_metrics(predictions(spark, rows)))
    assert math.isclose(got["roc_auc"], round(want, 4))
    assert got["accuracy"] == round(4 / 6, 4)


def test_one_class(spark):
    got = one(evaluate.class_metrics(predictions(spark, [(0, 0, 0.1), (0, 0, 0.4)])))
    assert got["roc_auc"] is None and got["precision"] == 0.0 and got["f1"] == 0.0


def test_rows_without_score_count_but_do_not_rank(spark):
    rows = [(1, 1, 0.9), (0, 0, 0.2), (1, 0, None), (0, 0, None)]
    got = one(evaluate.class_metrics(predictions(spark, rows)))
    assert got["n_rows"] == 4 and got["roc_auc"] == 1.0 and got["recall"] == 0.5


def test_position_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 5.0, 5.5, 10.0, 20.0, 100.0, None)], "v double")
    got = [r[0] for r in df.select(evaluate.position_bin(F.col("v"))).collect()]
    assert got == ["1-5", "1-5", "6-10", "6-10", "16-20", "21+", None]


def test_confusion_has_all_cells(spark):
    got = {(r["actual"], r["predicted"]): r["count"] for r in evaluate.confusion_long(predictions(spark, [(1, 1, .5)])).collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_error_summary_counts_once(spark):
    df = predictions(spark, [(1, 0, .1), (0, 1, .9), (0, 1, .8)]).withColumns({
        "team_name": F.lit("t"), "session_year": F.lit(2024), "first_observed_position": F.lit(3.0)})
    errors = evaluate.error_analysis(df)
    got = {r["error_type"]: r["count"] for r in evaluate.error_summary(errors).collect()}
    assert got == {"false_negative": 1, "false_positive": 2}
    bins = errors.where("group_column = '_position_bin'").collect()
    assert len(bins) == 10 and sum(r["count"] for r in bins) == 3


def test_random_draw_differs_between_splits(spark):
    df = spark.range(200).select("id", F.explode(F.array(F.lit("train"), F.lit("test"))).alias("split"), F.lit(1).alias("y_true"))
    draws = df.select("id", "split", evaluate.uniform_draw([F.col("id"), F.col("split")], 42).alias("d"))
    by = {(r["id"], r["split"]): r["d"] for r in draws.collect()}
    assert all(0 <= d < 1 for d in by.values())
    assert sum(by[i, "train"] == by[i, "test"] for i in range(200)) == 0


# --- splits -----------------------------------------------------------------------------------

def test_contiguous_split_sizes(spark):
    df = spark.range(103).withColumn("d", F.lit(1))  # one value of the leading key
    got = {r["split"]: r["count"] for r in split.contiguous_split(df, ["d", "id"]).groupBy("split").count().collect()}
    assert got == {"train": 61, "validation": 20, "test": 22}
    train = split.contiguous_split(df, ["d", "id"]).where("split = 'train'").agg(F.max("id")).first()[0]
    assert train == 60


def test_resolve_splits(spark):
    df = spark.createDataFrame([(i, 2023) for i in range(10)], "k int, year int")
    seasons = {"train": [2023], "validation": [2024], "test": [2025]}
    with pytest.raises(ValueError):
        split.resolve_splits(df, "full", "year", seasons, ["k"])
    with pytest.raises(ValueError):
        split.resolve_splits(df, "other", "year", seasons, ["k"])
    out, how = split.resolve_splits(df, "smoke", "year", seasons, ["k"])
    assert how["split_method"] == "smoke_fallback" and out.where("split = 'test'").count() == 2


# --- governance -------------------------------------------------------------------------------

def test_plan_shape(spark):
    plan = govern.feature_plan(spark, race.CATALOG)
    assert plan.count() == 62
    got = one(govern.tier_summary(plan))
    assert tuple(got) == (8, 32, 40)
    assert govern.resolve_features(race.CATALOG, plan) == list(race.CATALOG.default_numeric)


def test_leakage_is_refused(spark):
    bad = spark.createDataFrame([("points_finish", True), ("lap_count", True)], "feature_name string, allowed_for_modeling boolean")
    with pytest.raises(ValueError):
        govern.assert_no_leakage(bad, race.CATALOG)
    with pytest.raises(ValueError):
        govern.resolve_features(race.CATALOG)


def test_non_integral_keys(spark):
    df = spark.createDataFrame([(1.0, 2)], "session_key double, driver_number int")
    assert govern.non_integral_keys({"laps": df}, {"laps": ["session_key", "driver_number"]}) == [("laps", "session_key", "double")]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    got = sorted({(r["y"], r["w"]) for r in df.select("y", model.class_weight(df, "y").alias("w")).collect()})
    assert got == [(0, 4 / 6), (1, 2.0)]


def test_missing_columns_do_not_fail_a_check(spark):
    got = one(checks.guarded(spark.range(1), "r", ["x"], "select x from {t}"))
    assert (got["status"], got["missing_columns"]) == ("skipped_missing_columns", "x")


def test_mixed_types(spark):
    df = spark.createDataFrame([("1", "a", None), ("2.5", "3", None)], "n string, m string, e string")
    assert dict(profile.mixed_type_columns(df).dtypes) == {"n": "double", "m": "string", "e": "string"}


def test_training_vectors_are_stored_once(spark):
    """A classifier gets stored vectors, not the stages before it, and learns what it learned in one pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    seen = []

    class Spied(RandomForestClassifier):
        def fit(self, dataset, params=None):
            seen.append(dataset)
            return super().fit(dataset, params)

    rows = spark.range(400).selectExpr(
        "if(id % 9 = 0, null, id % 50) as a", "cast(id % 7 as double) as b", "if(id % 11 = 0, null, concat('t', id % 3)) as c",
        "cast(id % 50 > 20 and id % 3 > 0 as int) as y")
    common = {"labelCol": "y", "featuresCol": "features", "weightCol": model.WEIGHT, "numTrees": 5, "maxDepth": 4, "seed": 42}
    fitted, modes, used = model.fit(rows, ["a", "b", "c"], "y", Spied(**common), scale=False)
    assert seen[0].columns == ["features", "y", model.WEIGHT]
    assert "RDD" in seen[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    inputs = model.as_inputs(rows, used)
    stages, _ = model.preprocess_stages(inputs, used, False)
    weighted = inputs.fillna(modes).withColumn(model.WEIGHT, model.class_weight(inputs, "y"))
    whole = Pipeline(stages=[*stages, RandomForestClassifier(**common)]).fit(model.in_few_tasks(weighted))
    assert fitted.stages[-1].toDebugString.split("\n", 1)[1] == whole.stages[-1].toDebugString.split("\n", 1)[1]
