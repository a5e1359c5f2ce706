"""All layers on a small landed feed, checked against plain Python."""

import json
import math
import os
import random
import statistics

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from lakeaudit.functions.durable import scratch_path
from lakeaudit.operators import model, reconcile
from lakeaudit.plans import jobs, race
from lakeaudit.sources import files

SESSIONS = {101: 2023, 102: 2023, 201: 2024, 202: 2024, 301: 2025, 302: 2025}
DRIVERS = (1, 4, 16, 44, 63, 81)


def feed():
    rng = random.Random(3)
    rows = {n: [] for n in race.TABLE_ORDER}
    for s, year in SESSIONS.items():
        m = s * 10
        rows["meetings"].append((year, None, dict(meeting_key=m, meeting_name=f"GP {s}", circuit_key=s % 7, year=year)))
        rows["sessions"].append((year, None, dict(
            session_key=s, meeting_key=m, year=year, session_type="Race", session_name="Race",
            circuit_short_name=f"C{s % 3}", location="L", country_name="N",
            date_start=f"{year}-03-01T12:00:00+00:00", date_end=f"{year}-03-01T14:00:00+00:00")))
        for d in DRIVERS:
            key = dict(session_key=s, meeting_key=m, driver_number=d)
            rows["drivers"].append((year, s, dict(key, full_name=f"D {d}", name_acronym="D", team_name=f"T{d % 3}", country_code="X")))
            rank = rng.randrange(1, 21)
            rows["session_result"].append((year, s, dict(
                key, position=rank, points=max(0, 11 - rank) * 0.5, dnf=False, dns=False, dsq=False,
                gap_to_leader=rng.choice([0, 1.5, "+1 LAP"]))))
            for lap in range(1, 9):
                t = rng.choice([None, round(rng.uniform(80, 100), 3), round(rng.uniform(80, 100), 3)])
                rows["laps"].append((year, s, dict(
                    key, lap_number=lap, lap_duration=t, duration_sector_1=30.0, i1_speed=rng.randrange(250, 320),
                    is_pit_out_lap=lap == 4, segments_sector_1=[2048, 2049],
                    date_start=f"{year}-03-01T12:{lap:02d}:00{rng.choice(['', '.250000'])}+00:00")))
            if d != 81:
                rows["pit"].append((year, s, dict(key, lap_number=3, pit_duration=22.5, lane_duration=25.0, date=f"{year}-03-01T12:03:00+00:00")))
            for i in range(7):
                rows["position"].append((year, s, dict(key, position=rng.randrange(1, 21), date=f"{year}-03-01T12:0{i}:00+00:00")))
        for i in range(5):
            rows["weather"].append((year, s, dict(
                session_key=s, meeting_key=m, air_temperature=20.0 + i, track_temperature=30.0, humidity=50.0,
                pressure=1000.0, wind_speed=1.0, rainfall=int(i == 4 and s % 2), date=f"{year}-03-01T1{i}:30:00+00:00")))
        for msg, flag in (("GREEN LIGHT - PIT EXIT OPEN", "GREEN"), ("VIRTUAL SAFETY CAR DEPLOYED", None), ("VIRTUAL SAFETY CAR DEPLOYED", None)):
            rows["race_control"].append((year, s, dict(session_key=s, meeting_key=m, message=msg, flag=flag, date=f"{year}-03-01T12:30:00+00:00", sector=len(rows["race_control"]))))
    return rows


def land(root, rows):
    manifest = []
    by_file = {}
    for name, entries in rows.items():
        for year, session, record in entries:
            by_file.setdefault((name, year, session), []).append(record)
    for (name, year, session), records in by_file.items():
        folder = f"{root}/{name}/year={year}"
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/session_key={session}.jsonl" if session else f"{folder}/{name}.jsonl"
        with open(path, "w") as out:
            out.write("\n\n".join(json.dumps(r) for r in records) + "\n")
        manifest.append((name, year, session, path, len(records), "success", "", "2025-01-01T00:00:00+00:00"))
    for s, year in SESSIONS.items():  # fetched, nothing returned: an empty file
        folder = f"{root}/starting_grid/year={year}"
        os.makedirs(folder, exist_ok=True)
        open(f"{folder}/session_key={s}.jsonl", "w").close()
        manifest.append(("starting_grid", year, s, folder, 0, "success", "", "2025-01-01T00:00:00+00:00"))
    return manifest


@pytest.fixture(scope="module")
def lake(spark):
    rows = feed()
    rows["laps"].append(rows["laps"][0])  # an exact repeat
    rows["laps"].append((2023, 101, dict(rows["laps"][1][2], lap_number=-1)))
    root = scratch_path(spark, "lake")
    manifest = land(f"{root}/bronze", rows)
    frame = spark.createDataFrame(manifest, reconcile.MANIFEST_DDL)
    silver_reports = jobs.silver_job(spark, f"{root}/bronze", f"{root}/silver", f"{root}/reports")
    gold = jobs.gold_job(spark, f"{root}/silver", f"{root}/gold")
    return {"root": root, "rows": rows, "manifest": frame, "silver": silver_reports, "gold": gold}


def test_bronze(spark, lake):
    root = f"{lake['root']}/bronze"
    frames = jobs.bronze_reports(spark, root)
    counts = {(r["endpoint"], r["year"], r["session_key"]): r["row_count"] for r in frames["bronze_row_counts"].collect()}
    for r in lake["manifest"].collect():
        assert counts[r["endpoint"], r["year"], r["session_key"]] == r["record_count"]
    schema = {(r["endpoint"], r["column_name"]): r for r in frames["bronze_schema_report"].collect()}
    assert "STRING" in schema["session_result", "gap_to_leader"]["observed_types"].split("|")
    assert schema["laps", "lap_duration"]["non_null_count"] < schema["laps", "lap_number"]["non_null_count"]
    recon = jobs.reconcile_reports(lake["manifest"], frames["bronze_row_counts"])
    statuses = {r[0] for r in recon["bronze_manifest_file_reconciliation"].select("reconciliation_status").distinct().collect()}
    assert statuses == {"matched"}  # empty files included
    reconcile.assert_gate(recon["bronze_manifest_file_reconciliation"])
    out = jobs.validate_job(spark, {**frames, **recon}, f"{lake['root']}/silver", lake["gold"]["mart"])
    assert out["bronze"]["total_rows"].first()["total_rows"] == sum(counts.values())
    assert out["gold"]["row_count"].first()["row_count"] == len(SESSIONS) * len(DRIVERS)
    assert {r["table_name"]: r["status"] for r in out["silver"]["table_inventory"].collect()}["laps"] == "ok"


def test_provenance_and_malformed_lines(spark, lake):
    scan = files.with_provenance(files.json_scan(spark, f"{lake['root']}/bronze/laps", race.RAW_DDL["laps"]))
    got = {tuple(r) for r in scan.select("source_endpoint", "source_year", "source_session_key").distinct().collect()}
    assert got == {("laps", y, s) for s, y in SESSIONS.items()}
    root = scratch_path(spark, "bad")
    os.makedirs(root)
    with open(f"{root}/a.jsonl", "w") as out:
        out.write('{"a": 1}\n\n{"a": \n{"a": 2}\n')
    bad = files.malformed_lines(spark, root).collect()
    assert [(r["line_number"], r["value"]) for r in bad] == [(3, '{"a": ')]
    with pytest.raises(ValueError, match="line 3"):
        files.assert_well_formed(spark, root)
    with pytest.raises(Exception):
        files.json_scan_strict(spark, root, "a int").collect()


def test_line_numbers_across_file_splits(spark):
    root = scratch_path(spark, "long")
    os.makedirs(root)
    bad_at = {7, 1500, 3999}
    with open(f"{root}/a.jsonl", "w") as out:
        for i in range(1, 4001):
            out.write("{broken\n" if i in bad_at else json.dumps({"a": i, "pad": "x" * 50}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r["line_number"] for r in files.malformed_lines(spark, root).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == bad_at


def test_silver(lake):
    reports = lake["silver"]
    rules = {(r["table_name"], r["rule_id"]): r["rows_removed"] for r in reports["silver_cleaning_rules"].collect()}
    assert rules["laps", "SIL_LAP_NUM_POS"] == 1 and rules["laps", "SIL_DUP_FULL"] == 1
    assert sum(rules.values()) == 2
    impact = {r["table_name"]: r for r in reports["silver_cleaning_impact_summary"].collect()}
    assert impact["laps"]["rows_removed"] == 2 and impact["laps"]["duplicate_rows_before"] == 1
    keys = reports["silver_referential_integrity_report"].where("status = 'checked'")
    assert keys.agg(F.sum("unmatched_rows")).first()[0] == 0
    assert keys.count() == 22  # 13 edges, twice, without the empty grid
    dup = reports["silver_duplicate_report"].where(
        "table_name = 'race_control' and duplicate_type = 'key_duplicate' and stage = 'after'").first()
    assert (dup["duplicate_key_count"], dup["affected_rows"]) == (len(SESSIONS), 2 * len(SESSIONS))
    late = reports["silver_temporal_anomaly_report"].where("anomaly_type = 'weather_outside_session_bounds'").collect()
    assert {r["anomaly_count"] for r in late} == {3 * len(SESSIONS)}
    assert reports["silver_temporal_anomaly_report"].where(
        "anomaly_type = 'unparseable_datetime'").agg(F.sum("anomaly_count")).first()[0] == 0
    assert reports["silver_rejected_records_summary"].count() == 2


def test_mart_against_plain_python(lake):
    mart = {(r["session_key"], r["driver_number"]): r for r in lake["gold"]["mart"].collect()}
    assert len(mart) == len(SESSIONS) * len(DRIVERS)
    assert len(lake["gold"]["mart"].columns) == 63  # 62 and the full observation count
    laps = {}
    for _, _, r in lake["rows"]["laps"]:
        if r["lap_number"] > 0:
            laps.setdefault((r["session_key"], r["driver_number"]), {})[r["lap_number"]] = r
    for key, row in mart.items():
        times = [r["lap_duration"] for r in laps[key].values() if r["lap_duration"] is not None]
        early = [r["lap_duration"] for n, r in laps[key].items() if n <= 5 and r["lap_duration"] is not None]
        assert row["lap_count"] == 8 and row["pit_out_lap_count"] == 1
        assert row["median_lap_duration"] is None if not times else math.isclose(row["median_lap_duration"], statistics.median(times))
        if early:
            assert math.isclose(row["avg_first5_lap_duration"], statistics.mean(early))
        seen = [r["position"] for _, _, r in lake["rows"]["position"] if (r["session_key"], r["driver_number"]) == key]
        assert row["first_observed_position"] == seen[0]
        assert math.isclose(row["early_avg_position"], statistics.mean(seen[:5]))
        assert row["diagnostic_final_observed_position"] == seen[-1]
        assert row["pit_stop_count"] == (0 if key[1] == 81 else 1)
        assert row["early_pit_stop_flag"] == row["pit_stop_count"]
        assert row["safety_car_message_count"] == 4 and row["race_control_message_count"] == 3
        assert row["rainfall_flag"] == key[0] % 2 and row["avg_air_temperature"] == 22.0
        result = next(r for _, _, r in lake["rows"]["session_result"] if (r["session_key"], r["driver_number"]) == key)
        assert row["points_finish"] == int(result["points"] > 0) and row["result_points"] == result["points"]
        assert row["session_year"] == SESSIONS[key[0]] and row["meeting_name"] == f"GP {key[0]}"


def test_gold_reports(lake):
    gold = lake["gold"]
    quality = {r["feature_group"]: r for r in gold["gold_join_quality_report"].collect()}
    assert quality["pit"]["base_rows_without_match"] == len(SESSIONS)
    assert all(r["rows_after"] == r["rows_before"] for r in quality.values())
    assert gold["feature_dictionary"].count() == 63
    allowed = gold["gold_leakage_guard_report"].where("allowed_for_modeling").count()
    assert allowed == 41


def test_models_and_reports(spark, lake):
    common = {"labelCol": "points_finish", "featuresCol": "features", "weightCol": model.WEIGHT}
    small = {
        "logistic_regression": LogisticRegression(maxIter=5, **common),
        "random_forest": RandomForestClassifier(numTrees=3, seed=42, maxDepth=3, **common),
        "boosted_trees": GBTClassifier(maxIter=2, stepSize=0.05, seed=42, maxDepth=2, **common),
    }
    folder = scratch_path(spark, "models")
    out = jobs.model_job(lake["gold"]["mart"], overrides=small, folder=folder, features=[
        *race.CATALOG.default_numeric, "team_name"])
    metrics = out["baseline_metrics"].unionByName(out["validation_metrics"]).unionByName(out["test_metrics"])
    assert metrics.count() == 12
    assert {r["n_rows"] for r in metrics.collect()} == {2 * len(DRIVERS)}
    names = {r["feature_name"] for r in out["feature_importance"].collect()}
    assert "lap_count" in names and any(n.startswith("team_name=") for n in names)
    manifest = spark.read.json(f"{folder}/model_run_manifest.json").first()
    assert manifest["split_method"] == "season" and manifest["seed"] == 42
    silver = lake["silver"]
    tables = jobs.report_job({
        "row_counts": files.rows_per_file(spark, f"{lake['root']}/bronze"),
        "silver_volume": silver["silver_table_inventory"].select(F.col("table_name").alias("entity"), "row_count"),
        "cleaning_impact": silver["silver_cleaning_impact_summary"],
        "duplicate": silver["silver_duplicate_report"], "outlier": silver["silver_outlier_report"],
        "temporal": silver["silver_temporal_anomaly_report"],
        "referential_integrity": silver["silver_referential_integrity_report"],
        "feature_dictionary": lake["gold"]["feature_dictionary"],
        "target_distribution": lake["gold"]["gold_target_distribution"],
        "baseline_metrics": out["baseline_metrics"], "validation_metrics": out["validation_metrics"],
        "test_metrics": out["test_metrics"], "confusion": out["confusion_matrix"],
        "error_analysis": out["error_analysis"], "importances": out["feature_importance"],
        "metrics": metrics, "missing_before": silver["silver_missingness_before"],
        "missing_after": silver["silver_missingness_after"],
    }, f"{folder}/tables")
    assert len(tables) == 16  # the report tables and figure datasets
    grid = {r["actual"]: (r["predicted_0"], r["predicted_1"]) for r in tables["confusion_grid"].collect()}
    assert sum(map(sum, grid.values())) == 2 * len(DRIVERS)
    assert files.csv_source(spark, f"{folder}/tables/data_volume_by_layer.csv", tables["data_volume_by_layer"].schema).count() == tables["data_volume_by_layer"].count()


def test_a_failed_audit_leaves_the_current_version(spark, lake, tmp_path):
    from lakeaudit.operators import reconcile as recon
    from lakeaudit.sources import publish

    root = f"{lake['root']}/silver"
    before = publish.published(spark, root)
    rows = {n: df.count() for n, df in jobs.read_silver(spark, root).items()}
    with pytest.raises(ValueError, match="not published"):
        jobs.silver_job(spark, f"{lake['root']}/bronze", root, judge=lambda frames: ["laps: too few"])
    assert publish.published(spark, root) == before and len(before) == 1
    assert {n: df.count() for n, df in jobs.read_silver(spark, root).items()} == rows
    # a blocking slice stops the job before it writes
    blocked = spark.createDataFrame([("missing_file",)], "reconciliation_status string").select(
        F.lit(recon.BLOCKING_STATUSES[0]).alias("reconciliation_status"))
    with pytest.raises(ValueError, match="blocking"):
        jobs.silver_job(spark, f"{lake['root']}/bronze", root, reconciled=blocked)
    assert publish.published(spark, root) == before


def test_versions(spark, tmp_path):
    from lakeaudit.sources import publish

    root = str(tmp_path / "layer")
    assert publish.published(spark, root) == [] and publish.current_folder(spark, root) == root
    names = []
    for i in range(3):
        names.append(publish.new_version(spark, root))
        assert publish.current_folder(spark, root) == (publish.version_folder(root, names[-2]) if i else root)
        publish.publish(spark, root, names[-1])
        assert publish.current_folder(spark, root) == publish.version_folder(root, names[-1])
    assert publish.published(spark, root) == names == sorted(names)
    with pytest.raises(FileExistsError):
        publish.publish(spark, root, names[0])
    publish.withdraw(spark, root, names[2])
    assert publish.current_folder(spark, root) == publish.version_folder(root, names[1])


def test_faults_name_repeated_keys_and_emptied_tables(spark):
    repeated = spark.createDataFrame(
        [("laps", "key_duplicate", 2, "after"), ("laps", "key_duplicate", 2, "before"), ("race_control", "full_row", 3, "after")],
        "table_name string, duplicate_type string, duplicate_key_count long, stage string")
    impact = spark.createDataFrame([("pit", 5, 0), ("weather", 5, 4), ("drivers", 0, 0)], "table_name string, rows_before long, rows_after long")
    found = jobs.silver_faults({"silver_duplicate_report": repeated, "silver_cleaning_impact_summary": impact})
    assert "pit: no row left" in found and not any(f.startswith(("weather", "drivers", "race_control")) for f in found)
    assert ("laps: repeated keys" in found) == bool(race.SPECS["laps"].dedupe_keys)
