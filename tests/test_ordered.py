"""Ordered helpers against brute force, with ties, nulls and a hot group."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeaudit.functions.ordered import lagged, prefix_sums, row_rank
from lakeaudit.functions.quantiles import exact_quantiles
from lakeaudit.operators import audit, features as feat


def skewed(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rng.random() < 0.4 else f"g{rng.randrange(30)}"
        v = None if rng.random() < 0.05 else float(rng.randrange(40))
        rows.append((g, i, v))
    return rows


def test_row_rank(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, i int, v double").repartition(7)
    got = {r["i"]: r["row_rank"] for r in row_rank(df, ["g", "i"]).collect()}
    want = {r[1]: k for k, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1])))}
    assert got == want


def test_prefix_sums(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, i int, v double").withColumn("n", F.lit(2))
    got = {r["i"]: (r["n_before"], r["n_total"]) for r in prefix_sums(df, ["g"], ["i"], ["n"]).collect()}
    for g, i, _ in rows:
        same = [r[1] for r in rows if r[0] == g]
        assert got[i] == (2 * sum(x < i for x in same), 2 * len(same))


def test_prefix_sums_without_groups(spark):
    df = spark.range(500).withColumn("n", F.col("id") % 3)
    got = {r["id"]: r["n_before"] for r in prefix_sums(df, [], ["id"], ["n"]).collect()}
    assert all(got[i] == sum(j % 3 for j in range(i)) for i in range(500))


def test_lagged_across_slices(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {r["i"]: r["p"] for r in lagged(df, ["g"], ["i"], "v", "p").collect()}
    for g in {r[0] for r in rows}:
        previous = None
        for _, i, v in sorted(r for r in rows if r[0] == g):
            assert got[i] == previous
            previous = v


def test_exact_quantiles(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5, "p99": 0.99}).collect()}
    for g in {r[0] for r in rows}:
        values = [r[2] for r in rows if r[0] == g and r[2] is not None]
        if values:
            for name, p in (("q1", 0.25), ("m", 0.5), ("p99", 0.99)):
                assert abs(got[g][name] - np.quantile(values, p)) < 1e-9


def medians(rows):
    out = {}
    for g in {r[0] for r in rows}:
        values = [r[2] for r in rows if r[0] == g and r[2] is not None]
        out[g] = statistics.median(values) if values else None
    return out


def _median_frame(spark, rows):
    df = spark.createDataFrame(rows, "g string, i int, v double")
    return feat.grouped_with_median(df, ["g"], "v", "m", [F.count(F.lit(1)).alias("n")])


def test_median_usual(spark):
    rows = skewed()
    got = {r["g"]: r["m"] for r in _median_frame(spark, rows).collect()}
    assert got == medians(rows)


def test_median_hot(spark):
    rows = skewed()
    out = {r["g"]: (r["m"], r["n"]) for r in _median_frame(spark, rows).collect()}
    assert {g: m for g, (m, _) in out.items()} == medians(rows)
    assert sum(n for _, n in out.values()) == len(rows)


def test_median_of_even_group(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 3.0, 10.0)], "g string, v double")
    assert feat.grouped_with_median(df, ["g"], "v", "m", [F.count("v").alias("n")]).first()["m"] == 2.5


def _decreases(spark):
    rows = skewed()
    df = spark.createDataFrame([(g, i, None if v is None else int(v)) for g, i, v in rows], "g string, t int, lap int")
    want = 0
    for g in {r[0] for r in rows}:
        laps = [r[2] for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1])]
        want += sum(a is not None and b is not None and b < a for a, b in zip(laps, laps[1:]))
    return audit.lag_decrease(df, "laps", ["g"], "lap", "t").first()["anomaly_count"], want


def test_lag_decrease_usual(spark):
    got, want = _decreases(spark)
    assert got == want


def test_lag_decrease_hot(spark):
    got, want = _decreases(spark)
    assert got == want


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "bigint", "double"])
@pytest.mark.parametrize("bucket_rows", [1_000_000, 40])
def test_falls_in_time(spark, monkeypatch, kind, bucket_rows):
    """A hot key, equal and null moments, null numbers and null keys, over one bucket and over many."""
    from lakeaudit.functions import ordered

    monkeypatch.setattr(ordered, "BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(len(kind))
    rows = [(None if i % 40 == 0 else ("hot" if i % 3 else f"k{i % 7}"), None if i % 31 == 0 else int(rng.integers(0, 300)) if i % 5 else 77,
             None if i % 17 == 0 else float(rng.integers(0, 20))) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, m int, lap double").repartition(4)
    moment = {"timestamp": "timestamp_seconds(m * 977)", "date": "date_add(date'2020-01-01', m)", "string": "lpad(m, 6, '0')",
              "bigint": "cast(m - 50 as bigint)", "double": "m / 7.0D"}[kind]
    got = ordered.falls_in_time(df.selectExpr("g", "lap", f"{moment} as t"), ["g"], "t", "lap").first()
    want = 0
    for g in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == g), key=lambda r: tuple((x is not None, x or 0) for x in r))
        want += sum(a[1] is not None and b[1] is not None and b[1] < a[1] for a, b in zip(own, own[1:]))
    assert (got.rows, got.falls) == (len(rows), want)


def test_one_moment_of_many_rows_is_one_row(spark):
    from lakeaudit.functions import ordered

    df = spark.range(1_000_000).selectExpr("1 as g", "cast(id as double) as lap", "date'2020-01-01' as t")
    got = ordered.falls_in_time(df, ["g"], "t", "lap").first()
    assert (got.rows, got.falls) == (1_000_000, 0)
    assert ordered.falls_in_time(df.where("false"), ["g"], "t", "lap").first()[:] == (0, 0)
