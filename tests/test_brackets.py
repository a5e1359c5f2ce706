"""Quantiles by brackets against numpy, with brackets that miss, hot groups and single values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeaudit.functions import brackets

PROBS = {"p01": 0.01, "q1": 0.25, "m": 0.5, "p99": 0.99, "low": 0.0, "high": 1.0}


def columns(rng, n):
    return {
        "flat": rng.random(n), "long": np.exp(rng.normal(0, 4, n)), "few": rng.integers(0, 3, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 1, n)), "one": np.full(n, 2.5),
        "signed": np.where(rng.random(n) < 0.5, -0.0, rng.normal(0, 1e300, n)),
    }


@pytest.mark.parametrize("n,sketch,ranked", [(1, 4096, 10), (2, 64, 1), (37, 256, 5), (20_000, 512, 50), (20_000, 4096, 200_000)])
def test_column_quantiles(spark, monkeypatch, n, sketch, ranked):
    monkeypatch.setattr(brackets, "COLUMN_SKETCH", sketch)
    monkeypatch.setattr(brackets, "RANKED_VALUES", ranked)
    data = columns(np.random.default_rng(n), n)
    rows = [tuple(None if i % 50 == 3 else float(data[c][i]) for c in data) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(4)
    for name, s in zip(data, brackets.column_stats(df, [F.col(c) for c in data], PROBS)):
        kept = np.array([data[name][i] for i in range(n) if i % 50 != 3])
        assert s.count == len(kept) and s.least == kept.min() and s.most == kept.max()
        for q, p in PROBS.items():
            assert s.quantiles[q] == pytest.approx(np.quantile(kept, p), rel=1e-12), (name, q)


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    stats = brackets.column_stats(df, [F.col("x")], PROBS)[0]
    assert stats.count == 0 and set(stats.quantiles.values()) == {None} and stats.mean is None
    assert brackets.column_stats(df.where("false"), [F.col("x")], {"m": 0.5})[0].quantiles == {"m": None}


def test_a_bracket_that_misses_its_rank_is_widened(spark, monkeypatch):
    monkeypatch.setattr(brackets, "_margin", lambda size: 0.0)
    monkeypatch.setattr(brackets, "COLUMN_SKETCH", 64)
    values = np.random.default_rng(1).permutation(5000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = brackets.column_stats(df, [F.col("x")], {"a": 0.123, "m": 0.5, "z": 0.877})[0].quantiles
    assert got == pytest.approx({q: np.quantile(values, p) for q, p in (("a", 0.123), ("m", 0.5), ("z", 0.877))})


@pytest.mark.parametrize("ranked,margin", [(200_000, None), (40, None), (200_000, 0.0)])
def test_group_medians(spark, monkeypatch, ranked, margin):
    monkeypatch.setattr(brackets, "RANKED_VALUES", ranked)
    if margin is not None:
        monkeypatch.setattr(brackets, "_margin", lambda size: margin)
    rng = np.random.default_rng(4)
    groups = {("a", 1): rng.normal(0, 1, 9000), ("a", None): rng.integers(0, 4, 4000).astype(float), (None, 2): np.full(700, 3.0),
              ("", 2): rng.random(256), ("b", 3): rng.random(257), ("c", 4): rng.random(1), ("c", 5): rng.random(2),
              ("d", 1): np.where(rng.random(3000) < 0.49, 1.0, np.exp(rng.normal(0, 9, 3000)))}
    rows = [(k[0], k[1], float(v)) for k, vs in groups.items() for v in vs] + [("e", 9, None), ("c", 4, None)]
    df = spark.createDataFrame(rows, "k string, g int, v double").repartition(5)
    got = {(r.k, r.g): (r.n, r.median) for r in
           brackets.group_medians(df, ["k", "g"], "v", "median", [F.count(F.lit(1)).alias("n")]).collect()}
    assert got.pop(("e", 9)) == (1, None) and got.pop(("c", 4)) == (2, groups["c", 4][0])
    assert got == {k: (len(v), pytest.approx(float(np.median(v)), rel=1e-12)) for k, v in groups.items() if k != ("c", 4)}


def test_no_table_is_laid_out(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("v"))
    plan = brackets.group_medians(df, ["g"], "v", "m", [])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan
