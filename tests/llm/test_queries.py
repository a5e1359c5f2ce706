"""The registered queries of the subpackage and the pipeline at the smallest scale."""

import pytest

import corpus_pipeline
from lakeaudit.llm import registry
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_result(spark, con, name):
    assert differences(registry.QUERIES[name](spark, SF), con, registry.ORACLES[name]) == []


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))


def test_native_rules_run_no_python(spark):
    text = registry.QUERIES["op3_host_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_pipeline_stages(spark, docs, no_docs, rows, monkeypatch, tmp_path):
    """Each stage's decisions take effect on the next one's input; awkward rows and empty tables pass."""
    from lakeaudit.llm import pii

    monkeypatch.setattr(pii, "train", lambda d, f=pii.train: f(d, planted=300, steps=60))
    for label, frame in (("full", docs), ("none", no_docs)):
        counts, now = [], frame
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, now, SF).write.parquet(str(tmp_path / label / name))
            out = spark.read.parquet(str(tmp_path / label / name))
            if name != "packing":
                assert out.columns == docs.columns
                counts.append(out.count())
            now = out
        assert now.columns[:2] == ["doc_id", "piece"]
        if label == "none":
            assert counts == [0, 0, 0, 0] and now.count() == 0
            continue
        lettered = sum(any(c.isalpha() for c in r[1] or "") for r in rows)
        assert counts[0] == lettered and counts[1] < counts[0] and counts[2] == counts[3] == counts[1]
        known = spark.read.parquet(str(tmp_path / label / "personal_data"))
        assert known.where("text like '%@mail3%'").count() == 0
        assert {r["doc_id"] for r in now.select("doc_id").distinct().collect()} == {
            r["doc_id"] for r in known.select("doc_id").distinct().collect()}
