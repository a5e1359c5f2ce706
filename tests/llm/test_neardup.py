"""Near duplicates against brute force, with groups that need every step."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeaudit.llm import neardup
from lakeaudit.llm.components import components
from tests.llm.conftest import sentence

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    words = re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent=80):
    sets = [shingles(r[1], size) for r in rows]
    keys = sorted({r[0] for r in rows if r[0] is not None})
    up = {k: k for k in keys}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = top(rows[i][0]), top(rows[j][0])
                    up[max(x, y)] = min(x, y)
    out = Counter()
    for row, s in zip(rows, sets):
        name = None if row[0] is None else top(row[0])
        out[row[0], len(s), name, row[0] is None or name == row[0]] += 1
    return out


def answer(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def test_matches_brute_force(docs, rows):
    unlike = [r for r in rows if r[0] is not None]
    keys = Counter(r[0] for r in unlike)
    assert max(keys.values()) > 1  # repeated keys are in
    assert answer(neardup.near_duplicates(docs, shingle=4)) == brute(rows, 4)


@pytest.mark.parametrize("block", [3, 512])
def test_chains_and_large_groups(spark, monkeypatch, block):
    """A long chain of small edits, and a group whose copies are too unlike to link to one hub."""
    monkeypatch.setattr(neardup, "BLOCK_NODES", block)
    rng = random.Random(8)
    texts, words = [], sentence(rng, 120).split()
    for i in range(14):
        words = list(words)
        words[(i * 9) % 120] = f"new{i}"
        texts.append(" ".join(words))
    start = sentence(rng, 100).split()
    for i in range(25):
        copy = list(start)
        for p in rng.sample(range(100), 4):
            copy[p] = f"w{rng.randrange(3)}"
        texts.append(" ".join(copy))
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(neardup.near_duplicates(df, shingle=3)) == brute(rows, 3)


def test_empty_table(no_docs):
    assert neardup.near_duplicates(no_docs).collect() == []


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(2)
    for share in (0.8, 0.9, 0.97):
        errors = []
        for _ in range(20):
            both = rng.integers(0, 2**63, 800, dtype=np.uint64)
            own = int(800 * (1 - share) / (2 * share))
            sets = [np.unique(np.concatenate([both, rng.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(2)]
            flat, at = np.concatenate(sets), np.cumsum([0, len(sets[0]), len(sets[1])])
            sample = neardup.samples(flat, at)
            bits = neardup.odd_sketches(sample).view(np.uint64)
            ones = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
            assert ones <= neardup.most_ones(0.8)
            errors.append(float(neardup.estimate(np.array(ones))) - share)
        assert abs(np.mean(errors)) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_filter_on_the_ones_counts_once(spark):
    sketches = spark.createDataFrame([(i, bytes(neardup.SKETCH_BITS // 8)) for i in range(3)], "node long, sketch binary")
    pairs = neardup._sketched(spark.createDataFrame([(0, 1), (2, 1)], "node long, hub long"), sketches, 80)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, pairs.collect())) == [(0, 1, 0), (2, 1, 0)]
