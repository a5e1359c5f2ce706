"""Product codes: the tree search against brute force, and the operator on awkward tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeaudit.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, entry long, _v string"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error) by plain integers, and the codebooks."""
    kept = [(i, [int(np.floor(scale * x)) if abs(x) < 2**53 else int(x) * scale for x in v])
            for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])
    same = [r for r in kept if len(r[1]) == length]
    cuts = [i * length // parts for i in range(parts + 1)]
    cut = [[v[a:b] for _, v in same] for a, b in zip(cuts, cuts[1:])]
    books = [list(c[:entries]) for c in cut]

    def nearest(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k, c in enumerate(cut):
            groups = {}
            for p in c:
                groups.setdefault(nearest(p, books[k])[1], []).append(p)
            for e, ps in groups.items():
                books[k][e] = [sum(col) // len(ps) for col in zip(*ps)]
    out = []
    for r, (i, _) in enumerate(same):
        found = [nearest(cut[k][r], books[k]) for k in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), min(sum(d for d, _ in found), 2**63 - 1)))
    return out + [(i, None, None) for i, v in kept if len(v) != length], books


@pytest.mark.parametrize("width,spread", [(1, 3), (2, 4), (8, 500), (16, 40), (0, 1)])
def test_tree_finds_the_nearest_entry(width, spread):
    rng = np.random.default_rng(width)
    entries = rng.integers(-spread, spread + 1, (256, width)).astype(np.float64)
    queries = np.vstack([rng.integers(-2 * spread, 2 * spread + 1, (500, width)), entries]).astype(np.float64)
    entry, square, _ = codes.nearest_entries(queries, entries, codes.Node(np.arange(256), entries))
    every = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (square == every.min(axis=1)).all()


def test_tree_passes_over_subtrees():
    rng = np.random.default_rng(3)
    entries = np.repeat(rng.integers(-10_000, 10_000, (32, 16)), 8, axis=0) + rng.integers(-20, 20, (256, 16))
    entries = entries.astype(np.float64)
    queries = entries + rng.integers(-5, 6, entries.shape)
    tree = codes.Node(np.arange(256), entries)
    entry, _, counted = codes.nearest_entries(queries, entries, tree)
    every = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and counted < 0.5 * every.size


def table_rows(rng, n, length, spread=1.0):
    rows = [(i, [float(x) for x in rng.normal(0, spread, length)], i % 3 if i % 5 else None) for i in range(n)]
    return rows + [rows[3], (rows[4][0], rows[9][1], 1), (n, None, 1), (n + 1, [float("nan")] * length, 1), (n + 2, [None] * length, 2),
                   (None, rows[2][1], None), (n + 3, [1.0] * (length + 1), 2)]


@pytest.mark.parametrize("n,length,spread", [(400, 8, 1.0), (40, 6, 1.0), (30, 4, 1e12), (300, 4, 0.002)])
def test_codes_equal_brute_force(spark, n, length, spread):
    rows = table_rows(np.random.default_rng(n), n, length, spread)
    df = spark.createDataFrame([(i, v, y, "c", 5, "x") for i, v, y in rows], SCHEMA).repartition(4)
    coded, books = codes.product_codes(df, entries=64)
    want, want_books = brute([(i, v) for i, v, _ in rows], entries=64)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or 0)
    assert sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=key) == sorted(want, key=key)
    assert books.entries == want_books


def test_empty_tables_and_empty_vectors(spark):
    coded, books = codes.product_codes(spark.createDataFrame([], SCHEMA))
    assert coded.count() == 0 and books.entries == [[], [], [], []]
    coded, _ = codes.product_codes(spark.createDataFrame([(1, [], 1, "", 1, ""), (2, [], 1, "", 1, "")], SCHEMA))
    assert [(r.code, r.error) for r in coded.collect()] == [("00000000", 0)] * 2


def test_label_errors_sum_over_null_labels(spark, tmp_path):
    rows = table_rows(np.random.default_rng(1), 50, 8)
    df = spark.createDataFrame([(i, v, y, "c", 5, "x") for i, v, y in rows], SCHEMA)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = codes.op12(spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    labels = {}
    want, _ = brute([(i, v) for i, v, _ in rows])
    assert got.where(F.col("code").isNotNull()).count() == len([w for w in want if w[1]])
    by_id = {(i, tuple(v) if v else None): y for i, v, y in rows}
    for r in codes.product_codes(df)[0].collect():
        labels[r.label] = labels.get(r.label, 0) + (r.error or 0)
    assert {r.label_error for r in got.collect()} == set(labels.values()) and None in by_id.values()
