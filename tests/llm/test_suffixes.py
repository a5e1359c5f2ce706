"""Repeated byte strings: the suffix array against sorting, and the operator against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lakeaudit.llm import suffixes as sx

SCHEMA = "doc_id long, text string, kept string, own long, _text string, anchor int"


def brute(texts, window):
    """(bytes, removed, spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("alphabet,n", [(2, 400), (3, 2000), (26, 3000), (1, 50), (255, 500)])
def test_suffix_array_equals_sorting(alphabet, n):
    rng = np.random.default_rng(n)
    for data in (rng.integers(0, alphabet, n).astype(np.uint8), np.tile(rng.integers(0, alphabet, 7), n // 7).astype(np.uint8)):
        raw = data.tobytes()
        got = sx.suffix_array(data, 10_000)
        assert got.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shallow = sx.suffix_array(data, 5)
        assert [raw[i:i + 5] for i in shallow] == sorted(raw[i:i + 5] for i in range(len(raw)))
        lcp = sx.common_prefixes(data, got[:-1], got[1:], 100)
        for a, b, common in zip(got[:-1].tolist(), got[1:].tolist(), lcp.tolist()):
            assert raw[a:a + common] == raw[b:b + common] and (common == 100 or raw[a + common:a + common + 1] != raw[b + common:b + common + 1])


def texts(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefghij é\n") for _ in range(n))

    shared, inner = prose(500), prose(150)
    rows = [prose(rng.choice((0, 10, 90, 700))) for _ in range(25)]
    rows += [prose(60) + shared + prose(60) for _ in range(40)]                       # a hot passage, other borders
    rows += [rows[3], rows[3], None, None, "", shared, "a" * 900, "ab" * 300, "z" * 130, "é" * 400]
    rows += [prose(50) + inner + prose(30) + inner, inner[:140] + prose(20), prose(3000) + shared[100:330] + prose(2000)]
    rows += [shared[:i] + "X" + shared[i:] for i in range(20, 480, 25)]               # near copies
    return rows


@pytest.mark.parametrize("window,most,chunk", [(100, 2048, 1 << 19), (100, 4, 700), (128, 1, 1 << 19), (64, 2048, 1 << 10), (400, 8, 1 << 19)])
def test_result_equals_brute_force(spark, monkeypatch, window, most, chunk):
    rows = texts(window)
    monkeypatch.setattr(sx, "CHUNK_BYTES", chunk)
    data = [(None if i % 9 == 0 else i % 50, t, "k", i % 2, "t", 3) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    done = sx.remove_repeated_bytes(docs, window, most_segments=most)
    assert done.columns == ["doc_id", "text", "own", "_text", "anchor", "kept", "n_bytes", "n_removed", "n_spans"]
    got = sorted((r.text or "", r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in done.collect())
    assert got == sorted((t or "", *b) for t, b in zip(rows, brute(rows, window)))


@pytest.mark.parametrize("chunk", [300, 1000])
def test_pieces_of_long_texts_hold_every_window_once(monkeypatch, chunk):
    import pyarrow as pa

    monkeypatch.setattr(sx, "CHUNK_BYTES", chunk)
    rng = random.Random(1)
    column = ["".join(rng.choice("abc") for _ in range(n)) for n in (5000, 50, 120, 0, 2999, 700)]
    seen = Counter()
    for numbers, begins, data, offsets in sx._chunks(pa.array(column), 100):
        text, start, run, *_ = sx.segments(data, offsets, 100)
        for t, s, n in zip(text, start, run):
            for i in range(n):
                seen[(int(numbers[t]), int(begins[t] + s - offsets[t] + i))] += 1
    assert seen == Counter((i, j) for i, t in enumerate(column) for j in range(len(t) - 99))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    common = bytes(rng.choice(b"ab") for _ in range(400))
    parts = [bytes(rng.choice(b"ab") for _ in range(n)) + common + bytes(rng.choice(b"ab") for _ in range(9)) for n in (0, 33, 500)]
    found = []
    for p in parts:
        data = np.frombuffer(p, dtype=np.uint8)
        _, start, run, anchor, place, _ = sx.segments(data, np.array([0, len(p)]))
        at = p.index(common)
        found.append([(a, pl + s - at) for s, n, a, pl in zip(start, run, anchor, place) if s <= at < s + n])
    assert found[0] == found[1] == found[2] and len(found[0]) == 1


def test_empty_table_and_digest(spark, tmp_path):
    assert sx.remove_repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "x" * 500), (2, "é" + "y" * 399), (3, "é" + "y" * 399), (4, None), (5, "short")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {(i, *b[:3], hashlib.sha256(b[3]).hexdigest()) for (i, _), b in zip(rows, brute([t for _, t in rows], 400))}
    got = sx.op11(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and set(map(tuple, got.collect())) == want


def test_workers_pass_on_runs_of_texts_not_whole_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sx, "CHUNK_BYTES", 3000)
    rng = random.Random(7)
    rows = ["".join(rng.choice("abcé") for _ in range(500)) for _ in range(40)]
    once = pa.array([[{"start": 5, "run": 10}] if i % 2 else None for i in range(40)], pa.list_(pa.struct([("start", pa.int64()), ("run", pa.int32())])))
    out = list(sx._cut(100)([pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(rows), once], names=["_rest0", "_text", "_once"])]))
    assert len(out) > 5 and max(b.column("_text").nbytes for b in out) < 6000
    assert [t for b in out for t in b.column("_text").to_pylist()] == rows
    assert [n for b in out for n in b.column("n_bytes").to_pylist()] == [len(t.encode()) for t in rows]

    wanted = [[{"anchor": i, "content": -i, "different": 2, "n": 1, "start": j, "run": 3} for j in range(i % 4)] for i in range(40)]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("anchor", "content", "different", "n", "start")] + [("run", pa.int32())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(rows), pa.array(range(40)), pa.array(range(40), pa.int32()), pa.array(wanted, kind)], names=["_text", "own", "spread", "_asked"])
    out = list(sx._cut_out(100)([batch.slice(1)]))
    assert 5 < len(out) < 20
    got = [r for b in out for r in b.to_pylist()]
    assert [(r["own"], r["spread"], r["anchor"], r["content"], r["start"], r["bytes"]) for r in got] == [
        (i, i, i, -i, j, rows[i].encode()[j:j + 102]) for i in range(1, 40) for j in range(i % 4)]
