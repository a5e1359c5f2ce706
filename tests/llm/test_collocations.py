"""Collocations against a plain count of all phrases."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeaudit.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, bucket int, score double"


def brute(rows, least, most=4, top=2000, covered=80, scale=2_000_000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in c.items():
            if any(100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in c.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((scale * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "É", "a\x1cb"]
    rows = []
    for i in range(300):
        n = rng.choice((0, 1, 5, 60))
        text = "".join(rng.choice(words[:rng.choice((6, 44))]) + rng.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n")) for _ in range(n))
        rows.append((text, rng.choice(("x", "y", None, "und", ""))))
    rows += [("new york city hall " * 4000, "x"), (None, None), (None, "x"), ("", "z"), (" \t.,;", "q")]
    rows += [("hot pair, hot pair", "x")] * 150
    return rows + rows[:20]


@pytest.mark.parametrize("least,block", [(30, 1 << 23), (3, 1 << 10), (1, 1 << 12)])
def test_result_equals_a_plain_count(spark, monkeypatch, least, block):
    rows = texts()
    df = spark.createDataFrame([(i, t, y, "p", 1, 2, 0.5) for i, (t, y) in enumerate(rows)], SCHEMA).repartition(3)
    # the blocks of a task are made in its worker; a small block is tested on the function itself
    monkeypatch.setattr(co, "BLOCK_BYTES", block)
    got = co.collocations(df, least=least, top=200)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top=200)


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(co, "BLOCK_BYTES", 100)
    text = ("one two three. four five " * 50).encode()
    parts = list(co._pieces(text))
    assert b"".join(parts) == text and len(parts) > 5 and all(p[:1] == b"." for p in parts[1:])
    assert list(co._pieces(b"x" * 1000)) == [b"x" * 1000]


def test_marks_never_lose_a_phrase(spark):
    phrases = [("x", f"a{i} b{i * 7 % 50}") for i in range(500)] + [("", "é ü"), ("x", "one two")]
    marks = co.mark(spark.createDataFrame(phrases, "lang string, phrase string"), 2)
    for lang, phrase in phrases:
        hashes = co.words_of(np.frombuffer(phrase.encode(), dtype=np.uint8))[2]
        assert marks.hold([hashes[:1], hashes[1:]], co._lang_hash(lang)).all()
    strange = co.words_of(np.frombuffer(" ".join(f"q{i}" for i in range(4000)).encode(), dtype=np.uint8))[2].reshape(-1, 2)
    assert marks.hold([strange[:, 0], strange[:, 1]], co._lang_hash("x")).mean() < 0.1


def test_a_block_is_worked_on_in_little_memory():
    rng = np.random.default_rng(4)
    text = " ".join(f"w{i}" for i in (rng.zipf(1.3, 400_000) % 60_000).tolist()).encode()
    tracemalloc.start()
    largest = 0
    for batch in co.block_stripes("x", text, None, range(1, 3)):
        largest = max(largest, batch.num_rows)
        del batch
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * len(text) and largest <= co.STRIPES_AT_A_TIME, (peak / len(text), largest)


def test_texts_of_a_batch_are_read_some_at_a_time():
    batch = pa.RecordBatch.from_pydict({"lang": ["x"] * 9000, "text": ["some words of a text " * 40] * 8999 + [None]})
    tracemalloc.start()
    rows = sum(1 for _ in co._rows(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 9000 and peak < 9000 * 800 / 4, peak
