"""Exact substring de-duplication against brute force."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeaudit.llm import substrings
from lakeaudit.llm.common import pack_sorted, unpack_sorted


def brute(rows, window):
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for key, words in split:
        if key is not None:
            for i in range(len(words) - window + 1):
                w = tuple(words[i:i + window])
                first[w] = min(first.get(w, key), key)
    out = Counter()
    for (key, words), row in zip(split, rows):
        gone = set()
        for i in range(len(words) - window + 1) if key is not None else ():
            if first[tuple(words[i:i + window])] < key:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out[key, None if row[1] is None else kept, len(words), len(gone), row[2]] += 1
    return out


@pytest.mark.parametrize("window", [50, 8])
def test_matches_brute_force(docs, rows, window):
    got = substrings.remove_repeats(docs, window).collect()
    assert Counter((r["doc_id"], r["text"], r["n_words"], r["n_removed"], r["lang"]) for r in got) == brute(rows, window)
    assert sum(r["n_removed"] > 0 for r in got) > 10


def test_untouched_texts_stay_as_they_are(docs, rows):
    got = substrings.remove_repeats(docs, as_is=True).where("n_removed = 0").collect()
    assert {r["text"] for r in got} <= {r[1] for r in rows}


def test_columns_and_empty_table(docs, no_docs):
    out = substrings.remove_repeats(no_docs)
    assert out.columns == [c for c in docs.columns if c != "n_words"] + ["n_words", "n_removed"]
    assert out.collect() == []


def test_same_documents_are_read_from_one_shuffle(docs):
    df = substrings.remove_repeats(docs)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2


def test_packed_integers_come_back():
    rng = np.random.default_rng(1)
    for bits, n in ((48, 5), (20, 3000), (64, 400), (64, 1)):
        values = np.unique(rng.integers(0, 2**bits - 1, n, dtype=np.uint64))
        assert (unpack_sorted(pack_sorted(values)) == values).all()
    assert len(unpack_sorted(pack_sorted(np.zeros(0, np.uint64)))) == 0


def test_a_hash_range_holds_little_more_than_its_hits():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 48, 200, dtype=np.uint64)
    probes = [np.unique(np.concatenate([rng.integers(0, 1 << 48, 12_000, dtype=np.uint64), common])) for _ in range(40)]
    probes.append(np.unique(common[:5]))
    rows = pa.table({
        "_range": pa.array([0] * 41, pa.int64()), "_batch": pa.array(range(41), pa.int64()),
        "probes": pa.array([pack_sorted(p) for p in probes], pa.binary()),
        "blocks": pa.array([pack_sorted(p[::25]) for p in probes[:-1]] + [b""], pa.binary())})
    tracemalloc.start()
    out = substrings._match((pa.scalar(0),), rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    count, indexed = Counter(h for p in probes for h in p.tolist()), {h for p in probes[:-1] for h in p[::25].tolist()}
    wanted = {i: [h for h in p.tolist() if count[h] > 1 and h in indexed] for i, p in enumerate(probes)}
    assert {r["_batch"]: unpack_sorted(r["hits"]).tolist() for r in out.to_pylist()} == {i: h for i, h in wanted.items() if h}
    assert peak < 2 * rows.nbytes, peak / rows.nbytes
