"""Exact substring de-duplication over words with fixed-block anchors.

A repeat of ``window`` words contains, wherever it begins, a whole block of ``window / 2`` words that
starts at a multiple of that length in the reference document. So:

1. Documents are dealt into batches by a hash of key and text. A batch sends the hashes of all its
   rolling windows of one block length (the probes) and of its non-overlapping blocks (the index) to
   hash ranges, each hash once per batch: a passage that a third of the documents share costs one
   entry per batch, not one per document.
2. A hash range finds the probes of two batches or more that hit an indexed block and answers the
   batches; hits inside one batch need no question.
3. Hits are extended: windows of full length around hits are compared exactly by their own hash. Each
   hash range learns the least document that such a window starts in and answers the batches that
   have it in later documents. Neighbouring windows add up to the maximal repeats.
4. Every batch removes the words that its windows with an earlier document cover.

The three visits of a batch read the same shuffled documents. Batches and hash ranges hold a fixed
amount of text and hashes, whatever the size of the corpus (their number grows with it).

Defined results
  * A word is a run of characters other than \\x20 and \\x09 to \\x0D. Null or empty texts have none.
  * Windows are judged on the input. Rows with one key are one document to each other: neither is
    earlier. Rows with a null key are never a reference and keep all their words.
  * The kept text is the kept words joined by one space; null stays null.
  * Windows are equal if their 64-bit hashes are (block hits use 48 bits and are only candidates).
  * ``n_words`` and ``n_removed`` replace columns of these names; other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import (
    give_back, pack_sorted, ready, run_starts, table, text_slices, unpack_sorted, window_hashes, word_hashes)

WINDOW = 50
#: Bytes of text in a batch; there are some batches at least, so that small tables too are spread.
BATCH_BYTES = 4 << 20
LEAST_BATCHES = 64
#: Batches whose hashes fill one hash range.
BATCHES_PER_RANGE = 4
LEAST_RANGES = 32

_NO_KEY = np.iinfo(np.int64).max


def _ranges(hashes: np.ndarray, bits: int, ranges: int):
    """(range, slice) of sorted ``bits``-bit hashes."""
    own = ((hashes >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)
    starts = run_starts(own)
    for a, b in zip(starts, [*starts[1:], len(own)]):
        yield int(own[a]), slice(int(a), int(b))


class _Batch:
    """Windows of the texts in a batch that have at least one full window."""

    def __init__(self, rows: pa.Table, window: int):
        self.block = window // 2
        texts = rows.column("_text").combine_chunks()
        keys = rows.column("_key").combine_chunks()
        ids = keys.fill_null(_NO_KEY).to_numpy(zero_copy_only=False)
        self.n_words = np.zeros(rows.num_rows, dtype=np.int64)
        self.parts = []
        for start, stop, data, offsets in text_slices(texts):
            words, at = word_hashes(data, offsets)
            counts = np.diff(at)
            self.n_words[start:stop] = counts
            full = np.maximum(counts - window + 1, 0)
            if full.any():
                self.parts.append((start, words, at, counts, full, ids[start:stop]))

    @staticmethod
    def _spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        return first[text] + within, within

    def anchors(self):
        """Per part: (places of rolling block windows, their 48-bit hashes, whether a block starts there)."""
        for _, words, at, counts, full, _ in self.parts:
            places, within = self._spread(at[:-1], np.where(full > 0, counts - self.block + 1, 0))
            yield places, window_hashes(words, self.block)[places] >> np.uint64(16), within % self.block == 0


def _probe(window: int, ranges: int):
    def send(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        give_back()
        probes, blocks = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for _, hashes, aligned in _Batch(rows, window).anchors():
            probes.append(np.unique(hashes))
            blocks.append(hashes[aligned])
        all_probes, all_blocks = np.unique(np.concatenate(probes)), np.unique(np.concatenate(blocks))
        index = {r: pack_sorted(all_blocks[s]) for r, s in _ranges(all_blocks, 48, ranges)}
        out = [(r, pack_sorted(all_probes[s]), index.get(r, b"")) for r, s in _ranges(all_probes, 48, ranges)]
        return pa.table({
            "_range": pa.array([o[0] for o in out], pa.int64()),
            "_batch": pa.array([key[0].as_py()] * len(out), pa.int64()),
            "probes": pa.array([o[1] for o in out], pa.binary()), "blocks": pa.array([o[2] for o in out], pa.binary())})
    return send


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Those of the hashes that are among the sorted known ones."""
    if not len(known):
        return hashes[:0]
    return hashes[known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes]


def _match(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Probes of two batches or more that hit an indexed block, for each batch that has them."""
    give_back()
    batches = rows.column("_batch").to_numpy()
    blocks = np.unique(np.concatenate([unpack_sorted(b.as_py()) for b in rows.column("blocks")]))
    # most probes hit no block: those go before the batches are put together
    probes = [_among(unpack_sorted(b.as_py()), blocks) for b in rows.column("probes")]
    hashes = np.concatenate(probes)
    owner = np.repeat(np.arange(len(probes), dtype=np.int32), [len(p) for p in probes])
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    starts = run_starts(hashes)
    sizes = np.diff([*starts, len(hashes)])
    chosen = np.repeat(sizes > 1, sizes)
    hashes, owner = hashes[chosen], owner[chosen]
    order = np.argsort(owner, kind="stable")  # hashes stay sorted within an owner
    hashes, owner = hashes[order], owner[order]
    starts = run_starts(owner)
    ends = [*starts[1:], len(owner)]
    return pa.table({
        "_batch": pa.array([int(batches[owner[a]]) for a in starts], pa.int64()),
        "hits": pa.array([pack_sorted(hashes[a:b]) for a, b in zip(starts, ends)], pa.binary())})


def _extend(window: int, ranges: int):
    def send(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        batch = _Batch(rows, window)
        anchors = list(batch.anchors())
        # hits: what the hash ranges answered, and indexed blocks found twice in this batch
        hits = [unpack_sorted(b) for b in answers.column("hits").to_pylist()]
        if anchors:
            own, counts = np.unique(np.concatenate([a[1] for a in anchors]), return_counts=True)
            index = np.unique(np.concatenate([a[1][a[2]] for a in anchors]))
            hits.append(np.intersect1d(own[counts > 1], index, assume_unique=True))
        known = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.uint64)
        found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for (_, words, at, _, full, ids), (places, hashes, _) in zip(batch.parts, anchors):
            hit = np.zeros(len(words) + 1, dtype=np.int64)
            hit[places[np.isin(hashes, known)] + 1] = 1
            before = np.cumsum(hit)  # hits among the windows that start before a place
            starts, _ = batch._spread(at[:-1], full)
            inside = before[starts + window - batch.block + 1] > before[starts]
            starts = starts[inside]
            found.append(window_hashes(words, window)[starts])
            owners.append(np.repeat(ids, full)[inside])
        hashes, owner = np.concatenate(found), np.concatenate(owners)
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        first = run_starts(hashes)
        hashes, owner = hashes[first], owner[first]
        out = [(r, pack_sorted(hashes[s]), owner[s]) for r, s in _ranges(hashes, 64, ranges)]
        return pa.table({
            "_range": pa.array([o[0] for o in out], pa.int64()),
            "_batch": pa.array([key[0].as_py()] * len(out), pa.int64()),
            "windows": pa.array([o[1] for o in out], pa.binary()),
            "owners": pa.array([o[2].tobytes() for o in out], pa.binary())})
    return send


def _least(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """For each batch: its windows that start in an earlier document of another batch, and that one."""
    give_back()
    batches = rows.column("_batch").to_numpy()
    windows = [unpack_sorted(b) for b in rows.column("windows").to_pylist()]
    owners = np.concatenate([np.frombuffer(b, np.int64) for b in rows.column("owners").to_pylist()])
    hashes = np.concatenate(windows)
    source = np.repeat(np.arange(len(windows), dtype=np.int32), [len(w) for w in windows])
    order = np.lexsort((owners, hashes))
    hashes, owners, source = hashes[order], owners[order], source[order]
    starts = run_starts(hashes)
    least = np.repeat(owners[starts], np.diff([*starts, len(hashes)]))
    later = least < owners
    hashes, least, source = hashes[later], least[later], source[later]
    order = np.argsort(source, kind="stable")
    hashes, least, source = hashes[order], least[order], source[order]
    starts = run_starts(source)
    ends = [*starts[1:], len(source)]
    return pa.table({
        "_batch": pa.array([int(batches[source[a]]) for a in starts], pa.int64()),
        "windows": pa.array([pack_sorted(hashes[a:b]) for a, b in zip(starts, ends)], pa.binary()),
        "owners": pa.array([least[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})


def _remove(window: int, as_is: bool):
    def cut(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        batch = _Batch(rows, window)
        hashes = [unpack_sorted(b) for b in answers.column("windows").to_pylist()]
        owners = [np.frombuffer(b, np.int64) for b in answers.column("owners").to_pylist()]
        starts, own = [], []
        for _, words, at, _, full, ids in batch.parts:
            places, _ = batch._spread(at[:-1], full)
            starts.append(places)
            own.append((window_hashes(words, window)[places], np.repeat(ids, full)))
        all_hashes = np.concatenate([np.zeros(0, np.uint64), *[o[0] for o in own], *hashes])
        all_owners = np.concatenate([np.zeros(0, np.int64), *[o[1] for o in own], *owners])
        order = np.lexsort((all_owners, all_hashes))
        first = run_starts(all_hashes[order])
        known, least = all_hashes[order][first], all_owners[order][first]
        removed = np.zeros(rows.num_rows, dtype=np.int64)
        texts = rows.column("_text").combine_chunks().cast(pa.large_string())
        covered: dict[int, np.ndarray] = {}
        for (start, words, at, counts, full, ids), places, (h, o) in zip(batch.parts, starts, own):
            repeat = (least[np.searchsorted(known, h)] < o) & (o != _NO_KEY)
            step = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(step, places[repeat], 1)
            np.subtract.at(step, places[repeat] + window, 1)
            gone = np.cumsum(step)[:-1] > 0
            totals = np.concatenate([[0], np.cumsum(gone)])
            part = totals[at[1:]] - totals[at[:-1]]
            removed[start:start + len(part)] = part
            for i in np.flatnonzero(part):
                covered[start + int(i)] = gone[at[i]:at[i + 1]]
        kept = []
        for i, text in enumerate(texts.to_pylist()):
            if text is not None and (i in covered or not as_is):
                words = text.encode("utf-8").split()
                if i in covered:
                    words = [w for w, g in zip(words, covered[i].tolist()) if not g]
                text = b" ".join(words).decode("utf-8")
            kept.append(text)
        columns = {"_key": rows.column("_key"), "_text": pa.array(kept, pa.large_string()).cast(pa.string()),
                   "n_words": pa.array(batch.n_words), "n_removed": pa.array(removed)}
        return pa.table(columns | {c: rows.column(c) for c in rows.column_names if c.startswith("_rest")})
    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   as_is: bool = False) -> DataFrame:
    """Every row with its kept words as text, and ``n_words`` and ``n_removed``; ``window`` is even.

    ``as_is`` leaves texts that lose no word as they are, white space included.
    """
    if window % 2 or window < 4:
        raise ValueError("the window must be an even number of words, four at least")
    ready(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (id_col, text_col, "n_words", "n_removed")]
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    batches = max(LEAST_BATCHES, -(-size // BATCH_BYTES))
    ranges = max(LEAST_RANGES, -(-batches // BATCHES_PER_RANGE))
    slim = docs.select(
        F.col(id_col).cast("long").alias("_key"), F.col(text_col).cast("string").alias("_text"),
        *[F.col(c).alias(f"_rest{i}") for i, c in enumerate(rest)])
    dealt = slim.withColumn("_batch", F.pmod(F.xxhash64("_key", "_text"), F.lit(batches)))
    by_batch = dealt.groupBy("_batch")
    probes = by_batch.applyInArrow(_probe(window, ranges), "_range long, _batch long, probes binary, blocks binary")
    hits = probes.groupBy("_range").applyInArrow(_match, "_batch long, hits binary")
    windows = by_batch.cogroup(hits.groupBy("_batch")).applyInArrow(
        _extend(window, ranges), "_range long, _batch long, windows binary, owners binary")
    least = windows.groupBy("_range").applyInArrow(_least, "_batch long, windows binary, owners binary")
    fields = [f"_rest{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)]
    schema = ", ".join(["_key long, _text string, n_words long, n_removed long", *fields])
    done = by_batch.cogroup(least.groupBy("_batch")).applyInArrow(_remove(window, as_is), schema)
    names = {c: f"_rest{i}" for i, c in enumerate(rest)} | {id_col: "_key", text_col: "_text"}
    kept = [F.col(names[c]).alias(c) for c in docs.columns if c in names]
    return done.select(*kept, "n_words", "n_removed")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = remove_repeats(docs)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), starts AS (
  SELECT row_no, doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM d WHERE len(words) >= 50
), windows AS (
  SELECT row_no, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w FROM starts
), least AS (
  SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w
), hit AS (
  SELECT row_no, i FROM windows JOIN least USING (w) WHERE first_doc < doc_id
), gone AS (
  SELECT DISTINCT row_no, i + j AS place FROM hit, range(50) AS r(j)
), word AS (
  SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d
), kept AS (
  SELECT row_no, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (row_no, place) GROUP BY row_no
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row_no)
"""
