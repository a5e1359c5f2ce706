"""Exact removal of repeated byte strings with suffix arrays built by two-stage sorting.

A window is ``window`` consecutive bytes of one text. Every byte of a window that also starts anywhere
else goes.

1. *Anchors.* The anchor of a window is the leftmost of its 64-byte grams with the least hash, so equal
   windows have equal anchors wherever they stand. Neighbouring windows with one anchor form a
   segment of at most twice a window. Equal segments are one row with a count from here on.
2. *Groups.* Segments are grouped by their anchor. A group of one segment that occurs once holds no
   repeat; all windows of a segment that occurs twice are repeats. What is left to find out are
   windows of segments that occur once, in groups of several segments.
3. *Suffix arrays.* Texts are dealt once; the segments of such groups are cut out and meet by anchor.
   Groups are joined up to about a megabyte and sorted in two stages: only suffixes smaller than
   their successor are sorted directly, all others follow from one scan over the buckets of first
   bytes. Neighbours of the array are compared for their common prefix; ``window`` bytes make a repeat.
4. *Hot groups.* A group of more than ``MOST_SEGMENTS`` different segments is split by its windows:
   each is known by its anchor, the anchor's place and a hash, and windows that occur once are counted out.
5. *Cut.* Only windows that occur once travel back, as runs, to their text, which no other row shares;
   all other windows are repeats.

Defined results
  * Texts are their UTF-8 bytes; null is empty. Cuts may fall inside a character, so what is left of a
    text is binary. Texts shorter than a window keep all bytes.
  * Repeated rows and equal texts are places of their own: both lose all their windows. Ids play no
    part and may be null or repeated. All columns are kept, but for those named like results.
  * An empty table gives no rows. Long texts are read in pieces that overlap by a window.
  * Segments and windows are told apart by two 64-bit hashes (anchor and content) together.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.durable import shared_folder
from lakeaudit.llm.common import _BASE, _byte_values, _powers, give_back, mix, ready, table, text_slices

WINDOW = 400
#: Bytes of a gram that can be an anchor.
GRAM = 64
#: Bytes read at a time, and bytes of segments in one suffix array.
CHUNK_BYTES = 1 << 18
ARRAY_BYTES = 1 << 19
#: Different segments of a group that may go into one array; larger groups are split by windows.
MOST_SEGMENTS = 2_048
#: Bytes of text of one dealt part, and parts at least.
PART_BYTES, LEAST_PARTS = 32 << 20, 32
#: Ends a segment in an array; no byte of UTF-8.
END = 0xFF
_PLACE = np.uint64((1 << 21) - 1)


# ---------------------------------------------------------------- anchors

class _Hashes:
    """Hashes of spans of one chunk of bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = _powers(pow(_BASE, -1, 2**64), n + 1)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[0][data] * _powers(_BASE, n), out=self.total[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        return mix((self.total[size:] - self.total[:-size]) * self.inverse[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def segments(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(text, start, run, anchor, place of the anchor from start, content) of the segments of all texts in a chunk.

    ``run`` windows begin at ``start`` and the bytes after it; the segment has ``run + window - 1`` bytes.
    """
    counts = np.maximum(np.diff(offsets) - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    empty = np.zeros(0, np.int64)
    if not len(text):
        return empty, empty, empty, np.zeros(0, np.uint64), empty, np.zeros(0, np.uint64)
    within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = offsets[:-1][text] + within
    hashes = _Hashes(data)
    grams = hashes.grams(gram)
    marked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_least(marked, window - gram + 1)[places] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    run = np.diff(np.append(first, len(at)))
    starts, anchor_at = places[first], at[first]
    content = hashes.spans(starts, starts + run + window - 1)
    return text[first], starts, run, grams[anchor_at], anchor_at - starts, content


def _chunks(column: pa.Array, window: int):
    """(numbers of texts, where each begins in its text, bytes, offsets): runs of texts, long ones in overlapping pieces."""
    for start, stop, data, offsets in text_slices(column, CHUNK_BYTES):
        if stop - start > 1 or len(data) <= 2 * CHUNK_BYTES:
            yield np.arange(start, stop), np.zeros(stop - start, np.int64), data, offsets
            continue
        # a segment that a cut ends is a shorter one with the same anchor, so windows still meet
        for begin in range(0, len(data) - window + 1, CHUNK_BYTES):
            part = data[begin:begin + CHUNK_BYTES + window - 1]
            yield np.array([start]), np.array([begin]), part, np.array([0, len(part)])


def _found(window: int):
    def run(batches):
        for batch in batches:
            own, spread = batch.column("_own").to_numpy(), batch.column("_spread").to_numpy()
            for numbers, begins, data, offsets in _chunks(batch.column("_text"), window):
                text, start, length, anchor, _, content = segments(data, offsets, window)
                if not len(text):
                    continue
                order = np.lexsort((content, anchor))
                a, c = anchor[order], content[order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])]))
                n = np.diff(np.append(first, len(a)))
                pick = order[first]
                at = text[pick]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[first].view(np.int64)), pa.array(c[first].view(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array(own[numbers[at]]), pa.array(spread[numbers[at]]),
                     pa.array((start[pick] - offsets[at] + begins[at]).astype(np.int64)), pa.array(length[pick].astype(np.int32))],
                    names=["anchor", "content", "n", "own", "spread", "start", "run"])
            give_back()
    return run


# ---------------------------------------------------------------- two-stage suffix sorting

def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes, ordered by their first ``depth`` bytes at least."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    # a suffix is small if it is smaller than its successor; equal bytes decide as the next differing pair
    differs = np.append(data[1:] != data[:-1], True)
    small_here = np.append(data[:-1] < data[1:], False)
    places = np.arange(n, dtype=np.int32)  # an array holds a few MB at most
    decides = np.minimum.accumulate(np.where(differs, places, np.int32(n))[::-1])[::-1]
    small = small_here[decides]

    # first stage: small suffixes, by buckets of two bytes
    direct = np.flatnonzero(small)
    pair = data[direct].astype(np.int32) * 256 + data[direct + 1]
    order = np.argsort(pair, kind="stable")
    direct, pair = direct[order], pair[order]
    raw = data.tobytes()
    cuts = np.concatenate([[0], np.flatnonzero(pair[1:] != pair[:-1]) + 1, [len(pair)]]).tolist()
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            direct[a:b] = sorted(direct[a:b].tolist(), key=lambda i: raw[i:i + depth])
    ends = np.searchsorted(data[direct], np.arange(257))

    # second stage: the others, from the scan of each bucket to those of their predecessors
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[n - 1]].append(np.array([n - 1]))  # precedes the empty suffix
    result = []
    for c in range(256):
        bucket = []
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(front):
            bucket.append(front)
            front = front[front > 0] - 1
            front = front[data[front] == c]
        bucket.append(direct[ends[c]:ends[c + 1]])
        scanned = np.concatenate(bucket)
        result.append(scanned)
        before = scanned[scanned > 0] - 1
        heads = data[before]
        before, heads = before[heads > c], heads[heads > c]
        if len(before):
            by_head = np.argsort(heads, kind="stable")
            before, heads = before[by_head], heads[by_head]
            steps = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
            for head, part in zip(heads[steps].tolist(), np.split(before, steps[1:])):
                waiting[head].append(part)
        waiting[c] = []
    return np.concatenate(result)


def common_prefixes(data: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths of pairs of suffixes, ``most`` at most, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.tobytes(), strides=(1,))
    out = np.full(len(left), most, dtype=np.int64)
    alive = np.arange(len(left))
    for depth in range(0, most, 8):
        apart = words[left[alive] + depth] ^ words[right[alive] + depth]
        stop = np.flatnonzero(apart)
        if len(stop):
            low = apart[stop] & (~apart[stop] + np.uint64(1))
            out[alive[stop]] = np.minimum(depth + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3), most)
            alive = alive[apart == 0]
        if not len(alive):
            break
    return np.minimum(out, len(data) - np.maximum(left, right))  # the padding is no match


def repeated_windows(parts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For every part, which of its windows occur again in any of the parts."""
    data = np.frombuffer(b"".join(x for p in parts for x in (p, bytes([END]))), dtype=np.uint8)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    counts = np.maximum(lengths - window + 1, 0)
    whole = np.zeros(len(data), dtype=bool)
    for a, n in zip(begins.tolist(), counts.tolist()):
        whole[a:a + n] = True
    order = suffix_array(data, window)
    order = order[whole[order]]
    again = np.zeros(len(data), dtype=bool)
    if len(order) > 1:
        same = common_prefixes(data, order[:-1], order[1:], window) >= window
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
    return [again[a:a + n] for a, n in zip(begins.tolist(), counts.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_ONCE = "own long, spread int, start long, run int"


def _once_batch(rows: list[tuple]) -> pa.RecordBatch:
    own, spread, start, run = ([r[i] for r in rows] for i in range(4))
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int64()), pa.array(spread, pa.int32()), pa.array(start, pa.int64()), pa.array(run, pa.int32())],
        names=["own", "spread", "start", "run"])


def _cut_out(window: int):
    """The bytes of the segments asked for."""
    names = ("anchor", "content", "different", "n")

    def run(batches):
        for batch in batches:
            asked, own, spread = batch.column("_asked"), batch.column("own"), batch.column("spread")
            for first, stop, data, offsets in text_slices(batch.column("_text"), CHUNK_BYTES):
                of_part = asked.slice(first, stop - first)
                wanted, of = of_part.flatten(), pc.list_parent_indices(of_part).to_numpy().astype(np.int64)
                start, count = wanted.field("start"), wanted.field("run").to_numpy()
                begins = offsets[of] + start.to_numpy()
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*[wanted.field(c) for c in names], own.take(pa.array(of + first)), spread.take(pa.array(of + first)), start,
                     pa.array([raw[a:b] for a, b in zip(begins.tolist(), (begins + count + window - 1).tolist())], pa.binary())],
                    names=[*names, "own", "spread", "start", "bytes"])
        give_back()
    return run


def _arrays(window: int):
    """Segments ordered by anchor to the windows that occur once."""
    def settle(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for (_, own, spread, start, n, _), again in zip(rows, repeated_windows([r[5] for r in rows], window)):
            if n == 1:
                out += [(own, spread, start + int(a), int(b - a)) for a, b in zip(*_runs(~again))]
        return _once_batch(out)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "own", "spread", "start", "n", "bytes")]
            for row in zip(*columns):
                if size >= ARRAY_BYTES and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield settle(held)
        give_back()
    return run


def _windows(window: int):
    """Segments of hot groups to one row per window: anchor, its place, hash, and where the window is."""
    def run(batches):
        for batch in batches:
            raw = batch.column("bytes").to_pylist()
            anchor, n, start = (batch.column(c).to_numpy() for c in ("anchor", "n", "start"))
            for i, part in enumerate(raw):
                hashes = _Hashes(np.frombuffer(part, dtype=np.uint8))
                count = len(part) - window + 1
                at = np.arange(count)
                # the anchor is the leftmost least gram of each of these windows
                place = int(np.flatnonzero(hashes.grams(GRAM).view(np.int64) == anchor[i])[0])
                same = lambda v, kind: pa.array(np.full(count, v), kind)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [same(anchor[i], pa.int64()), pa.array((place - at).astype(np.int32)),
                     pa.array(hashes.spans(at, at + window).view(np.int64)), same(n[i], pa.int64()),
                     same(batch.column("own")[i].as_py(), pa.int64()), same(batch.column("spread")[i].as_py(), pa.int32()),
                     pa.array(start[i] + at)],
                    names=["anchor", "place", "hash", "n", "own", "spread", "start"])
    return run


def _cut(window: int):
    def parts(batches):
        for batch in batches:
            for start, stop, _, _ in text_slices(batch.column("_text"), CHUNK_BYTES):
                yield batch.slice(start, stop - start)

    def run(batches):
        for batch in parts(batches):
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            once = batch.column("_once").to_pylist()
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, single in zip(texts, once):
                text = text or b""
                n = len(text)
                repeat = np.ones(max(n - window + 1, 0), dtype=bool)
                for r in single or ():
                    repeat[r["start"]:r["start"] + r["run"]] = False
                gone = np.zeros(n, dtype=bool)
                for a, b in zip(*_runs(repeat)):
                    gone[a:b + window - 1] = True
                spans = _runs(gone)
                n_bytes.append(n)
                n_removed.append(int(gone.sum()))
                n_spans.append(len(spans[0]))
                kept.append(text if not len(spans[0]) else np.frombuffer(text, dtype=np.uint8)[~gone].tobytes())
            rest = [batch.column(c) for c in batch.schema.names if c.startswith("_rest")]
            names = [c for c in batch.schema.names if c.startswith("_rest")]
            yield pa.RecordBatch.from_arrays(
                [*rest, batch.column("_text"), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64())],
                names=[*names, "_text", "kept", "n_bytes", "n_removed", "n_spans"])
        give_back()
    return run


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, text_col: str = "text",
                          most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """Every row with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    if window < GRAM:
        raise ValueError(f"a window has {GRAM} bytes at least")
    spark = ready(docs.sparkSession)
    results = ("kept", "n_bytes", "n_removed", "n_spans")
    rest = [c for c in docs.columns if c != text_col and c not in results]
    text = F.col(text_col).cast("string")
    slim = docs.select(*[F.col(c).alias(f"_rest{i}") for i, c in enumerate(rest)], text.alias("_text"))
    # a text is known by its hash and, so that copies do not meet in one task, by the row's other columns
    others = [f"_rest{i}" for i in range(len(rest))]
    slim = slim.withColumn("_own", F.xxhash64("_text")).withColumn("_spread", F.hash(*others) if others else F.lit(0))

    folder = f"{shared_folder(spark)}/segments-{uuid.uuid4().hex[:12]}"
    found = slim.select("_own", "_spread", "_text").mapInArrow(
        _found(window), "anchor long, content long, n long, own long, spread int, start long, run int")
    one = F.min(F.struct("own", "spread", "start", "run"))
    found.groupBy("anchor", "content").agg(F.sum("n").alias("n"), one.alias("at")).select(
        "anchor", "content", "n", "at.*").write.parquet(folder)
    distinct = spark.read.parquet(folder)
    groups = distinct.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("different"), one.alias("at"))
    alone = groups.where(F.col("total") == 1).select("at.*")
    open_groups = groups.where(F.col("different") > 1).select("anchor", "different")
    asked = distinct.join(open_groups, "anchor")

    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-size // PART_BYTES))
    dealt = slim.repartition(parts, "_own", "_spread")
    where = [F.col("_own") == F.col("own"), F.col("_spread") == F.col("spread")]
    asked = asked.groupBy("own", "spread").agg(
        F.collect_list(F.struct("anchor", "content", "different", "n", "start", "run")).alias("_asked"))
    # both joins with the texts read the same columns, so the texts are dealt once for both
    cut_out = dealt.join(asked, where).mapInArrow(
        _cut_out(window), "anchor long, content long, different long, n long, own long, spread int, start long, bytes binary")
    few = cut_out.where(F.col("different") <= most_segments).repartition("anchor").sortWithinPartitions("anchor", "content")
    few = few.select("anchor", "content", "own", "spread", "start", "n", "bytes")
    settled = few.mapInArrow(_arrays(window), _ONCE)
    hot = cut_out.where(F.col("different") > most_segments)
    by_window = hot.select("anchor", "n", "own", "spread", "start", "bytes").mapInArrow(
        _windows(window), "anchor long, place int, hash long, n long, own long, spread int, start long")
    single = by_window.groupBy("anchor", "place", "hash").agg(
        F.sum("n").alias("n"), F.min(F.struct("own", "spread", "start")).alias("at"))
    single = single.where(F.col("n") == 1).select("at.*", F.lit(1).alias("run"))

    once = alone.unionByName(settled).unionByName(single)
    once = once.groupBy("own", "spread").agg(F.collect_list(F.struct("start", "run")).alias("_once"))
    joined = dealt.join(once, where, "left").drop("own", "spread", "_own", "_spread")
    fields = [f"_rest{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)]
    done = joined.mapInArrow(_cut(window), ", ".join(
        [*fields, "_text string, kept binary, n_bytes long, n_removed long, n_spans long"]))
    names = {c: f"_rest{i}" for i, c in enumerate(rest)} | {text_col: "_text"}
    return done.select(*[F.col(names[c]).alias(c) for c in docs.columns if c in names], *results)


def op11(spark, sf_dir: str) -> DataFrame:
    done = remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
