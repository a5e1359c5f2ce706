"""Collocations from stripes: every prefix keys an associative counter of its next words.

A task reads its texts in blocks and gives, for every prefix of no, one, two or three words, one
stripe per bucket of next words: the next words and how often each followed. Stripes with equal
prefix and bucket meet in one partition and are merged element by element. Everything else is read
from the merged structure: an entry is a phrase and its count, so the count of a prefix is an entry
of the stripe one word shorter, a phrase's extensions to the right are the entries of its own
stripe and those to the left the entries whose phrase without its first word it is. Since a longer
phrase is never more frequent than the phrase between, the largest count over extensions by one word
to either side decides about all longer phrases that contain a candidate.

Phrases of three and four words are counted only where every pair of neighbouring words, and then
every triple, can be frequent: a bitmap of bounded size (``MOST_BITS``) marks the frequent phrases
that are one word shorter. A marked place too many costs a row that the threshold takes away later; it never changes
a count. A stripe is split by the hash of the next word, so a hot prefix spreads over many tasks.

Defined results
  * Null and empty texts have no words. A null language is the language ``und``.
  * Repeated rows count each. Ties are broken by the order of the result, which is total.
  * Whole texts are counted, a long one in blocks cut between pieces. An empty table gives no rows.
  * Words are told apart by 64-bit hashes within a block and by their text everywhere else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import _byte_values, _powers, _BASE, durable, give_back, mix, ready, run_starts, salted_join

#: Fixed by the contract: what ends a piece, and what separates words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: Bytes of text that a block holds, and bytes hashed at a time.
BLOCK_BYTES = 1 << 23
HASH_BYTES = 1 << 20
#: Rows read, and stripes given, at a time, so that a worker and the JVM hold little of them.
ROWS_AT_A_TIME, STRIPES_AT_A_TIME = 256, 1 << 14
#: Buckets of next words: of the empty prefix, which every word follows, and of any other.
ROOT_BUCKETS, BUCKETS = 1024, 16
#: Bits of the marks of frequent phrases: 32 a phrase, up to 32 MB.
LEAST_BITS, MOST_BITS = 16, 28
_SEGMENT = 16

STRIPES = "lang string, k int, prefix string, bucket int, next array<string>, n array<long>"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = re.compile(b"[" + re.escape(BREAKS) + b"]")


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in order, some at a time so that the powers stay small."""
    out = np.empty(len(starts), dtype=np.uint64)
    values, i = _byte_values()[0], 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")), i + 1)
        base = starts[i]
        part = values[data[base:ends[j - 1]]] * _powers(_BASE, ends[j - 1] - base)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
        inverse = _powers(pow(_BASE, -1, 2**64), ends[j - 1] - base)
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return out


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, joined): the words of lower-cased bytes; joined: the next word is in the same piece."""
    kind = _KIND[data]
    inside = np.concatenate([[False], kind == 0, [False]])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)  # breaks before each word: no number per byte
    return starts, ends, _span_hashes(data, starts, ends), piece[1:] == piece[:-1]


def _lang_hash(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), dtype=np.uint8)
    return _span_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0] if len(raw) else np.uint64(1)


def _place(hashes: list[np.ndarray], lang: np.uint64, bits: int) -> np.ndarray:
    """The place of each phrase, given the hashes of its words, among 2**bits marks."""
    x = np.full(len(hashes[0]), lang, dtype=np.uint64)
    for h in hashes:
        x = mix(x * np.uint64(_BASE) + h)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


class Marks:
    """Which phrases of a number of words may be frequent."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.bits, self.cells = bits, cells

    def hold(self, hashes: list[np.ndarray], lang: np.uint64) -> np.ndarray:
        place = _place(hashes, lang, self.bits)
        return (self.cells[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _groups(lang: str, k: int, prefixes: pa.Array, prefix_id: np.ndarray, bucket: np.ndarray,
            words: pa.Array, word_id: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Stripes: entries ordered by prefix and bucket and cut into lists, some thousand stripes at a time.

    An entry's prefix and next word are numbers into ``prefixes`` and ``words``; texts are made once, in order.
    """
    order = np.lexsort((bucket, prefix_id))
    key = prefix_id[order] * np.int64(ROOT_BUCKETS) + bucket[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    del key
    ends = np.append(first[1:], len(order))
    for i in range(0, len(first), STRIPES_AT_A_TIME):
        start, end = first[i:i + STRIPES_AT_A_TIME], ends[i:i + STRIPES_AT_A_TIME]
        own, heads = order[start[0]:end[-1]], order[start]
        offsets = pa.array(np.append(start, end[-1]) - start[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(heads), pa.string()), pa.array(np.full(len(heads), k, np.int32)),
             prefixes.take(pa.array(prefix_id[heads])), pa.array(bucket[heads].astype(np.int32)),
             pa.ListArray.from_arrays(offsets, words.take(pa.array(word_id[own]))),
             pa.ListArray.from_arrays(offsets, pa.array(n[own].astype(np.int64)))],
            names=["lang", "k", "prefix", "bucket", "next", "n"])


def block_stripes(lang: str, text: bytes, marks: dict[int, Marks] | None, sizes: range) -> Iterator[pa.RecordBatch]:
    """The stripes of one block for phrases of ``sizes`` words."""
    data = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    starts, ends, hashes, joined = words_of(data)
    if not len(starts):
        return
    unique, where, ids = np.unique(hashes, return_index=True, return_inverse=True)
    raw, v = data.tobytes(), len(unique)
    words = pa.array([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())], pa.binary()).cast(pa.string())
    del text, data, raw, starts, ends, where
    own = _lang_hash(lang)
    if 1 in sizes:
        bucket = (unique % np.uint64(ROOT_BUCKETS)).astype(np.int64)
        none = pa.array([""])
        yield from _groups(lang, 0, none, np.zeros(v, np.int64), bucket, words, np.arange(v), np.bincount(ids, minlength=v))
        zero = np.zeros(1, np.int64)
        yield from _groups(lang, -1, none, zero, zero, none, zero, np.array([len(ids)]))
    place = np.arange(len(ids))  # where phrases of the present size begin
    number, texts = ids.astype(np.int64), words  # their number in the block, and the text of each number
    for size in range(2, sizes.stop):
        # the phrase goes on with its next word, and its last size - 1 words may be frequent too
        goes_on = place + size - 1 < len(ids)
        place, number = place[goes_on], number[goes_on]
        keep = joined[place + size - 2]
        place, number = place[keep], number[keep]
        if marks and size - 1 in marks:
            known = marks[size - 1]
            first = known.hold([hashes[place + i] for i in range(size - 1)], own)
            place, number = place[first], number[first]
            second = known.hold([hashes[place + 1 + i] for i in range(size - 1)], own)
            place, number = place[second], number[second]
        code = number * v + ids[place + size - 1]
        if size + 1 < sizes.stop:
            code, number, n = np.unique(code, return_inverse=True, return_counts=True)
        else:  # the last size: nothing is read from here on but the phrases
            del place, number, ids, hashes, joined
            code.sort()
            first = run_starts(code)
            n = np.diff(first, append=len(code))
            code = code[first]
        head, tail = code // v, code % v
        del code
        if size in sizes and len(head):
            bucket = (unique % np.uint64(BUCKETS)).astype(np.int64)[tail]
            yield from _groups(lang, size - 1, texts, head, bucket, words, tail, n)
        if size + 1 < sizes.stop:
            texts = pc.binary_join_element_wise(texts.take(pa.array(head)), words.take(pa.array(tail)), " ")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in blocks that end between pieces (a piece longer than a block stays whole)."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        end = _BREAK.search(text, start + BLOCK_BYTES)
        if end is None:
            break
        yield text[start:end.start()]
        start = end.start()
    yield text[start:] if start else text


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes | None]]:
    """(lang, text) of all rows; a batch holds up to 10,000 texts, of which some at a time become Python's."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
            part = batch.slice(at, ROWS_AT_A_TIME)
            yield from zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist())


def _stripes(marks: dict[int, Marks] | None, sizes: range):
    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        total = 0
        for lang, text in _rows(batches):
            if not text:
                continue
            for part in _pieces(text):
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part)
                total += len(part)
                if size[lang] >= BLOCK_BYTES:
                    total -= size.pop(lang)
                    yield from block_stripes(lang, b"\n".join(held.pop(lang)), marks, sizes)
                while total >= 4 * BLOCK_BYTES:  # many small languages
                    most = max(size, key=size.get)
                    total -= size.pop(most)
                    yield from block_stripes(most, b"\n".join(held.pop(most)), marks, sizes)
        while held:
            lang, parts = held.popitem()
            text = b"\n".join(parts)
            del parts
            yield from block_stripes(lang, text, marks, sizes)
            del text
        give_back()
    return run


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, k, prefix, next, f): stripes added element by element, entries below ``least`` left out.

    The exchange ships whole stripes; the sums follow within the same partitions.
    """
    together = stripes.repartition("lang", "k", "prefix", "bucket")
    entries = together.select("lang", "k", "prefix", "bucket", F.explode(F.arrays_zip("next", "n")).alias("e"))
    sums = entries.groupBy("lang", "k", "prefix", "bucket", F.col("e.next").alias("next")).agg(F.sum("e.n").alias("f"))
    return sums.where((F.col("f") >= least) | (F.col("k") < 0)).select("lang", "k", "prefix", "next", "f")


def mark(phrases: DataFrame, size: int) -> Marks:
    """Marks for (lang, phrase) rows; only the bitmap, of bounded size, reaches the driver."""
    bits = int(np.clip(np.ceil(np.log2(32 * max(phrases.count(), 1))), LEAST_BITS, MOST_BITS))

    def places(batches):
        for batch in batches:
            out = []
            by_lang: dict[str, list[str]] = {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                by_lang.setdefault(lang, []).append(phrase)
            for lang, own in by_lang.items():
                data = np.frombuffer(" ".join(own).encode(), dtype=np.uint8)
                hashes = words_of(data)[2].reshape(-1, size)
                out.append(_place([hashes[:, i] for i in range(size)], _lang_hash(lang), bits))
            at = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> _SEGMENT), pa.array(at & ((1 << _SEGMENT) - 1))], names=["segment", "bit"])

    def cells(key, rows):
        flags = np.zeros(1 << _SEGMENT, dtype=bool)
        flags[rows.column("bit").to_numpy()] = True
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()),
                         "cells": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    rows = phrases.select("lang", "phrase").mapInArrow(places, "segment long, bit long").distinct()
    rows = rows.groupBy("segment").applyInArrow(cells, "segment long, cells binary")
    out = np.zeros(max(1 << (bits - 3), 1), dtype=np.uint8)
    for row in rows.toLocalIterator():
        part = np.frombuffer(row["cells"], dtype=np.uint8)
        at = row["segment"] << (_SEGMENT - 3)
        out[at:at + len(part)] = part
    return Marks(bits, out)


def _phrase():
    return F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))


def phrase_counts(docs: DataFrame, least: int = 30, most_words: int = 4, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """(lang, k, prefix, next, phrase, f): phrases found ``least`` times or more; k = -1: all words of a language."""
    ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    out, marks = None, {}
    # words and pairs in one reading, then every further word where the marks of shorter phrases allow it
    for size in range(2, most_words + 1):
        sizes = range(1 if size == 2 else size, size + 1)
        stripes = texts.mapInArrow(_stripes(dict(marks), sizes), STRIPES)
        level = durable(merged(stripes, least).withColumn("phrase", _phrase()))
        out = level if out is None else out.unionByName(level)
        if size < most_words:
            marks[size] = mark(level.where(F.col("k") == size - 1), size)
    return out


def collocations(docs: DataFrame, least: int = 30, most_words: int = 4, top: int = 2000, covered: int = 80,
                 scale: int = 2_000_000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best collocations of every language.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest-scoring cut, ``n`` all words
    of the language. A phrase is left out if ``100 * f(longer) >= covered * a`` for a longer candidate
    around it.
    """
    counts = phrase_counts(docs, least, most_words, text_col, lang_col)
    total = counts.where(F.col("k") < 0).select("lang", F.col("f").alias("n"))
    known = counts.where(F.col("k") >= 0)
    longer = known.where(F.col("k") > 0)
    candidates = longer.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    # extensions to the right are the stripe of the phrase, those to the left share all but the first word
    longest = longer.where(F.col("k") > 1)
    sides = longest.select("lang", F.col("prefix").alias("phrase"), "f").unionByName(
        longest.select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "f"))
    around = sides.groupBy("lang", "phrase").agg(F.max("f").alias("around"))

    exact = "decimal(38,0)"
    kept = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around").cast("decimal(25,0)") * 100 < F.col("a").cast("decimal(25,0)") * covered))
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("cut"))).alias("first"),
                       F.concat_ws(" ", F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut"))).alias("rest"))
    parts = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    cuts = salted_join(cuts, parts, ["lang", "first"], salts=8)
    cuts = salted_join(cuts, parts.toDF("lang", "rest", "r"), ["lang", "rest"], salts=8)
    score = F.expr(f"cast(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0)) as {exact})"
                   " div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn(
        "rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13(spark, sf_dir: str) -> DataFrame:
    from lakeaudit.llm.common import table

    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT lang, doc, piece, string_split_regex(p, '[ \\t]+') AS w FROM (
    SELECT lang, doc, unnest(ps) AS p, unnest(range(len(ps))) AS piece FROM (
      SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
             string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[.,;:!?\\n\\x0B\\f\\r]') AS ps
      FROM documents))
), trimmed AS (
  SELECT lang, list_filter(w, lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM trimmed, range(1, 5) s(k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING k = 1 OR count(*) >= 30
), c AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a FROM f WHERE k > 1
), inner_phrases AS (
  SELECT lang, f, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM (SELECT lang, a AS f, k, string_split(phrase, ' ') AS w FROM c), range(2, 4) s(m) WHERE m < k
), covered AS (
  SELECT c.lang, c.phrase FROM c JOIN (SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY ALL) o USING (lang, phrase)
  WHERE 100 * CAST(o.f AS HUGEINT) >= 80 * CAST(c.a AS HUGEINT)
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM c), range(1, 4) r(cut) WHERE cut < k
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r,
         CAST((2000000 * CAST(a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
), best AS (
  SELECT * FROM scored WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = scored.lang AND v.phrase = scored.phrase)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""
