"""Near-duplicate documents by MinHash, with odd sketches and a confirmation on full sets.

1. A document's set is its distinct shingles. Documents with one set are one node, so exact copies
   cost nothing from here on. Of every node: MinHash samples, their bands, and an odd sketch: the
   samples folded into a parity bitmap. The XOR of two sketches holds, in its number of ones, the
   size of the samples' symmetric difference, which is precise where sets are alike.
2. Nodes that share a band form a bucket. A bucket ties its members to its hub, the member with most
   company over all bands (in a group of edited copies: what they were made from), so its pairs grow
   with its size and not with its square.
3. Sketches drop pairs that cannot reach the similarity (five standard errors below it). Full sets
   confirm each node's best hub; these links are trees.
4. What is left: buckets whose members are still in several parts. There, every member outside the
   bucket's largest part is compared with all of that part, and with the other such members, in
   blocks of bounded size; sketches first, then full sets. So every pair that shares a band ends in
   one component or is checked, whatever the size of a bucket.
5. Links become components; each is named by its least key.

With 24 bands of 3 samples a pair of similarity 0.8 shares no band with a chance of 3e-8.

Defined results
  * Words are lower-cased (A to Z) and split at white space. A text with fewer words than a shingle
    is one shingle; a text without words, or null, has an empty set and is linked with nothing.
  * Rows with a null key are linked with nothing: ``component_id`` is null and they are kept.
  * Rows that repeat a key with the same text are kept together or dropped together; a key with several
    texts is judged text by text.
  * Shingles and sets are compared by 64-bit hashes. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import (
    durable, give_back, mix, ready, salted_join, table, text_slices, window_hashes, word_hashes)
from lakeaudit.llm.components import components

BANDS, ROWS = 24, 3
SAMPLES = 128
SKETCH_BITS = 512
#: Nodes of a block when parts of a bucket are compared with each other.
BLOCK_NODES = 512
#: Tasks over which the pairs of one hub are dealt.
HUB_BLOCKS = 32
#: Up to so many rows of two numbers (some 40 MB when hashed) a table is sent to every executor.
BROADCAST_ROWS = 1_000_000

_SEEDS = np.random.default_rng(23).integers(0, 2**32, (2, SAMPLES), dtype=np.uint64).astype(np.uint32)
_SEEDS[0] |= 1


# ---------------------------------------------------------------- sets, samples and sketches

def _shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """(sorted distinct shingle hashes of all texts in a row, offsets of each text's)."""
    words, at = word_hashes(data, offsets, lower=True)
    counts = np.diff(at)
    hashes = window_hashes(words, size)
    sets = []
    for a, b, n in zip(at[:-1].tolist(), at[1:].tolist(), counts.tolist()):
        if n >= size:
            sets.append(np.unique(hashes[a:b - size + 1]))
        elif n:
            sets.append(window_hashes(words[a:b], n) ^ np.uint64(n))
        else:
            sets.append(hashes[:0])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _nodes(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number per set; meaningless for empty sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ np.uint64(0x5851F42D4C957F2D)))])
    sums = total[at[1:]] - total[at[:-1]]
    return mix(sums + np.diff(at).astype(np.uint64)).view(np.int64)


def samples(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash samples of the non-empty sets."""
    x = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), SAMPLES), dtype=np.uint32)
    for i in range(SAMPLES if len(starts) else 0):
        out[:, i] = np.minimum.reduceat(x * _SEEDS[0, i] + _SEEDS[1, i], starts)
    return out


def bands(sample: np.ndarray) -> np.ndarray:
    wide = sample[:, :BANDS * ROWS].astype(np.uint64).reshape(len(sample), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sample), BANDS))
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r])
    return key.view(np.int64)


def odd_sketches(sample: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, packed into bytes."""
    number = np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(32)
    place = (mix(sample.astype(np.uint64) + number) % np.uint64(SKETCH_BITS)).astype(np.int64)
    place += np.arange(len(sample))[:, None] * SKETCH_BITS
    ones = np.bincount(place.ravel(), minlength=len(sample) * SKETCH_BITS) & 1
    return np.packbits(ones.astype(np.uint8).reshape(len(sample), SKETCH_BITS), axis=1)


def most_ones(similarity: float) -> int:
    """Ones in the XOR of two sketches up to which ``similarity`` is within five standard errors.

    d differing samples of 2k set, on average, n/2 (1 - exp(-2d/n)) bits; d is 2k(1 - J).
    """
    k, n = SAMPLES, SKETCH_BITS
    error = np.sqrt(similarity * (1 - similarity) / k + 0.25 / n)
    apart = 2 * k * (1 - max(similarity - 5 * error, 0.0))
    return int(np.ceil(n / 2 * (1 - np.exp(-2 * apart / n))))


def estimate(ones: np.ndarray) -> np.ndarray:
    """The similarity that so many ones stand for."""
    k, n = SAMPLES, SKETCH_BITS
    return 1 + n / 2 * np.log(np.maximum(1 - 2 * ones / n, 1e-9)) / (2 * k)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signatures(key: str, size: int):
    def sign(batches):
        for batch in batches:
            for start, stop, data, offsets in text_slices(batch.column(1)):
                flat, at = _shingles(data, offsets, size)
                full = np.diff(at) > 0
                sample = samples(flat, at)
                rows = np.full(stop - start, -1)
                rows[full] = np.arange(full.sum())
                picked = pa.array(np.where(full, rows, 0), pa.int64(), mask=~full)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(bands(sample).ravel()), BANDS).cast(pa.list_(pa.int64()))
                sketch = pa.array([s.tobytes() for s in odd_sketches(sample)], pa.binary())
                yield pa.record_batch({
                    key: batch.column(0).slice(start, stop - start), "n_shingles": pa.array(np.diff(at)),
                    "node": pa.array(_nodes(flat, at), mask=~full), "bands": keys.take(picked), "sketch": sketch.take(picked)})
        give_back()
    return sign


def _full_sets(size: int):
    """(node, sketch, full set) of texts that are the wanted node."""
    def build(batches):
        for batch in batches:
            wanted = batch.column(1).to_numpy()
            for start, stop, data, offsets in text_slices(batch.column(0)):
                flat, at = _shingles(data, offsets, size)
                nodes = _nodes(flat, at)
                rows = np.flatnonzero(nodes == wanted[start:stop])
                held = [flat[at[i]:at[i + 1]] for i in rows]
                sizes = np.array([len(h) for h in held], dtype=np.int64)
                own = np.concatenate(held) if held else flat[:0]
                sketch = odd_sketches(samples(own, np.concatenate([[0], np.cumsum(sizes)])))
                yield pa.record_batch({
                    "node": pa.array(nodes[rows]), "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()), "full": pa.array([flat[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())})
        give_back()
    return build


# ---------------------------------------------------------------- pairs

def _bits(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), SKETCH_BITS // 8).view(np.uint64)


def _ones(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the full sets of both nodes of pairs (node, hub); a hub is sent once per block of its pairs."""
    placed = pairs.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(HUB_BLOCKS)))
    hubs = placed.select("hub", "block").distinct().join(
        sets.select(F.col("node").alias("hub"), F.col("full").alias("theirs")), "hub")
    return placed.join(hubs, ["hub", "block"]).join(sets.select("node", F.col("full").alias("own")), "node")


def _sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches allow the similarity, with the ones in their XOR."""
    most = most_ones(percent / 100)

    @F.arrow_udf("long")
    def ones(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(_ones(_bits(a), _bits(b)) if len(a) else np.zeros(0, np.int64))

    theirs = sketches.select(F.col("node").alias("hub"), F.col("sketch").alias("theirs"))
    both = salted_join(pairs, theirs, ["hub"], salts=8).join(sketches.select("node", F.col("sketch").alias("own")), "node")
    # else the filter would count the ones a second time
    counted = ones.asNondeterministic()("own", "theirs").alias("ones")
    return both.select("node", "hub", counted).where(F.col("ones") <= most)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity, as edges (a, b)."""
    def check(batches):
        for batch in batches:
            # the sets of one pair at a time leave Arrow's memory
            good = [alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                    for x, y in zip(batch.column("own"), batch.column("theirs"))]
            yield pa.record_batch({"a": batch.column("node"), "b": batch.column("hub")}).filter(pa.array(good, pa.bool_()))
        give_back()

    both = _with_sets(pairs, sets)
    return both.select("node", "hub", "own", "theirs").mapInArrow(check, "a long, b long")


_CELL = ("same", "place", "left_block", "right_block")


def _likely(percent: int):
    """Rows of a cell whose sketch allows the similarity to a row of the other side and another part."""
    most = most_ones(percent / 100)

    def flag(key, left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        if left.num_rows and right.num_rows:
            a, b = _bits(left.column("sketch")), _bits(right.column("sketch"))
            a_part, b_part = left.column("part").to_numpy(), right.column("part").to_numpy()
            seen, kept = np.zeros(len(a), bool), np.zeros(len(b), bool)
            for i in range(len(b)):
                near = (_ones(a, b[i][None]) <= most) & (a_part != b_part[i])
                seen |= near
                kept[i] = near.any()
            for side, rows, mask in ((0, left, seen), (1, right, kept)):
                picked = rows.filter(pa.array(mask)).select([*_CELL, "node", "part"])
                tables.append(picked.append_column("side", pa.array(np.full(picked.num_rows, side, np.int32))))
        if not tables:
            tables = [left.slice(0, 0).select([*_CELL, "node", "part"]).append_column("side", pa.array([], pa.int32()))]
        return pa.concat_tables(tables)
    return flag


def _across(percent: int):
    """Links between rows of the two sides of a cell, one per row of the right side and part of the left."""
    most = most_ones(percent / 100)

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            nodes, parts = left.column("node").to_numpy(), left.column("part").to_numpy()
            bits, full = _bits(left.column("sketch")), left.column("full").to_pylist()
            for node, part, sketch, blob in zip(
                    right.column("node").to_pylist(), right.column("part").to_pylist(),
                    _bits(right.column("sketch")), right.column("full").to_pylist()):
                ones = _ones(bits, sketch[None])
                usable = np.flatnonzero((ones <= most) & (parts != part))
                mine, joined = np.frombuffer(blob, np.uint64), set()
                for i in usable[np.argsort(ones[usable], kind="stable")]:
                    if parts[i] not in joined and alike(mine, np.frombuffer(full[i], np.uint64), percent):
                        joined.add(parts[i])
                        a.append(node)
                        b.append(int(nodes[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return compare


def _own_columns(df: DataFrame) -> DataFrame:
    """The same columns as new ones, so that both sides of a cogroup can come from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _blocks_to_compare(members: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(left, right): rows (cell, node, part, sketch) of the blocks that cover all pairs of bucket members in
    different parts; None if every bucket is in one part."""
    placed = members.join(parts, "node").select("key", "node", F.col("label").alias("part"), "sketch")
    sizes = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count(F.lit(1)).alias("parts"))
    split = durable(largest.where("parts > 1").select("key", "main"))
    if split.isEmpty():
        return None
    outside = durable(salted_join(placed, split, ["key"], salts=8).where("part <> main").select("key", "node", "part", "main", "sketch"))
    # members outside a bucket's largest part against all of that part
    mains = outside.select("main").distinct()
    inside = placed.select("node", F.col("part").alias("main"), "sketch").distinct()
    inside = durable(salted_join(inside, mains, ["main"], salts=8))
    blocks = inside.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).alias("blocks"))
    first, every = F.lit(0).cast("long"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    left = salted_join(inside, blocks, ["main"], salts=8).select(
        F.lit(False).alias("same"), F.col("main").alias("place"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("left_block"),
        first.alias("right_block"), "node", F.col("main").alias("part"), "sketch")
    right = outside.select("main", "node", "part", "sketch").distinct().join(blocks, "main").select(
        F.lit(False).alias("same"), F.col("main").alias("place"), F.explode(every).alias("left_block"),
        first.alias("right_block"), "node", "part", "sketch")
    # and against each other: blocks of a bucket's outside members against blocks
    counts = outside.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES).alias("blocks"), F.min("part").alias("low"), F.max("part").alias("high"))
    dealt = outside.join(counts.where("low <> high"), "key").select(
        F.lit(True).alias("same"), F.col("key").alias("place"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own"),
        "node", "part", "sketch")
    more_left = dealt.select("same", "place", F.col("own").alias("left_block"), F.explode(every).alias("right_block"), "node", "part", "sketch")
    more_right = dealt.select("same", "place", F.explode(every).alias("left_block"), F.col("own").alias("right_block"), "node", "part", "sketch")
    return left.union(more_left), right.union(more_right)


def _still_apart(members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between bucket members in different parts; None if there is nothing to compare."""
    blocks = _blocks_to_compare(members, parts)
    if blocks is None:
        return None
    left, right = (_own_columns(side).groupBy(*_CELL) for side in blocks)
    likely = durable(left.cogroup(right).applyInArrow(
        _likely(percent), "same boolean, place long, left_block long, right_block long, node long, part long, side int"))
    if likely.isEmpty():
        return None
    whole = likely.join(sets, "node")
    sides = (_own_columns(whole.where(F.col("side") == side).drop("side")).groupBy(*_CELL) for side in (0, 1))
    left, right = sides
    return left.cogroup(right).applyInArrow(_across(percent), "a long, b long")


# ---------------------------------------------------------------- parts

def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) from links (a, b) of at most one hub b per node a.

    A hub has more company than what it is hub of (or as much and a larger number), so the links form
    trees; every round halves the way to a tree's root.
    """
    way = durable(nodes.join(links.select(F.col("a").alias("node"), F.col("b").alias("up")), "node", "left").select(
        "node", F.coalesce("up", "node").alias("up")))
    while True:
        above = way.select(F.col("node").alias("up"), F.col("up").alias("top"))
        longer = durable(salted_join(way, above, ["up"], salts=8))
        if longer.where("up <> top").isEmpty():
            return way.withColumnRenamed("up", "label")
        way = longer.select("node", F.col("top").alias("up"))


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The parts (node, label) after joining those that ``links`` (a, b) connect."""
    ends = links.join(parts.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(
        parts.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
    edges = durable(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b").distinct())
    if edges.isEmpty():
        return parts
    joined = components(edges).select(F.col("node").alias("label"), F.col("label").alias("whole"))
    return durable(salted_join(parts, joined, ["label"], "left", salts=8).select(
        "node", F.coalesce("whole", "label").alias("label")))


# ---------------------------------------------------------------- the operator

def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``."""
    ready(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("_key"), F.col(text_col).cast("string").alias("_text"))
    signed = durable(slim.mapInArrow(
        _signatures("_key", shingle), "_key long, n_shingles long, node long, bands array<long>, sketch binary"))
    linkable = signed.where(F.col("node").isNotNull() & F.col("_key").isNotNull())
    banded = linkable.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    members = durable(salted_join(banded, shared, ["key"], salts=8).distinct())
    company = members.groupBy("node").agg(F.count(F.lit(1)).alias("company"))
    hubs = members.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("hub"))
    pairs = salted_join(members, hubs, ["key"], salts=8).where("node <> hub").select("node", "hub").distinct()

    of_rows = linkable.groupBy("node").agg(F.min("_key").alias("first_key"), F.first("sketch").alias("sketch"))
    involved = durable(of_rows.join(company.select("node"), "node"))
    wanted = involved.select(F.col("first_key").alias("_key"), "node")
    if involved.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # then the texts of all other documents stay where they are
    texts = slim.join(wanted, "_key").select("_text", "node")
    sets = durable(texts.mapInArrow(_full_sets(shingle), "node long, sketch binary, full binary").groupBy("node").agg(
        F.first("sketch").alias("sketch"), F.first("full").alias("full")))

    likely = _sketched(pairs, involved, percent)
    best = likely.groupBy("node").agg(F.min(F.struct("ones", "hub")).alias("best"))
    parts = _roots(involved.select("node"), _confirmed(best.select("node", "best.hub"), sets, percent))
    rest = _still_apart(members, parts.join(involved.select("node", "sketch"), "node"), sets, percent)
    if rest is not None:
        parts = _merged(parts, rest)

    nodes = linkable.groupBy("node").agg(F.min("_key").alias("first_key"))
    named = parts.join(involved.select("node", "first_key"), "node")
    least = named.groupBy("label").agg(F.min("first_key").alias("component_id"))
    joined = salted_join(named.select("node", "label"), least, ["label"], salts=16).select("node", "component_id")
    of_node = nodes.join(joined, "node", "left").select(
        "node", F.coalesce("component_id", "first_key").alias("component_id"))
    out = salted_join(signed.select("_key", "n_shingles", "node"), of_node, ["node"], "left", salts=16)
    component = F.when(F.col("_key").isNotNull(), F.coalesce("component_id", "_key"))
    return out.select(
        F.col("_key").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept"))


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
