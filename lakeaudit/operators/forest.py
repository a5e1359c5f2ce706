"""A random forest of two classes whose nodes stay in Spark.

The trees are those of ``RandomForestClassifier``: Poisson bootstrap, a square root of the features at every node,
Gini gain over at most 32 bins, leaves that agree are merged. They differ in where they grow. A node of more than
``node_rows`` rows is split from histograms that all tasks add up, one pass a level; a smaller one is sent with its
rows to one task, which grows all below it. The driver knows only the large nodes, about trees * rows / ``node_rows``
of them; the subtrees are a stored table. To score, every group of rows is held by one task as bytes, which the
subtrees pass one tree after the other.

Bootstrap weights and features come from hashes of row number, tree and node, not from Spark's generators, so single
trees differ from Spark's. Weights are multiples of 2^-22, so that sums are exact: with the same row numbers the trees
are the same whatever the order of rows and ``node_rows``. Row numbers follow the partitions, as Spark's draws do.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, groupby
from math import ceil, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.durable import durable, workers_ready

BINS = 32
#: Less than this is rounding, not gain.
MIN_GAIN = 1e-12
#: A vote is a probability in units of this, so that votes add up exactly.
VOTE = 2.0 ** -40
WEIGHT_UNIT = 2.0 ** -22
#: Rows of a piece that is sent to a task, rows that a task works on at once.
PIECE_ROWS, BATCH_ROWS = 4096, 65_536
TASK_ROWS = 50_000
#: Share of the rows that a tree draws.
DRAWN = 0.64
#: Histograms that a task holds in one pass, rows to score that it holds.
HISTOGRAM_BYTES, GROUP_BYTES = 64 << 20, 128 << 20
#: Nodes that are walked at once.
TREE_NODES = 4_000_000
#: Nodes of fewer rows are split from their sorted rows; rows that are counted or sorted at once.
SMALL_NODE, COUNTED_ROWS, SORTED_ROWS = 32, 16_384, 4096
#: Nodes of more rows are counted one by one.
LARGE_NODE = 2048
_POISSON = np.ceil(np.cumsum([np.exp(-1.0) / factorial(i) for i in range(12)]) * 2.0 ** 53).astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def copies(rows: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often each row is drawn by each tree: Poisson(1)."""
    stream = _mixed(_mixed(np.uint64([seed])) + trees.astype(np.uint64))
    h = _mixed(_mixed(rows.astype(np.uint64))[:, None] ^ stream)
    h >>= np.uint64(11)
    times = np.zeros(h.shape, np.uint8)
    for limit in _POISSON:
        times += h >= limit
    return times


def chosen(trees: np.ndarray, paths: np.ndarray, width: int, k: int, seed: int) -> np.ndarray:
    """The k features that each node looks at, ascending. A path is 1 at the root, 2i and 2i + 1 below."""
    stream = _mixed(_mixed(np.uint64([~seed & 0xFFFFFFFF])) + trees.astype(np.uint64))
    h = _mixed(_mixed(stream ^ _mixed(paths.astype(np.uint64)))[:, None] + np.arange(width, dtype=np.uint64))
    return np.sort(np.argpartition(h, k - 1, axis=1)[:, :k], axis=1)


def _gains(l0, l1, t0, t1) -> np.ndarray:
    """Gini gain (times the node's weight) of splits, from the weights of both classes on the left and in the node."""
    r0, r1 = t0 - l0, t1 - l1
    n_left, n_right, n = l0 + l1, r0 + r1, t0 + t1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (l0 ** 2 + l1 ** 2) / n_left + (r0 ** 2 + r1 ** 2) / n_right - (t0 ** 2 + t1 ** 2) / n
        gain[~((n_left > 0) & (n_right > 0) & (gain > MIN_GAIN * n))] = 0.0
    return gain


def best_split(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, last bin of the left side and gain (times the node's weight) per node of (nodes, slots, classes, bins)."""
    left = np.cumsum(hist, axis=3)
    total = left[:, :1, :, -1:]
    left = left[..., :-1]
    flat = _gains(left[:, :, 0], left[:, :, 1], total[:, :, 0], total[:, :, 1]).reshape(len(hist), -1)
    place = flat.argmax(1)
    return place // (BINS - 1), place % (BINS - 1), flat[np.arange(len(flat)), place]


def _cells(bins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bin and class in one byte."""
    return bins + np.where(y, np.uint8(BINS), np.uint8(0))[:, None]


def _histogram(cells: np.ndarray, at: np.ndarray, w: np.ndarray, slots: np.ndarray, counted: bool = False) -> np.ndarray:
    """Weights of (node, slot, class, bin); as a third class the number of rows, if asked for."""
    m, k = slots.shape
    hist = np.zeros((m, k, 2 + counted, BINS))
    for lo in range(0, len(at), COUNTED_ROWS):
        a, flat = at[lo:lo + COUNTED_ROWS], cells[lo:lo + COUNTED_ROWS].ravel()
        first, base = np.arange(len(a)) * cells.shape[1], a * (2 * BINS)
        for s in range(k):
            place = base + flat.take(first + slots[:, s].take(a))
            hist[:, s, :2] += np.bincount(place, w[lo:lo + COUNTED_ROWS], m * 2 * BINS).reshape(m, 2, BINS)
            if counted:
                hist[:, s, 2] += np.bincount(place, minlength=m * 2 * BINS).reshape(m, 2, BINS).sum(1)
    return hist


def _counted_apart(cells: np.ndarray, w: np.ndarray, slots: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``_histogram``, for few nodes of many rows each, in order of nodes."""
    hist = np.zeros((*slots.shape, 2, BINS))
    for node, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        for lo in range(lo, hi, COUNTED_ROWS):
            some = slice(lo, min(lo + COUNTED_ROWS, hi))
            for s, slot in enumerate(slots[node]):
                hist[node, s] += np.bincount(cells[some, slot], w[some], 2 * BINS).reshape(2, BINS)
    return hist


def _sorted_split(
    cells: np.ndarray, at: np.ndarray, w: np.ndarray, totals: np.ndarray, slots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``best_split``, for many nodes of few rows each, in order of nodes: looks only at bins that have rows."""
    (m, k), n = slots.shape, len(at)
    w1 = np.where(cells[:, 0] >= BINS, w, 0.0)
    bins = cells.ravel().take(np.arange(n) * cells.shape[1] + slots.T.take(at, axis=1)) & (BINS - 1)
    shift = n.bit_length()
    key = (((at * k + np.arange(k)[:, None]) * BINS + bins) << shift | np.arange(n)).ravel()
    key.sort()
    row, place = key & ((1 << shift) - 1), key >> shift
    end = np.flatnonzero(place[1:] != place[:-1])
    end = end[place[end] // BINS == place[end + 1] // BINS]
    place = place[end]
    node, slot = np.divmod(place // BINS, k)
    before, total = (np.cumsum(totals, 0) - totals)[node], totals[node]
    l0, l1 = (np.cumsum(c.take(row))[end] - (k * before[:, i] + slot * total[:, i]) for i, c in enumerate((w - w1, w1)))
    gain = _gains(l0, l1, total[:, 0], total[:, 1])
    won, best = np.zeros(m), np.zeros(m, np.int64)
    if len(end):
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        most = np.repeat(np.maximum.reduceat(gain, first), np.diff(np.r_[first, len(node)]))
        hits = np.flatnonzero(gain == most)
        hits = hits[np.r_[True, node[hits[1:]] != node[hits[:-1]]]]
        won[node[hits]], best[node[hits]] = gain[hits], place[hits]
    return best // BINS % k, best % BINS, won


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: int, depth: int, k: int, seed: int) -> dict:
    """The subtree below one node, level by level, with leaves of one prediction merged."""
    return _grown(_cells(bins, y), w, tree, path, depth, k, seed)


def _grown(cells: np.ndarray, w: np.ndarray, tree: int, path: int, depth: int, k: int, seed: int) -> dict:
    """Rows lie in the order of their nodes, large nodes before small ones."""
    order, at, y = np.arange(len(w)), np.zeros(len(w), np.int64), cells[:, 0] >= BINS
    paths, totals = np.array([path]), np.array([[w[~y].sum(), w[y].sum()]])
    levels, size = [], 0
    while True:
        m = len(paths)
        feature, cut, gain = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m)
        left = np.zeros(m, np.int32)
        mixed = totals.min(1) > 0 if depth > 0 else np.zeros(m, bool)
        sizes = np.bincount(at, minlength=m)
        kinds = np.searchsorted([-LARGE_NODE, -SMALL_NODE], -sizes, side="right")
        each = [np.flatnonzero(mixed & (kinds == i)) for i in range(3)]
        nodes, last_of = np.concatenate(each), np.cumsum([len(x) for x in each])
        sizes = sizes[nodes]
        number = np.full(m, len(nodes))
        number[nodes] = np.arange(len(nodes))
        at = number.take(at)
        order = order.take(np.argsort(at.astype(np.uint16) if len(nodes) < 1 << 16 else at, kind="stable")[:sizes.sum()])
        cells, w, at = cells.take(order, axis=0), w.take(order), np.repeat(np.arange(len(nodes)), sizes)
        ends, lo = np.cumsum(sizes), 0
        while lo < len(nodes):
            kind, start = np.searchsorted(last_of, lo, side="right"), ends[lo - 1] if lo else 0
            most = (16 * COUNTED_ROWS, COUNTED_ROWS, SORTED_ROWS)[kind]
            hi = min(max(lo + 1, int(np.searchsorted(ends, start + most, side="right"))), last_of[kind])
            some, here = nodes[lo:hi], slice(start, ends[hi - 1])
            slots = chosen(np.full(len(some), tree), paths[some], cells.shape[1], k, seed)
            if kind == 2:
                slot, last, won = _sorted_split(cells[here], at[here] - lo, w[here], totals[some], slots)
            else:
                slot, last, won = best_split(
                    _histogram(cells[here], at[here] - lo, w[here], slots) if kind else
                    _counted_apart(cells[here], w[here], slots, ends[lo:hi] - start))
            split = won > 0
            feature[some[split]] = slots[np.arange(len(some)), slot][split]
            cut[some[split]], gain[some[split]] = last[split], won[split]
            lo = hi
        split = feature >= 0
        number = np.cumsum(split) - 1
        left[split] = size + m + 2 * number[split]
        levels.append((feature, cut, left, gain, totals))
        if not split.any():
            break
        order = np.flatnonzero(np.repeat(split[nodes], sizes))
        nodes, sizes = nodes[split[nodes]], sizes[split[nodes]]
        cell = cells.ravel().take(order * cells.shape[1] + np.repeat(feature[nodes], sizes))
        at = np.repeat(2 * number[nodes], sizes) + ((cell & (BINS - 1)) > np.repeat(cut[nodes], sizes))
        paths = np.stack([2 * paths[split], 2 * paths[split] + 1], 1).ravel()
        totals = np.bincount(2 * at + (cell >= BINS), w[order], 2 * len(paths)).reshape(-1, 2)
        size, depth = size + m, depth - 1
    return _merged(levels)


def _merged(levels: list[tuple]) -> dict:
    starts = np.cumsum([0, *(len(level[0]) for level in levels)])
    feature, cut, left, gain, totals = (np.concatenate(part) for part in zip(*levels, strict=True))
    says = totals[:, 1] > totals[:, 0]
    for lo, hi in zip(starts[-2::-1], starts[:0:-1], strict=True):
        inner = lo + np.flatnonzero(feature[lo:hi] >= 0)
        a, b = left[inner], left[inner] + 1
        feature[inner[(feature[a] < 0) & (feature[b] < 0) & (says[a] == says[b])]] = -1
    keep = np.zeros(len(feature), bool)
    keep[0] = True
    for lo, hi in zip(starts, starts[1:], strict=False):
        inner = lo + np.flatnonzero(keep[lo:hi] & (feature[lo:hi] >= 0))
        keep[left[inner]] = keep[left[inner] + 1] = True
    left = np.where(feature >= 0, (np.cumsum(keep) - 1)[left], 0).astype(np.int32)
    return {"feature": feature[keep], "cut": cut[keep], "left": left[keep], "gain": gain[keep], "totals": totals[keep]}


def _votes(totals: np.ndarray) -> np.ndarray:
    """Share of class 1; a tree that drew no row has no vote."""
    n = totals.sum(1)
    return np.rint(np.divide(totals[:, 1], n, out=np.zeros(len(n)), where=n > 0) / VOTE).astype(np.int64)


@dataclass
class Top:
    """The nodes that the driver knows: split ones, and the roots of what tasks grow (``sent``) or leaves."""

    tree: np.ndarray
    path: np.ndarray
    left: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    totals: np.ndarray
    gain: np.ndarray
    sent: np.ndarray

    @staticmethod
    def of(tree, path, totals, sent) -> Top:
        n = len(tree)
        return Top(np.asarray(tree), np.asarray(path), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64),
                   np.asarray(totals, float).reshape(n, 2), np.zeros(n), np.asarray(sent, bool))

    def with_nodes(self, more: Top) -> Top:
        return Top(*(np.concatenate([getattr(self, c), getattr(more, c)]) for c in Top.__dataclass_fields__))

    def of_trees(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The nodes of each tree, its root first, and the tree for ``walk``, with places among those nodes."""
        order, found = np.argsort(self.tree, kind="stable"), []
        for nodes in np.split(order, np.cumsum(np.bincount(self.tree))[:-1]):
            place = np.searchsorted(nodes, self.left[nodes])
            found.append((nodes, packed(self.feature[nodes], self.cut[nodes], place)))
        return found


def packed(feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A tree with a number per node; a leaf leads to itself."""
    inner = feature >= 0
    return np.where(inner, left.astype(np.int64) << 24 | cut.astype(np.int64) << 16 | feature, np.arange(len(left)) << 24 | 255 << 16)


def walk(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of each row below its place ``at``."""
    return _leaves(bins, at, packed(feature, cut, left))


def _leaves(bins: np.ndarray, at: np.ndarray, tree: np.ndarray) -> np.ndarray:
    ended = np.empty(len(at), np.int64)
    for lo in range(0, len(at), COUNTED_ROWS):
        place, flat = at[lo:lo + COUNTED_ROWS], bins[lo:lo + COUNTED_ROWS].ravel()
        first, live, here = np.arange(len(place)) * bins.shape[1], None, ended[lo:lo + COUNTED_ROWS]
        while len(place):
            node = tree.take(place)
            below = (node >> 24) + (flat.take(first + (node & 0xFFFF)) > (node >> 16 & 0xFF))
            moved = below != place
            place = below
            if 4 * np.count_nonzero(moved) < 3 * len(moved):  # else a step of those that have ended costs less than leaving them out
                here[slice(None) if live is None else live] = place
                inside = np.flatnonzero(moved)
                place, first, live = place[inside], first[inside], inside if live is None else live[inside]
    return ended


def _bytes_of(column: pa.Array | pa.ChunkedArray, dtype, width: int | None = None) -> np.ndarray:
    """The bytes of all records, one after the other."""
    found = []
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + len(part) + 1] if len(part) else [0, 0]
        if ends[-1] > ends[0]:
            found.append(np.frombuffer(part.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    data = (found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint8)).view(dtype)
    return data if width is None else data.reshape(-1, width)


def _records(data: np.ndarray) -> pa.Array:
    """A record of bytes per row."""
    data = np.ascontiguousarray(data)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _batches(batches, width: int, *others: str):
    """Rows as arrays, many at once: the bins and other columns."""
    waiting, size = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append([_bytes_of(batch.column("bins"), np.uint8, width), *(batch.column(c).to_numpy() for c in others)])
            size += batch.num_rows
        if size >= BATCH_ROWS:
            yield [np.concatenate(c) for c in zip(*waiting, strict=True)]
            waiting, size = [], 0
    if waiting:
        yield [np.concatenate(c) for c in zip(*waiting, strict=True)]


def thresholds(rows: DataFrame) -> list[np.ndarray]:
    """Cuts per feature: between all values where there are at most 32, else at 31 quantiles."""
    def listed(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i in range(x.shape[1]):
                if len(seen.get(i, ())) <= BINS:
                    seen[i] = np.unique(np.concatenate([seen.get(i, np.zeros(0)), np.unique(x[:, i])]))[:BINS + 1]
        yield pa.RecordBatch.from_pylist(
            [{"slot": i, "x": v} for i, some in seen.items() for v in some.tolist()],
            pa.schema([("slot", pa.int64()), ("x", pa.float64())]))

    cells = rows.select(vector_to_array("features").alias("x"))
    width = cells.select(F.size("x").alias("n")).first()["n"]
    values = cells.mapInArrow(listed, "slot long, x double").distinct().groupBy("slot").agg(
        F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_list("x")), 1, BINS).alias("x"))
    cuts: list[np.ndarray] = [np.zeros(0)] * width
    many = []
    for r in values.collect():
        x = np.array(r["x"])
        cuts[r["slot"]] = (x[1:] + x[:-1]) / 2
        if r["n"] > BINS:
            many.append(r["slot"])
    if many:
        found = cells.agg(*[f(F.get("x", F.lit(i))).alias(f"{c}{i}") for i in many for c, f in (
            ("q", lambda x: F.percentile_approx(x, [i / BINS for i in range(1, BINS)], 10_000)), ("m", F.max))]).first()
        for i in many:
            cuts[i] = np.unique([q for q in found[f"q{i}"] if q < found[f"m{i}"]])
    return cuts


def binned(df: DataFrame, cuts: list[np.ndarray], *others: str) -> DataFrame:
    """``features`` as a byte per feature: the number of cuts below the value."""
    def run(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            b = np.empty(x.shape, np.uint8)
            for i, c in enumerate(cuts):
                b[:, i] = np.searchsorted(c, x[:, i])
            yield pa.RecordBatch.from_arrays([_records(b), *batch.columns[1:]], ["bins", *others])

    rows = df.select(vector_to_array("features").alias("x"), *others)
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes[1:])
    return rows.mapInArrow(run, f"bins binary, {kinds}")


class RandomForest:
    """``RandomForestClassifier`` for labels 0 and 1, for forests too large for the driver."""

    def __init__(self, numTrees: int, maxDepth: int, seed: int, labelCol: str, featuresCol: str = "features",
                 weightCol: str | None = None, node_rows: int = 3_000_000):
        self.trees, self.depth, self.seed, self.node_rows = numTrees, maxDepth, seed, node_rows
        self.label, self.features, self.weight = labelCol, featuresCol, weightCol

    def fit(self, df: DataFrame) -> RandomForestModel:
        workers_ready(df.sparkSession)
        y = F.col(self.label).cast("double")
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = df.select(
            F.col(self.features).alias("features"), (F.rint(w / WEIGHT_UNIT) * WEIGHT_UNIT).alias("w"),
            F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(F.concat(
                F.lit("labels must be 0 or 1, found "), F.coalesce(y.cast("string"), F.lit("null"))))).alias("y"))
        rows = rows.where("w > 0").withColumn("row", F.monotonically_increasing_id())
        n = rows.count()
        if n == 0:
            raise ValueError("a forest needs rows to train on")
        cuts = thresholds(rows)
        tasks = df.sparkSession.sparkContext.defaultParallelism
        # a row is worked on once per tree; its number is stored before it is used
        stored = durable(binned(rows, cuts, "row", "y", "w").repartition(max(tasks, n // TASK_ROWS), "row"))
        k = len(cuts) if self.trees == 1 else ceil(sqrt(len(cuts)))
        top = Top.of(np.arange(self.trees), np.ones(self.trees, np.int64), np.zeros((self.trees, 2)), np.ones(self.trees))
        large = np.arange(self.trees) if n * DRAWN > self.node_rows else np.zeros(0, np.int64)
        level = 0
        while len(large):
            top, large = self._level(stored, top, large, len(cuts), k, level)
            level += 1
        parts = min(8 * tasks + n * self.trees // 1_000_000, int(top.sent.sum()) or 1)
        subtrees = durable(self._subtrees(stored, top, len(cuts), k, parts))
        return RandomForestModel(self, cuts, *_closed(top, subtrees, self.trees, len(cuts)), subtrees)

    def _level(self, rows: DataFrame, top: Top, large: np.ndarray, width: int, k: int, level: int) -> tuple[Top, np.ndarray]:
        """Splits the large nodes; the new top and its large nodes."""
        large = large[np.argsort(top.tree[large], kind="stable")]
        block = max(1, HISTOGRAM_BYTES // (k * BINS * 3 * 8))
        found = [r for lo in range(0, len(large), block) for r in self._splits(rows, top, large[lo:lo + block], width, k)]
        trees, paths, totals, sent, bigger = [], [], [], [], []
        for r in sorted(found, key=lambda r: r["node"]):
            node = r["node"]
            top.totals[node] = r["w0"], r["w1"]
            top.sent[node] = False
            if r["gain"] <= 0:
                continue
            top.feature[node], top.cut[node], top.gain[node] = r["feature"], r["cut"], r["gain"]
            top.left[node] = len(top.tree) + len(trees)
            for side in (0, 1):
                w0, w1, n = r["sides"][3 * side:3 * side + 3]
                going = min(w0, w1) > 0 and level + 1 < self.depth
                if going and n > self.node_rows:
                    bigger.append(len(top.tree) + len(trees))
                trees.append(top.tree[node])
                paths.append(2 * top.path[node] + side)
                totals.append((w0, w1))
                sent.append(going)
        if trees:
            top = top.with_nodes(Top.of(trees, paths, totals, sent))
        return top, np.array(bigger, np.int64)

    def _splits(self, rows: DataFrame, top: Top, nodes: np.ndarray, width: int, k: int) -> list:
        seed, leaf = self.seed, self.depth == 0
        trees = np.unique(top.tree[nodes])
        number = np.full(len(top.tree), -1)
        number[nodes] = np.arange(len(nodes))

        def counted(batches):
            slots = chosen(top.tree[nodes], top.path[nodes], width, k, seed)
            hist = np.zeros((len(nodes), k, 3, BINS))
            known = top.of_trees()
            for bins, row, y, w in _batches(batches, width, "row", "y", "w"):
                cells = _cells(bins, y == 1)
                for tree in trees:
                    ids, nodes_of = known[tree]
                    times = copies(row, np.array([tree]), seed)[:, 0]
                    r = np.flatnonzero(times)
                    node = number[ids[_leaves(bins[r], np.zeros(len(r), np.int64), nodes_of)]]
                    inside = np.flatnonzero(node >= 0)
                    r, node = r[inside], node[inside]
                    own = slice(*np.searchsorted(top.tree[nodes], [tree, tree + 1]))
                    hist[own] += _histogram(cells[r], node - own.start, w[r] * times[r], slots[own], counted=True)
            for lo in range(0, len(nodes), 512):
                some = hist[lo:lo + 512]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[lo:lo + 512]), _records(some.reshape(len(some), -1))], ["node", "hist"])

        def split(table):
            hist = np.zeros((1, k, 3, BINS))
            for h in table.column("hist"):
                hist += np.frombuffer(h.as_buffer()).reshape(hist.shape)
            node = table.column("node")[0].as_py()
            slot, cut, gain = (v[0] for v in best_split(hist[:, :, :2]))
            side = hist[0, slot, :, :cut + 1].sum(1)
            total = hist[0, slot].sum(1)
            feature = chosen(top.tree[[node]], top.path[[node]], width, k, seed)[0, slot]
            return pa.Table.from_pylist([{
                "node": node, "feature": int(feature), "cut": int(cut), "gain": 0.0 if leaf else float(gain),
                "w0": total[0], "w1": total[1], "sides": [*side.tolist(), *(total - side).tolist()]}])

        return rows.mapInArrow(counted, "node long, hist binary").groupBy("node").applyInArrow(
            split, "node long, feature long, cut long, gain double, w0 double, w1 double, sides array<double>").collect()

    def _subtrees(self, rows: DataFrame, top: Top, width: int, k: int, parts: int) -> DataFrame:
        seed, depth = self.seed, self.depth

        def sent(batches):
            known = top.of_trees()
            for bins, row, y, w in _batches(batches, width, "row", "y", "w"):
                cells = _cells(bins, y == 1)
                for tree, (ids, nodes_of) in enumerate(known):
                    times = copies(row, np.array([tree]), seed)[:, 0]
                    r = np.flatnonzero(times)
                    node = ids[_leaves(bins[r], np.zeros(len(r), np.int64), nodes_of)]
                    inside = np.flatnonzero(top.sent[node])
                    r = r[inside]
                    yield _pieces(node[inside], cells[r], {"w": w[r] * times[r]})

        def grown(table):
            part = table.column("part")[0].as_py()
            cells, w = _bytes_of(table.column("bins"), np.uint8, width), _bytes_of(table.column("w"), np.float64)
            levels = int(top.path[part]).bit_length() - 1
            found = _grown(cells, w, top.tree[part], top.path[part], depth - levels, k, seed)
            inner = found["feature"] >= 0
            return pa.Table.from_pylist([{
                "part": part, "tree": int(top.tree[part]), "feature": found["feature"].tobytes(), "cut": found["cut"].tobytes(),
                "left": found["left"].tobytes(), "vote": _votes(found["totals"]).tobytes(),
                "w0": found["totals"][0, 0], "w1": found["totals"][0, 1], "nodes": len(inner),
                "gains": np.bincount(found["feature"][inner], found["gain"][inner], width).astype(float).tolist()}])

        pieces = rows.mapInArrow(sent, "part long, bins binary, w binary")
        return pieces.repartition(parts, "part").groupBy("part").applyInArrow(
            grown, "part long, tree long, feature binary, cut binary, left binary, vote binary, w0 double, w1 double, nodes long, "
            "gains array<double>")


def _pieces(part: np.ndarray, bins: np.ndarray, others: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows of one part, at most 128 in a record."""
    order = np.argsort(part, kind="stable")
    part, bins, others = part[order], bins[order], {c: v[order] for c, v in others.items()}
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(part)]
    cuts = [(i, min(i + PIECE_ROWS, hi)) for lo, hi in zip(starts, ends, strict=False) for i in range(lo, hi, PIECE_ROWS)]
    return pa.RecordBatch.from_arrays(
        [pa.array([part[lo] for lo, _ in cuts], pa.int64()),
         *(pa.array([v[lo:hi].tobytes() for lo, hi in cuts], pa.binary()) for v in (bins, *others.values()))],
        ["part", "bins", *others])


def _closed(top: Top, subtrees: DataFrame, trees: int, width: int) -> tuple[Top, np.ndarray]:
    """The top with agreeing leaves merged, and the importance of each feature."""
    leaf = top.feature < 0
    for r in subtrees.select("part", "w0", "w1", "nodes").collect():
        leaf[r["part"]], top.totals[r["part"]] = r["nodes"] == 1, (r["w0"], r["w1"])
    says = top.totals[:, 1] > top.totals[:, 0]
    for i in np.flatnonzero(top.feature >= 0)[::-1]:  # children come after their parents
        a = top.left[i]
        if leaf[a] and leaf[a + 1] and says[a] == says[a + 1]:
            top.feature[i], top.gain[i], leaf[i] = -1, 0.0, True
    top.sent &= ~leaf
    gains = np.zeros((trees, width))
    inner = top.feature >= 0
    np.add.at(gains, (top.tree[inner], top.feature[inner]), top.gain[inner])
    sums = subtrees.select("tree", F.posexplode("gains").alias("slot", "gain"))
    for r in sums.where("gain > 0").groupBy("tree", "slot").agg(F.sum("gain").alias("gain")).collect():
        gains[r["tree"], r["slot"]] += r["gain"]
    totals = gains.sum(1, keepdims=True)
    shares = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).sum(0)
    return top, shares / shares.sum() if shares.sum() > 0 else shares


class RandomForestModel(Model):
    """Adds ``probability`` and ``prediction``; ``featureImportances`` as in Spark, each tree weighing the same."""

    def __init__(self, forest: RandomForest, cuts: list[np.ndarray], top: Top, importances: np.ndarray, subtrees: DataFrame):
        super().__init__()
        self.forest, self.cuts, self.top, self.subtrees = forest, cuts, top, subtrees
        self.featureImportances = DenseVector(importances)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Stores the rows with a number each; the votes are counted when the result is read."""
        rows = durable(df.withColumn("_row", F.monotonically_increasing_id()))
        top, width = self.top, len(self.cuts)
        own = _votes(top.totals)
        tasks = df.sparkSession.sparkContext.defaultParallelism
        groups = max(tasks, ceil(rows.count() * (width + 24) / GROUP_BYTES))

        def grouped(batches):
            for bins, row in _batches(batches, width, "_row"):
                yield _pieces(row % groups, bins, {"rows": row})

        def voted(batches):
            known = top.of_trees()
            bins, rows, votes, node = np.zeros((0, width), np.uint8), np.zeros(0, np.int64), None, None

            def walked(some: list[tuple]) -> None:
                """Adds the votes of subtrees of one tree."""
                parts, features, cuts, lefts, leaves = zip(*some, strict=True)
                starts = np.cumsum([0, *map(len, features)])
                start = np.full(len(top.tree), -1)
                start[list(parts)] = starts[:-1]
                below = packed(np.concatenate(features), np.concatenate(cuts),
                               np.concatenate([v + lo for v, lo in zip(lefts, starts, strict=False)]))
                vote = np.concatenate(leaves)
                for lo in range(0, len(bins), BATCH_ROWS):
                    at = start[node[lo:lo + BATCH_ROWS]]
                    r = lo + np.flatnonzero(at >= 0)
                    votes[r] += vote[_leaves(bins[r], at[r - lo], below)]

            def begun(tree: int) -> np.ndarray:
                """The node that the driver knows for each row; its votes, where no subtree follows."""
                ids, nodes_of = known[tree]
                found = ids[_leaves(bins, np.zeros(len(bins), np.int64), nodes_of)]
                votes[:] += np.where(top.sent[found], 0, own[found])
                return found.astype(np.int32)

            records = (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
            held, first = [], None
            for first in records:
                if first["tree"] is not None:
                    break
                held.append((np.frombuffer(first["bins"], np.uint8).reshape(-1, width), np.frombuffer(first["rows"], np.int64)))
            if not held:
                return
            bins, rows = (np.concatenate(c) for c in zip(*held, strict=True))
            held, votes, trees = [], np.zeros(len(bins), np.int64), set(range(len(known)))
            following = chain([first], records) if first["tree"] is not None else ()
            for tree, some in groupby(following, lambda r: r["tree"]):
                trees.remove(tree)
                node = begun(tree)
                waiting, size = [], 0
                for r in some:
                    if size >= TREE_NODES:
                        walked(waiting)
                        waiting, size = [], 0
                    waiting.append((r["part"], *(np.frombuffer(r[c], d) for c, d in (
                        ("feature", np.int16), ("cut", np.uint8), ("left", np.int32), ("vote", np.int64)))))
                    size += len(waiting[-1][1])
                walked(waiting)
            for tree in trees:
                begun(tree)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(votes)], ["_row", "vote"])

        features = rows.select(F.col(self.forest.features).alias("features"), "_row")
        pieces = binned(features, self.cuts, "_row").mapInArrow(grouped, "part long, bins binary, rows binary")
        trees = self.subtrees.where("nodes > 1").select(  # the driver knows the others as leaves
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "tree", "part", "feature", "cut", "left", "vote")
        met = trees.unionByName(pieces.withColumnRenamed("part", "group").withColumn("group", F.col("group").cast("int")),
                                allowMissingColumns=True)
        votes = met.repartitionById(groups, F.col("group")).sortWithinPartitions(F.col("tree").asc_nulls_first(), "part").mapInArrow(
            voted, "_row long, vote long")
        voting = max(1, int((top.totals[:self.forest.trees].sum(1) > 0).sum()))
        one = F.col("vote") * VOTE / voting
        return rows.join(votes, "_row").withColumns({
            "probability": array_to_vector(F.array(1 - one, one)),
            "prediction": (F.col("vote") * 2 > voting * round(1 / VOTE)).cast("double"),
        }).drop("_row", "vote")
