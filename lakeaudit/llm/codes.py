"""Product codes of vectors whose nearest entries are found with a GNAT over each codebook.

Vectors are cut into consecutive parts; every part position has a codebook. A round assigns every
part to its nearest entry and replaces the entries by the floored means of their parts. The nearest
entry is searched in a geometric near-neighbour access tree: a node holds split points and, for every
pair of split point and child, the range of distances from the point to the child's entries. A child
is passed over only if some split point's range lies strictly outside the query's reach; distances
round away from elimination. What is left is compared by exact integer squared distances, ties by the
lower index. The tree holds one codebook (``entries`` rows), is built in the driver and goes to the
tasks with the function; tasks return one sum per entry, merged by a grouped aggregate.

Defined results
  * A vector takes part if it is not null and holds only finite components; others are dropped.
    A null id takes part and sorts last, a null label is a label of its own.
  * The length of the vector with the least id is the length of all: vectors of another length keep
    their row with null code and error. Lengths that ``parts`` does not divide are cut at
    ``i * length // parts``; empty vectors have code 0 and error 0.
  * Repeated rows count each; equal ids are ordered by their vector for the first codebook. With
    fewer rows than entries the codebooks are that much smaller. An empty table gives no rows.
  * Distances that fit 53 bits run as float64, which is exact there; larger ones as whole numbers of
    any size. Errors beyond a long become the largest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import durable, ready, salted_join

#: Split points of a node, and entries up to which a node is a leaf.
SPLITS = 8
LEAF = 12
#: Values of one block of vectors: what is held at a time beside the Arrow batch.
BLOCK_VALUES = 1 << 20
#: Relative margin of a rounded distance, several times what a square root and two sums can lose.
MARGIN = 1e-12
LARGEST = 2**63 - 1


def _exact(values: np.ndarray, entries: np.ndarray) -> bool:
    if not values.size or not entries.size:
        return True
    most = max(float(np.abs(values).max()), float(np.abs(entries).max()))
    return 4.0 * most * most * values.shape[1] < 2.0**53


def _squared(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances: float64 products of small integers, or Python integers."""
    if queries.dtype == object:
        gaps = queries[:, None, :] - entries[None, :, :]
        out = (gaps * gaps).sum(axis=2)
        return out if queries.shape[1] else np.zeros(out.shape, dtype=object)
    own = np.einsum("ij,ij->i", queries, queries)
    others = np.einsum("ij,ij->i", entries, entries)
    return own[:, None] + others[None, :] - 2.0 * (queries @ entries.T)


class Node:
    """Split points (entry numbers), children, and ranges[i, j] of distances from split i to child j."""

    def __init__(self, numbers: np.ndarray, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.splits, self.children = numbers, []
        self.low = self.high = None
        if len(numbers) <= leaf:
            return
        chosen = [0]
        gaps = _squared(entries[numbers], entries[numbers[:1]])[:, 0]
        while len(chosen) < splits:  # points far from those chosen so far
            chosen.append(int(np.argmax(gaps)))
            gaps = np.minimum(gaps, _squared(entries[numbers], entries[numbers[chosen[-1:]]])[:, 0])
        chosen = sorted(set(chosen))
        rest = np.setdiff1d(np.arange(len(numbers)), chosen)
        self.splits = numbers[chosen]
        distances = _squared(entries[numbers[rest]], entries[self.splits])
        nearest = np.argmin(distances, axis=1)
        roots = np.sqrt(distances.astype(np.float64))
        low, high = [], []
        for j in range(len(chosen)):
            mine = nearest == j
            if not mine.any():
                self.children.append(None)
                low.append(np.zeros(len(chosen)))
                high.append(np.zeros(len(chosen)))
                continue
            low.append(roots[mine].min(axis=0) * (1 - MARGIN))
            high.append(roots[mine].max(axis=0) * (1 + MARGIN))
            members = numbers[rest[mine]]
            # equal entries cannot be parted: such a child is a leaf
            same = len(members) == len(numbers) - 1 and not distances.any()
            self.children.append(Node(members, entries, splits, len(members) if same else leaf))
        self.low, self.high = np.array(low).T, np.array(high).T


def nearest_entries(queries: np.ndarray, entries: np.ndarray, root: Node) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance) of each query, and how many distances were computed."""
    best = np.full(len(queries), np.inf) if queries.dtype != object else np.full(len(queries), 1 << 4096, dtype=object)
    entry = np.full(len(queries), len(entries), dtype=np.int64)
    counted = 0

    def reach(at: np.ndarray) -> np.ndarray:
        if queries.dtype != object:
            return np.sqrt(best[at]) * (1 + MARGIN)
        return np.array([float(x) if x < 1 << 1000 else np.inf for x in best[at]]) ** 0.5 * (1 + MARGIN)

    def visit(node: Node, at: np.ndarray) -> None:
        nonlocal counted
        if not len(at):
            return
        squares = _squared(queries[at], entries[node.splits])
        counted += squares.size
        for i, number in enumerate(node.splits):
            d = squares[:, i]
            better = (d < best[at]) | ((d == best[at]) & (number < entry[at]))
            best[at[better]], entry[at[better]] = d[better], number
        if not node.children:
            return
        roots = np.sqrt(squares.astype(np.float64))
        own = np.argmin(roots, axis=1)
        for first in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                mine = np.flatnonzero((own == j) == first)
                if not len(mine):
                    continue
                r, near = reach(at[mine])[:, None], roots[mine]
                out = (near * (1 - MARGIN) - r > node.high[None, :, j]) | (near * (1 + MARGIN) + r < node.low[None, :, j])
                visit(child, at[mine[~out.any(axis=1)]])

    visit(root, np.arange(len(queries)))
    return entry, best, counted


def _cuts(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as float64, exact there, or as Python integers where products are too large."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() < 2.0**40 / scale:
        return np.floor(values * float(scale))
    whole = [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * float(scale))) for x in values.ravel()]
    return np.array(whole, dtype=object).reshape(values.shape)


class Codebooks:
    """The codebooks of all parts, each with its tree."""

    def __init__(self, entries: list[list[list[int]]], length: int):
        self.entries, self.cuts = entries, _cuts(length, len(entries))
        self.trees = []
        for book, start, stop in zip(entries, self.cuts, self.cuts[1:]):
            whole = np.array(book, dtype=object).reshape(len(book), stop - start)
            small = whole.astype(np.float64) if all(abs(x) < 2**53 for row in book for x in row) else None
            use = small if small is not None and _exact(small, small) else whole
            self.trees.append((whole, small, Node(np.arange(len(book)), use) if book else None))

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, the part of every vector, its entry, its squared distance)."""
        for part, (whole, small, tree) in enumerate(self.trees):
            mine = vectors[:, self.cuts[part]:self.cuts[part + 1]]
            if small is not None and mine.dtype != object and _exact(mine, small):
                entry, square, _ = nearest_entries(mine, small, tree)
            else:
                exact = np.array([[int(x) for x in row] for row in mine], dtype=object).reshape(mine.shape)
                entry, square, _ = nearest_entries(exact, whole, tree)
            yield part, mine, entry, square

    def digest(self) -> str:
        text = ",".join(str(x) for book in self.entries for row in book for x in row)
        return hashlib.sha256(text.encode()).hexdigest()


def _blocks(batch: pa.RecordBatch, length: int, scale: int):
    column = batch.column("_v")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = max(1, BLOCK_VALUES // max(length, 1))
    for start in range(0, batch.num_rows, rows):
        stop = min(start + rows, batch.num_rows)
        yield start, stop, scaled(flat[start * length:stop * length].reshape(stop - start, length), scale)


def _sums(books: Codebooks, length: int, scale: int):
    """Per task, part and entry: how many parts, and their sum cut into high and low 32 bits."""
    def run(batches):
        totals = [[[0, None] for _ in book] for book in books.entries]
        for batch in batches:
            for _, _, vectors in _blocks(batch, length, scale):
                for part, mine, entry, _ in books.assign(vectors):
                    order = np.argsort(entry, kind="stable")
                    ordered = entry[order]
                    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                    if not mine.shape[1]:
                        added = np.zeros((len(firsts), 0), dtype=object)
                    else:
                        # floored components are below 2**40 unless they are Python integers
                        whole = mine[order] if mine.dtype == object else mine[order].astype(np.int64)
                        added = np.add.reduceat(whole, firsts, axis=0)
                    for e, n, s in zip(ordered[firsts], np.diff([*firsts, len(ordered)]), added):
                        seat = totals[part][e]
                        seat[0] += int(n)
                        whole = [int(x) for x in s]
                        seat[1] = whole if seat[1] is None else [a + b for a, b in zip(seat[1], whole)]
        out = [(p, e, n, pos, x >> 32, x & 0xFFFFFFFF) for p, book in enumerate(totals)
               for e, (n, s) in enumerate(book) if n for pos, x in enumerate(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(6)],
            names=["part", "entry", "n", "position", "high", "low"])
    return run


def _code(books: Codebooks, length: int, scale: int):
    hexes = np.array([f"{i:02x}" for i in range(max(256, max(map(len, books.entries), default=0)))], dtype=object)

    def run(batches):
        for batch in batches:
            codes, errors = [], []
            for start, stop, vectors in _blocks(batch, length, scale):
                code, error = np.full(stop - start, "", dtype=object), np.zeros(stop - start, dtype=object)
                for _, _, entry, square in books.assign(vectors):
                    code = code + hexes[entry]
                    error = error + (square.astype(np.int64) if square.dtype != object else square)
                codes += code.tolist()
                errors += [min(int(x), LARGEST) for x in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"])
    return run


def product_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                  parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every vector that takes part, and the codebooks."""
    ready(df.sparkSession)
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = df.where(x.isNotNull() & ~bad).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), x.alias("_v"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("_v")]
    least = rows.orderBy(*order).first()
    length = 0 if least is None else len(least["_v"])
    same = rows.where(F.size("_v") == length)
    seeds = [[int(v) for v in scaled(np.array(r["_v"], dtype=np.float64), scale)]
             for r in same.orderBy(*order).limit(entries).collect()]
    cuts = _cuts(length, parts)
    books = Codebooks([[s[a:b] for s in seeds] for a, b in zip(cuts, cuts[1:])], length)

    columns = "part long, entry long, n long, position long, high long, low long"
    for _ in range(rounds if seeds else 0):
        found = same.select("_v").mapInArrow(_sums(books, length, scale), columns)
        # a sum for every component of every entry: bounded by the codebooks' size
        sums = found.groupBy("part", "entry", "position").agg(
            F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
            F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
        new = [[list(row) for row in book] for book in books.entries]
        for r in sums:
            new[r["part"]][r["entry"]][r["position"]] = (int(r["high"]) * 2**32 + int(r["low"])) // r["n"]
        books = Codebooks(new, length)

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"
    coded = same.mapInArrow(_code(books, length, scale), schema)
    others = rows.where(F.size("_v") != length).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(others), books


def op12(spark, sf_dir: str) -> DataFrame:
    from lakeaudit.llm.common import table

    coded, books = product_codes(table(spark, sf_dir, "embeddings"))
    coded = durable(coded)
    known = coded.select("vec_id", "code", "error", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"),
                         F.col("label").isNull().alias("_none"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)"))
    sums = known.groupBy("_label", "_none").agg(total.cast("long").alias("label_error"))
    joined = salted_join(known, sums, ["_label", "_none"], "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _op12_sql(rounds: int = 4) -> str:
    """Every round as two common table expressions: nearest entries, then floored means."""
    assign = """a{i} AS MATERIALIZED (
  SELECT vec_id, part, p, arg_min(entry, key) AS entry, min(d) AS d FROM (
    SELECT s.vec_id, s.part, s.p, c.entry, d, d * 256 + c.entry AS key
    FROM s JOIN c{i} c USING (part), LATERAL (
      SELECT CAST(list_sum(list_transform(list_zip(s.p, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d))
  GROUP BY vec_id, part, p)"""
    update = """c{j} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
    SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS e FROM (
      SELECT part, entry, i, CAST(sum(p[i]) AS DOUBLE) AS total, count(*) AS n
      FROM a{i}, range(1, 17) r(i) GROUP BY part, entry, i) GROUP BY part, entry) m USING (part, entry))"""
    steps = []
    for i in range(rounds + 1):
        steps.append(assign.format(i=i))
        if i < rounds:
            steps.append(update.format(i=i, j=i + 1))
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT vec_id, part, v[part * 16 + 1:part * 16 + 16] AS p FROM v, range(4) t(part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e FROM s
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256)
), {", ".join(steps)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""


OP12_SQL = _op12_sql()
