"""Hierarchical language identification: family first, then one-versus-one within the family.

``fit`` learns from a bounded sample of labelled rows: at most ``rows_per_language`` documents per
language, each as a whole and as a few runs of words from the middle of it, so that short texts
are learned too. Features are hashed byte n-grams, as square roots of their shares with length one.
Languages whose mean vectors are more alike than languages are on average form a family. Linear
support vector machines (dual coordinate descent) separate each family from the rest, and each pair
of languages within a family. Whole texts are predicted, in one pass without a shuffle.

Defined results
  * A null text or one without a letter is ``und`` with score 0; so is every text if nothing labelled
    was there to learn from. With one language, that language has score 1.
  * Rows with a null key are not learned from and not held out. Repeated rows are rows.
  * ``predict`` adds or replaces ``lang_pred`` and ``score`` and keeps all other columns.
  * The score is the family's share of certainty times the language's, each a logistic value.
  * Languages are labels; their number must suit the driver (a vector of weights per pair).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import give_back, ready, table, text_slices

#: Bound of the sample that the classifiers are fitted on, per language.
ROWS_PER_LANGUAGE = 400
#: Words in the runs that are learned besides the whole text.
RUNS = (3, 8, 30)
WIDTH = 4096
UNKNOWN = "und"
#: Texts of one matrix of features (16 MB).
MOST_ROWS = 1024

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def vectors(column: pa.Array):
    """(first row, matrix of feature vectors, whether each text has a letter) for runs of rows."""
    for start, stop, data, offsets in text_slices(column, most_rows=MOST_ROWS):
        low = _LOWER[data]
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
        has = letters[offsets[1:]] > letters[offsets[:-1]]
        two = low[:-1] * np.uint32(0x9E3779B1) + low[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] + low[2:] * np.uint32(0xC2B2AE35)
        four = three[:-1] + low[3:] * np.uint32(0x27D4EB2F)
        places = [((g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20) for g in (two, three, four)]
        out = np.zeros((stop - start, WIDTH), dtype=np.float32)
        for i in range(stop - start):
            a, b = offsets[i], offsets[i + 1]
            if b - a >= 2:
                own = np.concatenate([g[a:max(b - n, a)] for n, g in enumerate(places, 1)])
                counts = np.sqrt(np.bincount(own, minlength=WIDTH).astype(np.float32))
                out[i] = counts / np.sqrt(max(len(own), 1))
            if not has[i] and b > a:
                has[i] = any(map(str.isalpha, data[a:b].tobytes().decode("utf-8", "replace")))
        yield start, out, has


def linear_svm(x: np.ndarray, positive: np.ndarray, c: float = 10.0, epochs: int = 12,
               rows: np.ndarray | None = None) -> np.ndarray:
    """Weights of an L2-loss SVM; both classes weigh the same in total. The last column of ``x`` is 1.

    ``rows`` are the rows of ``x`` to learn from (all, if not given); they are read one by one, not copied.
    """
    rows = np.arange(len(x)) if rows is None else rows
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.mean(), 1e-9), 0.5 / max(1 - positive.mean(), 1e-9))
    damp = 0.5 / (c * share)
    square = np.empty(len(rows))
    for at in range(0, len(rows), MOST_ROWS):
        part = x[rows[at:at + MOST_ROWS]].astype(np.float32)
        square[at:at + MOST_ROWS] = np.einsum("ij,ij->i", part, part)
    square += damp
    alpha, w = np.zeros(len(rows)), np.zeros(x.shape[1])
    order = np.random.default_rng(3)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            row = x[rows[i]].astype(np.float64)
            slope = y[i] * (row @ w) - 1 + damp[i] * alpha[i]
            step = max(alpha[i] - slope / square[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * row
    return w.astype(np.float32)


def families(means: np.ndarray) -> list[list[int]]:
    """Groups of rows that are more alike than rows are on average (average linkage)."""
    groups = [[i] for i in range(len(means))]
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    like = unit @ unit.T
    if len(groups) < 3:
        return [list(range(len(groups)))] if groups else []
    usual = like[np.triu_indices(len(means), 1)].mean()
    while len(groups) > 1:
        best, a, b = max((like[np.ix_(g, h)].mean(), i, j)
                         for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j)
        if best <= usual:
            break
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


@dataclass
class Model:
    languages: list[str]
    groups: list[list[int]]
    family_weights: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_weights: np.ndarray | None = None

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language numbers, scores) of feature vectors."""
        # the last weight is the bias
        sure = np.ones((len(x), 1)) if len(self.groups) == 1 else _logistic(
            x @ self.family_weights[:, :-1].T + self.family_weights[:, -1])
        family = sure.argmax(1)
        share = sure[np.arange(len(x)), family] / np.maximum(sure.sum(1), 1e-12)
        language, score = np.zeros(len(x), dtype=np.int64), share.copy()
        margins = x @ self.pair_weights[:, :-1].T + self.pair_weights[:, -1] if self.pairs else None
        for f, members in enumerate(self.groups):
            rows = np.flatnonzero(family == f)
            if len(members) == 1:
                language[rows] = members[0]
                continue
            votes = np.zeros((len(rows), len(members)))
            for p, (a, b) in enumerate(self.pairs):
                if a in members:
                    first = _logistic(margins[rows, p])
                    votes[:, members.index(a)] += first
                    votes[:, members.index(b)] += 1 - first
            top = votes.argmax(1)
            language[rows] = np.array(members)[top]
            score[rows] *= votes[np.arange(len(rows)), top] / (len(members) - 1)
        return language, np.clip(score, 0.0, 1.0)


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2.0 * margin, -30, 30)))


def _examples(batches):
    """Feature vectors of sampled texts and of runs of their words."""
    for batch in batches:
        texts, labels, seats = [], [], []
        columns = (batch.column(i).to_pylist() for i in range(3))
        for text, label, seed in zip(*columns):
            words = text.split()
            runs = [text]
            for k, n in enumerate(RUNS):
                at = (seed >> (8 * k)) % max(len(words) - n + 1, 1)
                runs.append(" ".join(words[at:at + n]))
            texts += runs
            labels += [label] * len(runs)
            seats += list(range(len(runs)))
        for start, x, has in vectors(pa.array(texts, pa.string())):
            own = slice(start, start + len(x))
            yield pa.record_batch({
                "label": pa.array(labels[own], pa.string()), "whole": pa.array([s == 0 for s in seats[own]]),
                # mostly zeros: a tenth of the bytes passes through the driver
                "x": pa.array([zlib.compress(r.astype(np.float16).tobytes(), 1) if h else None for r, h in zip(x, has)], pa.binary())})


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", key_col: str = "doc_id",
        rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learns from at most ``rows_per_language`` rows per label, chosen by a hash of the key."""
    ready(labelled.sparkSession)
    known = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull() & F.col(key_col).isNotNull())
    known = known.select(F.col(text_col).alias("t"), F.col(label_col).cast("string").alias("label"),
                         F.abs(F.xxhash64(key_col)).alias("seed"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes:
        return Model([], [], np.zeros((0, WIDTH + 1), dtype=np.float32))
    # a hash threshold leaves a little more than the bound; the window then holds that much per label
    part = F.lit(0.0)
    for label, n in sizes.items():
        part = F.when(F.col("label") == label, F.lit(min(1.0, 1.3 * rows_per_language / n))).otherwise(part)
    sample = known.where(F.pmod(F.col("seed"), F.lit(1_000_003)) < part * 1_000_003)
    seat = F.row_number().over(Window.partitionBy("label").orderBy("seed", F.crc32("t")))
    sample = sample.withColumn("_seat", seat).where(F.col("_seat") <= rows_per_language).drop("_seat")
    found = sample.mapInArrow(_examples, "label string, whole boolean, x binary").where("x is not null").toArrow()
    labels = found["label"].to_pylist()
    languages = sorted(set(labels))
    if not languages:
        return Model([], [], np.zeros((0, WIDTH + 1), dtype=np.float32))
    number = {n: i for i, n in enumerate(languages)}
    y = np.array([number[n] for n in labels])
    order = np.lexsort(([zlib.crc32(zlib.decompress(b.as_py())) for b in found["x"]], y))  # the same model for any order of rows
    y, whole = y[order], found["whole"].to_numpy()[order]
    x = np.ones((len(y), WIDTH + 1), dtype=np.float16)  # one copy: this is most of what the driver holds
    seat = np.empty(len(order), dtype=np.int64)
    seat[order] = np.arange(len(order))
    for i, blob in zip(seat.tolist(), found["x"]):
        x[i, :WIDTH] = np.frombuffer(zlib.decompress(blob.as_py()), dtype=np.float16)
    del found
    give_back()
    means = []
    for i in range(len(languages)):
        own = (y == i) & whole
        means.append(x[own if own.any() else y == i, :WIDTH].astype(np.float32).mean(0))
    groups = families(np.stack(means))
    family = np.zeros(len(languages), dtype=np.int64)
    for f, members in enumerate(groups):
        family[members] = f
    weights = [linear_svm(x, family[y] == f) for f in range(len(groups))] if len(groups) > 1 else []
    pairs = [(a, b) for members in groups for i, a in enumerate(members) for b in members[i + 1:]]
    pair_weights = []
    for a, b in pairs:
        rows = np.flatnonzero((y == a) | (y == b))
        pair_weights.append(linear_svm(x, y[rows] == a, rows=rows))
    return Model(languages, groups, np.array(weights), pairs, np.array(pair_weights) if pairs else None)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    ready(docs.sparkSession)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def language(texts: pa.Array) -> pa.Array:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if model.languages:
            for start, x, has in vectors(texts):
                picked, score = model.predict(x)
                for i in np.flatnonzero(has):
                    names[start + i] = model.languages[picked[i]]
                    scores[start + i] = score[i]
        give_back()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    # a filter on the language would otherwise be pushed below it and predict every text a second time
    found = docs.withColumn("_language", language.asNondeterministic()(F.col(text_col).cast("string")))
    return found.withColumns({
        "lang_pred": F.col("_language")["lang_pred"], "score": F.col("_language")["score"]}).drop("_language")


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; rows with 2 are held out."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold(F.col("doc_id")) != 2))
    slim = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "text")
    return predict(slim, model).select("doc_id", "held_out", "lang_pred", "score")
