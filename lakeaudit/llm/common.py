"""Shared helpers: worker set-up, word hashing in numpy, packed integers, salted joins."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeaudit.functions.durable import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: The white space that separates words: \x20 and \x09 to \x0D. Fixed by the operators' contracts.
SPACES = b" \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package and makes checkpoints go to the shared folder."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, ROOT) if x)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return spark


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the shared folder; see ``ready``."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Returns what a worker has freed to the system, at the border of a group or a task.

    Workers are used again by later stages and wait beside the JVM, so their peaks would add up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other allocators do without
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner", salts: int = 32,
                spread: Column | None = None) -> DataFrame:
    """``many`` joined with ``one`` (a row per key) when one key may hold much of ``many``.

    Each row of ``one`` is repeated ``salts`` times and rows of ``many`` pick a copy by the hash of
    their other columns, so a hot key meets its partner in ``salts`` tasks. ``keys`` match exactly;
    null keys match nothing (left joins keep their rows).
    """
    if spread is None:
        rest = [c for c in many.columns if c not in keys] or list(many.columns)
        spread = F.xxhash64(*[F.col(c) for c in rest])
    left = many.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def gapless(df: DataFrame, group: str, order: Sequence[str], name: str, parts: int) -> DataFrame:
    """Adds gapless numbers from 0 within each ``group``, however large a group is.

    Rows are dealt into ``parts`` parts per group by the hash of all columns, equal rows are counted
    first, every part is numbered alone and then moved by the total of the parts before it (a row per
    group and part).
    """
    columns = list(df.columns)
    known = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    known = known.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int"))
    before = Window.partitionBy(group, "_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    known = known.withColumn(
        "_start", F.sum("_copies").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    totals = known.groupBy(group, "_part").agg(F.sum("_copies").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"))
    placed = known.join(starts, [group, "_part"])
    first = F.col("_first") + F.coalesce("_start", F.lit(0))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))
    return placed.select(*columns, first.alias("_at"), copy.alias("_copy")).select(
        *columns, (F.col("_at") + F.col("_copy")).alias(name))


# ---------------------------------------------------------------- hashing of words and word windows

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93 | 1


@functools.lru_cache(maxsize=1)
def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    values = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
    lower = values.copy()
    lower[65:91] = values[97:123]
    return values, lower


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 20:  # 8 MB; those of a single longer text do not stay in the worker's memory
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def _string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def text_slices(column: pa.Array, most_bytes: int = 1 << 20, most_rows: int | None = None):
    """(start, stop, bytes, offsets) of runs of rows with about ``most_bytes``, and ``most_rows`` rows if given;
    long texts stand alone."""
    data, offsets = _string_buffers(column)
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
        stop = min(max(stop, start + 1), rows, rows if most_rows is None else start + most_rows)
        yield start, stop, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the offsets of each text's words among them."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~_IS_SPACE[data]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    values = _byte_values()[lower][data]
    values *= _powers(_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    inverse = _powers(pow(_BASE, -1, 2**64), n)
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (runs across texts included: mask them out)."""
    n = len(words)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * _powers(_STEP, n), out=total[1:])
    return mix((total[size:] - total[:-size]) * _powers(pow(_STEP, -1, 2**64), n)[:n - size + 1])


def window_starts(word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, text numbers) of all windows that stay within one text."""
    counts = np.maximum(np.diff(word_offsets) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return word_offsets[:-1][text] + within, text


# ---------------------------------------------------------------- sorted integers in a binary cell

def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted uint64 values as a first value and 4-byte gaps; wider gaps are listed before them."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    wide = np.flatnonzero(gaps >> np.uint64(32)).astype(np.uint32)
    head = np.array([len(wide)], dtype=np.uint64).tobytes() + values[:1].astype(np.uint64).tobytes()
    return head + wide.tobytes() + (gaps[wide] >> np.uint64(32)).astype(np.uint32).tobytes() + gaps.astype(np.uint32).tobytes()


def unpack_sorted(blob: bytes | None) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=np.uint64)
    head = np.frombuffer(blob, dtype=np.uint64, count=2)
    n = int(head[0])
    wide = np.frombuffer(blob, dtype=np.uint32, count=n, offset=16)
    high = np.frombuffer(blob, dtype=np.uint32, count=n, offset=16 + 4 * n).astype(np.uint64)
    gaps = np.frombuffer(blob, dtype=np.uint32, offset=16 + 8 * n).astype(np.uint64)
    gaps[wide] += high << np.uint64(32)
    return np.concatenate([head[1:], head[1] + np.cumsum(gaps, dtype=np.uint64)])


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins in a sorted array."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
