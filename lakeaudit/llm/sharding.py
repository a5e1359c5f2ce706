"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair draws ``u`` in (0, 1) from its MD5 digest and scores ``weight / -ln(u)``; the
shard with the highest score takes the record. A shard's scores do not depend on the others, so a
new shard takes records only into itself and a removed one gives only its own records away. Shard i
of weight w receives the share w / sum(weights) of the keys. Nothing is shuffled to place a record.

Defined results
  * Equal keys go to one shard. A null key is a key of its own (the text ``\\N``, which no number has).
  * A null text has no bytes: size 1, checksum 0. Empty tables give empty results.
  * Slots number a shard's records without gaps in the order (key, size, checksum); repeated rows
    are counted before they are shuffled and then take neighbouring slots, so a key that holds much
    of the table does not meet in one task.
  * Other columns are ignored by ``slots`` and kept by ``assign``; names that it adds replace columns
    of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import gapless, table

_DIGITS = 13  # 52 bits, exact in a double


def _draw(key: Column, shard: int) -> Column:
    digest = F.md5(F.concat(key, F.lit(f"/{shard}")))
    whole = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
    return (whole + F.lit(0.5)) / F.lit(float(16**_DIGITS))


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("\\N"))


def rendezvous(key: Column, weights: Sequence[float], known: Column | None = None, known_draws: int = 0) -> Column:
    """Number of the shard that takes ``key``. Shards of weight 0 take nothing.

    ``known`` may be the result for the first ``known_draws`` weights; only its score and those of the
    later shards are then drawn.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("one weight at least must be positive")
    if any(w < 0 for w in weights):
        raise ValueError("weights must not be negative")

    def wait(i: int) -> Column:  # exponential waiting time: the least one wins
        return -F.log(_draw(key, i)) / F.lit(float(weights[i]))

    entries = [F.struct(wait(i).alias("wait"), F.lit(i).alias("shard"))
               for i, w in enumerate(weights) if w > 0 and i >= known_draws]
    if known is not None:
        entries.append(known)
    best = F.least(*entries) if len(entries) > 1 else entries[0]
    return best


def assign(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None,
           name: str = "shard", grown_name: str = "grown_shard") -> DataFrame:
    """Adds the shard of every row; with ``grown`` (weights that begin with ``weights``) also the
    shard that the row has after the list has grown."""
    columns = {"_best": rendezvous(key_text(F.col(key)), weights)}
    out = df.withColumns(columns)
    if grown is not None:
        if list(grown[:len(weights)]) != list(weights):
            raise ValueError("the grown list must begin with the old weights")
        after = rendezvous(key_text(F.col(key)), grown, F.col("_best"), len(weights))
        out = out.withColumn(grown_name, after["shard"].cast("int"))
    return out.withColumn(name, F.col("_best")["shard"].cast("int")).drop("_best")


def slots(df: DataFrame, shard: str, order: Sequence[str], name: str = "slot", parts: int = 1024) -> DataFrame:
    """Adds gapless numbers from 0 within each shard; see ``common.gapless``."""
    return gapless(df, shard, order, name, parts)


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, tasks_per_shard: int = 8) -> None:
    """Writes whole records as Parquet, a folder ``shard=i`` for each shard."""
    placed = assign(df, key, weights)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != "shard"]), F.lit(tasks_per_shard))
    placed.repartition("shard", spread).write.mode("overwrite").partitionBy("shard").parquet(path)


SHARDS = 16


def op2(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = assign(docs, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    out = slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
