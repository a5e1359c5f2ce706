"""Joins of a large side with a table that has a row per key, when one key may fill the large side.

Adaptive execution splits a skewed join only when both inputs come straight out of a shuffle, and a
side that was grouped on the key does not. A hash of the keys joins along with them, so both sides
are shuffled for the join itself and a hot key is split; no key is counted, no row is copied, and
building the plan runs nothing. The sides are merged: the size of a compressed file says little of
the memory that its rows take as a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """left ⟕ right for a right side with one row per key. Null keys match nothing."""
    keys, on = list(keys), list(keys)
    types = [left.schema[k].dataType for k in keys]
    # equal values hash alike where both sides have one type, unless its collation takes different texts as equal
    if types == [right.schema[k].dataType for k in keys] and not any("collate" in t.simpleString() for t in types):
        mark = F.xxhash64(*[F.col("`" + k.replace("`", "``") + "`") for k in keys])
        left, right, on = left.withColumn("_mark", mark), right.withColumn("_mark", mark), [*keys, "_mark"]
    return left.join(right.hint("merge"), on, "left").drop("_mark")
