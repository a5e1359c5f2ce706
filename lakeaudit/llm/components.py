"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the least node it is joined to.

    Large-star and small-star steps in turn: each node's neighbours are tied to the least of them, so
    stars grow and paths halve; the rounds grow with the logarithm of the longest path. Every round
    is checkpointed. A step ends when the edges are stars and no longer change.
    """
    edges = durable(edges.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours go to the least one
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: the node itself and its smaller neighbours go to the least one
        down = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(down, large["b"] == down["u"]).select(F.col("m").alias("a"), large["a"].alias("b"))
        small = small.where("a <> b").union(down.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        edges = durable(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    tied = edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return tied.union(edges.select("a", "a").distinct())
