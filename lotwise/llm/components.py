"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import merge_join, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for every node of ``links`` (a, b).

    ``links`` should be a stored table. Alternates large-star and small-star steps until every node is linked with one
    other only; their number grows with the logarithm of the longest path. Nodes with
    many links cost one row a task in the aggregates, and the joins have keys that
    adaptive execution can split. Each round is written to the shared folder.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        unfinished = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up * down > 0")
        if unfinished.isEmpty():
            break
    # every component is a star now: a is linked with the smallest node b
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return nodes.unionByName(centres)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked with its smallest neighbour. Links may repeat."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("low"))
    moved = merge_join(both, smallest, F.col("a") == F.col("node")).where("b > a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them."""
    smallest = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = merge_join(links, smallest, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = smallest.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
