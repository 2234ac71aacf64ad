"""Connected components of a graph given as edges, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import stored


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Join each node's neighbours to the smallest of them and itself: the larger neighbours, or the smaller ones."""
    if larger:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))     # a is the larger end
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    joined = around.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("root").alias("a"), "b")
    else:
        moved = (joined.select(F.col("root").alias("a"), "b")
                 .union(least.select(F.col("root").alias("a"), F.col("a").alias("b"))))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every node with an edge; the component is its smallest node.

    ``edges`` has columns a and b, in any order. Rounds of large and small stars shrink every component to one star, in
    about as many rounds as the logarithm of its width. Each round is stored.
    """
    current = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .distinct(), "edges")
    mark = None
    while True:
        after = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if after == mark or not after["n"]:
            return current.select(F.col("b").alias("doc_id"), F.col("a").alias("component_id"))
        mark = after
        current = stored(_stars(_stars(current, larger=True), larger=False), "edges")
