"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import hot_join
from sparkprep.workspace import settle


def _pointed(edges: DataFrame, toward: str) -> DataFrame:
    """Each node's least neighbour; its neighbours of one side are linked to that."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if toward == "small":
        both = both.where("b < a")
    both = settle(both, "links")
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    least = settle(least.select("a", F.least("a", "m").alias("m"), "n"), "least")
    joined = hot_join(both, least, ["a"], "n")
    if toward == "large":
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node that has a link.

    ``edges`` has columns ``a`` and ``b``. Alternating steps link each node's larger neighbours, then
    its smaller ones, to its least neighbour, until only stars are left; that takes a number of steps
    that grows with the logarithm of the number of nodes.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges.distinct(), "edges")
    state = None
    while True:
        edges = settle(_pointed(settle(_pointed(edges, "large"), "large-star"), "small"), "small-star")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
