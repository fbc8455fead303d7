"""Connected components of an edge table, by large-star and small-star steps.

Each step replaces a node's edges by edges to the smallest node it sees; the
edges become one star a component after a number of rounds that grows with the
logarithm of the graph.  Minima are combined before each shuffle, every round's
edges are written to the shared folder, and no node's neighbours are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.store import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type; returns (node, root) for every
    node of an edge, the root being the smallest node of the component.
    Loops and repeated edges are allowed; an edge with a null end is ignored."""
    e = saved(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join deals plain edges, and Spark can split those of a node with very many
        low = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "edge-minima")
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = saved(small, "edges")
        after = _state(e)
        if after == state:
            break
        state = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
