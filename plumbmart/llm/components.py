"""Connected components of a graph by joins: every vertex gets the smallest one it can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbmart.llm.common import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (a, b), a pair in any order.

    Each round a vertex takes the smallest component of its neighbours and then
    that component's own, so paths shorten by doubling and the rounds are about
    the logarithm of the longest path. What a round shuffles is one row an edge
    and vertex; a vertex with many edges is only summed over, and joins of edges
    with vertices leave it to Spark to split the rows of one key. Every round is
    a stored table, so a lost executor costs one round.
    """
    pairs = edges.where("a <> b").select("a", "b")
    both = stored(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-edges")
    state = stored(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("component")), label)
    while True:
        near = both.join(state.withColumnRenamed("vertex", "b"), "b").groupBy(F.col("a").alias("vertex")).agg(F.min("component").alias("near"))
        hop = state.join(near, "vertex").select("vertex", F.least("component", "near").alias("next"), F.col("component").alias("old"))
        up = state.select(F.col("vertex").alias("next"), F.col("component").alias("jump"))
        new = stored(hop.join(up, "next").select("vertex", F.col("jump").alias("component"), (F.col("jump") != F.col("old")).alias("moved")), label)
        state = new.select("vertex", "component")
        if not new.where("moved").limit(1).count():
            return state
