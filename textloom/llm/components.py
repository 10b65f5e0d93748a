"""Connected components of a graph that is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.tables import stage


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b); a component is named by its least node.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected
    components in MapReduce and beyond", 2014): every node points its larger,
    then its smaller neighbours to the least node that it knows, until nothing
    changes. Only minima meet at a node, as map-side aggregates, so a node with
    many neighbours costs one task no more than any other.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stage(edges, "component_edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "component_edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.unionByName(roots)
