"""Graphs from ordered items and from shared keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.tables import stage


def next_of(rows: DataFrame, by: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Rows with ``next_<column>`` of the row that follows."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})


def directed_edges(rows: DataFrame, by: list[str], order: list[Column], node: str) -> DataFrame:
    """(a, b, weight): how often a is followed by a different b; rows with a null node are passed over before pairing."""
    pairs = next_of(rows.where(F.col(node).isNotNull()), by, order, [node])
    return pairs.where(F.col(f"next_{node}").isNotNull() & (F.col(node) != F.col(f"next_{node}"))).groupBy(F.col(node).alias("a"), F.col(f"next_{node}").alias("b")).agg(F.count("*").alias("weight"))


def neighbour_edges(rows: DataFrame, by: list[str], order: list[Column], node: str) -> DataFrame:
    """The same without direction, the lesser node first."""
    e = directed_edges(rows, by, order, node)
    return e.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("weight").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("weight").alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("o"), F.col("weight").alias("i")))
    return both.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def clusters(members: DataFrame, item: str, key: str, most_rounds: int = 200) -> DataFrame:
    """(item, component): items that share any key, transitively, named by the least item.

    Labels spread through keys by minima, which are summed before they are
    shuffled; every round is written to the shared folder, so no lineage grows
    and nothing is held by one task.
    """
    members = stage(members.select(item, key).where(F.col(key).isNotNull()).distinct(), "cluster_members")
    labels = stage(members.select(item).distinct().withColumn("component", F.col(item)), "cluster_labels")
    for _ in range(most_rounds):
        of_key = members.join(labels, item).groupBy(key).agg(F.min("component").alias("component"))
        reached = members.join(of_key, key).groupBy(item).agg(F.min("component").alias("component"))
        # A label's own label is nearer to the root, which halves long chains.
        above = reached.select(F.col(item).alias("_root"), F.col("component").alias("_above"))
        new = reached.join(above, F.col("component") == F.col("_root"), "left").select(item, F.least("component", "_above").alias("component"))
        new = stage(new, "cluster_labels")
        changed = new.join(labels.withColumnRenamed("component", "_before"), item).where("component <> _before")
        if changed.isEmpty():
            return new
        labels = new
    raise RuntimeError(f"clusters did not settle in {most_rounds} rounds")
