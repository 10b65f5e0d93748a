"""What a chapter's chains of transmission say: who is prolific, how long chains are, how gradings fall, what corroborates what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.operators.ordering import numbered
from textloom.operators.volumes import running
from textloom.tables import spread, stage


def excluded(profile: DataFrame, placeholder: Column) -> DataFrame:
    """With ``is_excluded``: sources, and names that stand for nobody."""
    return profile.withColumn("is_excluded", F.coalesce(placeholder, F.lit(False)) | F.col("is_source"))


def prolific(links: DataFrame, chapter: str, item: str, member: str, left_out: DataFrame, top: int = 15) -> DataFrame:
    """(chapter, member, n, share, place): members of the most items of a chapter, each item counted once, without those left out."""
    seen = links.select(chapter, item, member).where(F.col(member).isNotNull()).distinct()
    items = seen.groupBy(chapter).agg(F.count_distinct(item).alias("n_items"))
    n = seen.join(left_out.select(member).distinct(), member, "left_anti").groupBy(chapter, member).agg(F.count("*").alias("n")).join(items, chapter)
    place = F.row_number().over(Window.partitionBy(chapter).orderBy(F.desc("n"), member))
    return n.withColumn("place", place.cast("long")).where(F.col("place") <= top).select(chapter, member, "n", F.round(F.col("n") / F.col("n_items"), 3).alias("share"), "place")


def chain_lengths(links: DataFrame, chapter: str, item: str) -> DataFrame:
    """(chapter, n_chains, least, most, mean, median) of the number of links of a chain; the median is truncated."""
    n = links.groupBy(chapter, item).agg(F.count("*").alias("n"))
    return n.groupBy(chapter).agg(F.count("*").alias("n_chains"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 2).alias("mean"), F.floor(F.median("n")).alias("median"))


def length_histogram(links: DataFrame, chapter: str, item: str) -> DataFrame:
    """(chapter, length, n_chains)."""
    return links.groupBy(chapter, item).agg(F.count("*").alias("length")).groupBy(chapter, "length").agg(F.count("*").alias("n_chains"))


def grading_mix(rows: DataFrame, chapter: str, scholar: Column, grade: Column) -> DataFrame:
    """(chapter, scholar, grade, n)."""
    return rows.groupBy(chapter, scholar.alias("scholar"), grade.alias("grade")).agg(F.count("*").alias("n"))


def corroboration(links: DataFrame, chapter: str, item: str, member: str, clusters: DataFrame, cluster: str, least: int = 2, rows: int = 0) -> DataFrame:
    """(chapter, member, n_items, n_paths): members that several clusters of items, which share nothing else, lead to; ``rows`` says about how many links there are."""
    met = spread(links.select(chapter, item, member), rows, item).distinct().join(spread(clusters.select(item, cluster), rows, item), item)
    met = spread(met, rows, chapter, member)
    out = met.groupBy(chapter, member).agg(F.count_distinct(item).alias("n_items"), F.count_distinct(cluster).alias("n_paths"))
    return out.where((F.col("n_items") >= least) & (F.col("n_paths") >= least))


def shared_members(links: DataFrame, item: str, member: str, clusters: DataFrame, cluster: str, top: int = 5, rows: int = 0) -> DataFrame:
    """(cluster, member, n, place): who holds the items of a cluster together, that is, occurs in more than one of them; ``rows`` says about how many links there are."""
    met = spread(links.select(item, member), rows, item).distinct().join(spread(clusters.select(item, cluster), rows, item), item)
    met = spread(met, rows, cluster)
    n = met.groupBy(cluster, member).agg(F.count("*").alias("n")).where("n > 1")
    place = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc("n"), member))
    return n.withColumn("place", place.cast("long")).where(F.col("place") <= top)


def first_seen_ids(rows: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """(name, id): a number for each distinct name, from 1, by where it is seen first.

    The order of names needs one sort of the distinct names; ties fall to the
    lesser name.
    """
    firsts = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(F.struct(*order)).alias("_first"))
    ranged = stage(firsts.repartitionByRange("_first", name).withColumn("_range", F.spark_partition_id()), "first_seen")
    inside = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy("_first", name)))
    sizes = inside.groupBy("_range").agg(F.count("*").alias("_size"))
    before = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before"))  # a row for each range
    return inside.join(before, "_range").select(name, (F.col("_before") + F.col("_n")).cast("long").alias("id"))


def cumulative_place(rows: DataFrame, order: Column, size: str, numbers: DataFrame, number: str) -> DataFrame:
    """Each number, from 1, with the row in which it falls when the rows' sizes are laid end to end, and its place there; numbers beyond the end drop out.

    Places and starts of the rows are running sums by ranges, and a number
    finds the last start before it in the same way: rows and numbers lie in
    one order, so neither side is sent whole nor met by all of the other.
    """
    laid = numbered(rows.where(F.col(size) > 0).withColumn("_order", order), [], ["_order"], "_n").drop("_order")
    laid = running(laid, [], "_n", 50_000, {"_end": F.col(size)})
    starts = stage(laid.withColumn("_start", F.col("_end") - F.col(size)).drop("_n"), "range_starts")
    one = F.struct(*starts.columns)
    total = starts.agg(F.coalesce(F.max("_end"), F.lit(0))).first()[0]
    # A start at s comes before the number s + 1, whose place it is.
    marks = starts.select((F.col("_start") * 2).alias("_at"), one.alias("_row"), F.lit(None).cast(numbers.select(F.struct("*")).schema[0].dataType).alias("_number"))
    asked = numbers.where(F.col(number).between(1, total)).select(((F.col(number) - 1) * 2 + 1).cast("long").alias("_at"), F.lit(None).cast(marks.schema["_row"].dataType).alias("_row"), F.struct("*").alias("_number"))
    width = max(2, 2 * total // 1000)
    met = running(marks.unionByName(asked), [], "_at", width, latest={"_last": F.col("_row")}).where("_number IS NOT NULL")
    kept = [c for c in starts.columns if c not in ("_start", "_end")]
    return met.select("_number.*", *[F.col(f"_last.{c}").alias(c) for c in kept], (F.col(f"_number.{number}") - F.col("_last._start")).alias("place"))
