"""Counts, votes, profiles and indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def posting_ends(rows: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys, n_items, first, last) of the items of each key; ``ordering.blocked_lists`` has them all."""
    return rows.groupBy(*keys, item).agg(F.lit(1).alias("_one")).groupBy(*keys).agg(F.count(item).alias("n_items"), F.min(item).alias("first"), F.max(item).alias("last"))


def surface_counts(rows: DataFrame, id_col: str, words: Column) -> DataFrame:
    """(surface, n, n_texts, first_text) of each distinct word. Texts are laid out by id, so a word's counts by text are added up before they travel."""
    said = rows.repartition(F.col(id_col)).select(id_col, F.explode(words).alias("surface"))
    each = said.groupBy("surface", id_col).agg(F.count("*").alias("n"))
    return each.groupBy("surface").agg(F.sum("n").alias("n"), F.count(id_col).alias("n_texts"), F.min(id_col).alias("first_text"))


def surface_summary(counts: DataFrame) -> DataFrame:
    once, often = F.count_if(F.col("n") == 1), F.count_if(F.col("n") >= 10)
    return counts.agg(F.count("*").alias("n_surfaces"), F.sum("n").alias("n_tokens"), F.max("n").alias("most"), F.min("n").alias("least"), once.alias("n_once"), often.alias("n_often"))


def modal_vote(rows: DataFrame, key: str, value: str, least: int = 10, share: float = 0.9) -> DataFrame:
    """(key, winner, votes, total) where enough rows vote and the most frequent value has the share; the smaller value on ties."""
    votes = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), value)
    ranked = votes.withColumns({"place": F.row_number().over(order), "total": F.sum("n").over(Window.partitionBy(key))})
    return ranked.where((F.col("place") == 1) & (F.col("total") >= least) & (F.col("n") >= share * F.col("total"))).select(key, F.col(value).alias("winner"), F.col("n").alias("votes"), "total")


def role_profile(rows: DataFrame, key: str, role: str, source_roles: list[str]) -> DataFrame:
    """(key, n_roles, n_source, is_source): a key is a source if at least half of its roles are."""
    source = F.count_if(F.col(role).isin(*source_roles))
    p = rows.groupBy(key).agg(F.count(role).alias("n_roles"), source.alias("n_source"))
    return p.withColumn("is_source", (F.col("n_source") > 0) & (2 * F.col("n_source") >= F.col("n_roles")))


def rollup_counts(rows: DataFrame, levels: list[str], counted: Column) -> DataFrame:
    """Counts on every level of a hierarchy; zero counts dropped. ``level`` is the depth of the total."""
    out = rows.where(counted).rollup(*levels).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    depth = F.lit(len(levels)) - F.bit_count("gid")
    return out.select(*levels, depth.cast("long").alias("level"), "n")


def cooccurrence(rows: DataFrame, id_col: str, a: Column, b: Column) -> DataFrame:
    """(a, b, n): documents in which a word of array ``a`` meets one of array ``b``."""
    made = rows.select(id_col, F.explode(F.array_distinct(a)).alias("a"), F.array_distinct(b).alias("bs"))
    return made.select("a", F.explode("bs").alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))


def top_per_key(rows: DataFrame, key: list[str], order: list[Column], top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("place", place.cast("long")).where(F.col("place") <= top)


def outcome_stats(rows: DataFrame, outcome: Column, cost: Column) -> DataFrame:
    """count, total, mean, least and most of a cost by outcome, and the share of the total."""
    by = rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"), F.sum(cost).alias("total"), F.avg(cost).alias("mean"), F.min(cost).alias("least"), F.max(cost).alias("most"))
    return by.withColumn("share", F.col("total") / F.sum("total").over(Window.partitionBy(F.lit(1))))


def coverage(rows: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """For each metric, how many rows have it and the per cent."""
    named = F.array(*[F.struct(F.lit(k).alias("metric"), F.coalesce(v, F.lit(False)).alias("has")) for k, v in metrics.items()])
    x = rows.select(F.explode(named).alias("m")).groupBy("m.metric").agg(F.count_if("m.has").alias("n"), F.count("*").alias("total"))
    return x.withColumn("per_cent", F.round(100 * F.col("n") / F.col("total"), 4))


def length_stats(rows: DataFrame, by: list[str], value: Column) -> DataFrame:
    """least, most, mean and median."""
    return rows.groupBy(*by).agg(F.min(value).alias("least"), F.max(value).alias("most"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.count(value).alias("n"))
