"""Resolving names to entities: cascades of keys, fuzzy matching, duplicate groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions.text import similarity


def cascade(names: DataFrame, name_id: str, candidates: DataFrame, keys: list[tuple[str, Column, Column]], candidate: str, order: list[Column], allowed: Column | None = None) -> DataFrame:
    """(name_id, candidate, stage): the first stage of keys that hits decides, and within it the first candidate.

    ``keys``: (stage, key of a name, key of a candidate), the strictest first.
    ``allowed`` is a condition over both sides that a candidate has to meet at
    every stage. Every stage is an equi-join; the earliest hit is a minimum, so
    no stage has to wait for the one before.
    """
    found = None
    for i, (stage, of_name, of_candidate) in enumerate(keys):
        left = names.withColumn("_key", of_name).where("_key is not null and _key <> ''")
        right = candidates.withColumn("_key", of_candidate).where("_key is not null and _key <> ''")
        hit = left.join(right, "_key")
        hit = hit.where(allowed) if allowed is not None else hit
        hit = hit.select(name_id, F.struct(F.lit(i).alias("at"), *[c.alias(f"o{j}") for j, c in enumerate(order)], F.col(candidate).alias("candidate"), F.lit(stage).alias("stage")).alias("hit"))
        found = hit if found is None else found.unionByName(hit)
    best = found.groupBy(name_id).agg(F.min("hit").alias("hit"))
    out = names.select(name_id).join(best, name_id, "left")
    return out.select(name_id, F.col("hit.candidate").alias(candidate), F.coalesce("hit.stage", F.lit("none")).alias("stage"))


def fuzzy(names: DataFrame, titles: DataFrame, name: str, title: str, threshold: float = 0.8, top: int = 5) -> DataFrame:
    """(name, title, similarity, place): titles at least so similar, the best first.

    Texts within edit distance d of another have one of d + 1 even pieces in
    common at nearly the same place, so pairs meet on (length, piece) and never
    all with all; the distance is computed for those alone.
    """
    a = names.select(F.col(name).alias("a")).distinct().where("a <> ''").withColumn("la", F.length("a"))
    b = titles.select(F.col(title).alias("b")).distinct().where("b <> ''").withColumn("lb", F.length("b"))
    # Errors allowed between the two lengths; pieces are cut from the titles.
    share = 1 - threshold
    b = b.withColumn("d", F.floor(F.lit(share) * F.ceil(F.col("lb") / F.lit(threshold)) + F.lit(1e-9)).cast("int"))
    piece = F.transform(F.sequence(F.lit(0), F.col("d")), lambda i: F.struct(i.alias("i"), F.floor(F.col("lb") * i / (F.col("d") + 1)).cast("int").alias("from"), F.floor(F.col("lb") * (i + 1) / (F.col("d") + 1)).cast("int").alias("to")))
    b = b.withColumn("p", F.explode(piece)).select("b", "lb", "d", F.substring("b", F.col("p.from") + 1, F.col("p.to") - F.col("p.from")).alias("gram"))
    # Every substring of a name with the length of some piece of a title of near length.
    lengths = b.select(F.length("gram").alias("n"), "lb").distinct()
    near = F.col("lb").between(F.ceil(F.col("la") * threshold - 1e-9), F.floor(F.col("la") / threshold + 1e-9))
    grams = a.select("a", "la").join(F.broadcast(lengths), near & (F.col("n") <= F.col("la")))  # one row a length of a title
    grams = grams.select("a", "lb", F.explode(F.transform(F.sequence(F.lit(1), F.col("la") - F.col("n") + 1), lambda i: F.substring("a", i, F.col("n")))).alias("gram")).distinct()
    pairs = grams.join(b, ["gram", "lb"]).select("a", "b").distinct().withColumn("similarity", F.round(similarity(F.col("a"), F.col("b")), 6)).where(F.col("similarity") >= threshold)
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))
    return pairs.withColumn("place", place.cast("long")).where(F.col("place") <= top).select(F.col("a").alias(name), F.col("b").alias(title), "similarity", "place")


def duplicate_ends(entries: DataFrame, key: Column, id_col: str) -> DataFrame:
    """(key, n, first, last) of keys that several entries have; ``ordering.blocked_lists`` has the ids."""
    return entries.where(key.isNotNull() & (key != "")).groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(id_col).alias("first"), F.max(id_col).alias("last")).where("n > 1")


def winners(entries: DataFrame, key: str, id_col: str, rank: list[Column]) -> DataFrame:
    """(key, winner): of each group the entry with the greatest rank."""
    return entries.groupBy(key).agg(F.max_by(id_col, F.struct(*rank)).alias("winner"))


def remap(ids: Column, mapping: Column) -> Column:
    """An array of ids with those that the map knows replaced."""
    return F.transform(ids, lambda i: F.coalesce(F.try_element_at(mapping, i), i))
