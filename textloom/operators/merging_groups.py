"""Entries that are the same are merged into one of them, and their ids redirected; groups of any size, as nothing is gathered in a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import arabic, names
from textloom.tables import stage


def followed(links: DataFrame, old: str, new: str) -> DataFrame:
    """(old, final): where a chain of redirects ends; null for ids that run into a circle.

    Every round doubles the steps that are taken, so a chain of n redirects
    takes about log2(n) rounds. Of several redirects of an id the least holds.
    As long as a chain hasn't ended, each round ends some, so when none ends,
    the rest are circles.
    """
    at = links.where(F.col(old).isNotNull() & F.col(new).isNotNull() & (F.col(old) != F.col(new))).groupBy(F.col(old).alias("_from")).agg(F.min(new).alias("_to"))
    at = stage(at.withColumn("_moved", F.lit(True)), "redirects")
    left = None
    while True:
        ahead = at.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
        at = stage(at.join(ahead, "_to", "left").select("_from", F.coalesce("_next", "_to").alias("_to"), F.col("_next").isNotNull().alias("_moved")), "redirects")
        moving = at.where("_moved").count()
        if moving in (0, left):
            return at.select(F.col("_from").alias(old), F.when(~F.col("_moved"), F.col("_to")).alias("final"))
        left = moving


def merged_into(entries: DataFrame, group: Column, id_col: str, rank: list[Column]) -> DataFrame:
    """(id, winner) of every entry: the entry of its group with the greatest rank, the least id on ties; an entry without a group is its own."""
    named = entries.withColumn("_group", group)
    best = named.where(F.col("_group").isNotNull()).withColumn("_rank", F.struct(*rank)).groupBy("_group").agg(F.max("_rank").alias("_best"))
    # The least id of the best, by a join on values that many entries may share, each of which meets one row.
    top = named.where(F.col("_group").isNotNull()).withColumn("_rank", F.struct(*rank)).join(best, "_group").where(F.col("_rank").eqNullSafe(F.col("_best"))).groupBy("_group").agg(F.min(id_col).alias("winner"))
    return named.select(id_col, "_group").join(top, "_group", "left").select(id_col, F.coalesce("winner", id_col).alias("winner"))


def _ordered(entries: DataFrame, members: DataFrame, id_col: str) -> DataFrame:
    """With ``winner`` and ``_order``: the winner's own entry first, then the others by id."""
    met = entries.join(members, id_col)
    return met.withColumn("_order", F.struct((F.col(id_col) != F.col("winner")).alias("other"), F.col(id_col).alias("id")))


def merged_fields(entries: DataFrame, members: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(winner, n_members, fields): the winner's fields, empty ones filled from the first other that has them."""
    met = _ordered(entries, members, id_col)
    empty = lambda c: F.col(c).isNull() if entries.schema[c].dataType.typeName() != "string" else F.trim(F.coalesce(c, F.lit(""))) == ""
    first = [F.min_by(F.col(c), F.when(~empty(c), F.col("_order"))).alias(c) for c in fields]
    return met.groupBy("winner").agg(F.count("*").alias("n_members"), *first)


def merged_variants(entries: DataFrame, members: DataFrame, id_col: str, name: str, variants: str) -> DataFrame:
    """(winner, variant, from_id, pos): the names and variants of all members, each once, by its first place; to be read in the order of (from_id = winner first, from_id, pos).

    The winner's own name is no variant of itself; the others' names come
    before their variants, at position -1.
    """
    met = _ordered(entries, members, id_col)
    own = F.when(F.col(id_col) != F.col("winner"), F.array(F.struct(F.lit(-1).alias("pos"), F.trim(name).alias("variant")))).otherwise(F.array().cast("array<struct<pos:int,variant:string>>"))
    listed = F.transform(F.coalesce(F.col(variants), F.array().cast("array<string>")), lambda x, i: F.struct(i.alias("pos"), x.alias("variant")))
    rows = met.select("winner", "_order", F.explode(F.concat(own, listed)).alias("v")).where("v.variant <> ''")
    first = rows.groupBy("winner", "v.variant").agg(F.min(F.struct("_order", "v.pos")).alias("f"))
    return first.select("winner", "variant", F.col("f._order.id").alias("from_id"), "f.pos")


def all_redirects(entries: DataFrame, members: DataFrame, id_col: str, old_ids: str) -> DataFrame:
    """(id, final): every id that isn't a winner's, and those that entries had before, with where they lead in the end."""
    merged = members.where(F.col(id_col) != F.col("winner")).select(F.col(id_col).alias("id"), F.col("winner").alias("to"))
    before = entries.select(F.explode(F.coalesce(F.col(old_ids), F.array().cast(entries.schema[old_ids].dataType))).alias("id"), F.col(id_col).alias("to"))
    return followed(merged.unionByName(before), "id", "to")


def variant_keys(entries: DataFrame, id_col: str, name: str, variants: str, generic: list[str] = ()) -> DataFrame:
    """(kind, key, id) by which an entry is found: its names as written, normalised, and by their canonical key, but for keys that say too little."""
    named = entries.select(F.col(id_col).alias("id"), F.explode(F.concat(F.array(name), F.coalesce(F.col(variants), F.array().cast("array<string>")))).alias("n")).where("n <> ''")
    kind = lambda k, c: F.struct(F.lit(k).alias("kind"), c.alias("key"))
    three = F.array(kind("exact", F.col("n")), kind("normalized", arabic.normalize(F.col("n"))), kind("canonical", names.canonical_key(F.col("n"))))
    rows = named.select("id", F.explode(three).alias("k")).select("k.kind", "k.key", "id").distinct()
    return rows.where((F.col("key") != "") & ~((F.col("kind") == "canonical") & F.col("key").isin(*generic)) if generic else F.col("key") != "")
