"""From texts to chains whose names are linked: the chain is cut off, split, each name resolved against a registry, and put together again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import arabic, names
from textloom.operators.merging_groups import variant_keys
from textloom.tables import stage

# Keys that say too little to find anybody by.
GENERIC = ["الشيخ"]
STAGES = {"exact": 0, "normalized": 1, "canonical": 2}


def found_by_name(said: DataFrame, registry: DataFrame, generic: list[str] = GENERIC) -> DataFrame:
    """(name, book, entry, rank, context) of distinct ``said`` (name, book): the entries of the first key that finds any.

    ``registry`` has (id, name, variants, books, context, rank). A name is
    looked up as written, where the entry of the least rank alone counts,
    then normalised, then by its canonical key. An entry with ``books`` is for
    those only, unless the name's book is null.
    """
    keys = variant_keys(registry, "id", "name", "variants", generic).join(registry.select("id", "books", "context", "rank"), "id")
    exact = keys.where("kind = 'exact'")
    first = exact.groupBy("key").agg(F.min_by(F.struct("kind", "id", "books", "context", "rank"), F.struct("rank", "id")).alias("x")).select("key", "x.*")
    keys = keys.where("kind <> 'exact'").unionByName(first.select(*keys.columns))
    kind = lambda k, c: F.struct(F.lit(k).alias("kind"), c.alias("key"), F.lit(STAGES[k]).alias("stage"))
    asked = F.array(kind("exact", F.col("name")), kind("normalized", arabic.normalize(F.col("name"))), kind("canonical", names.canonical_key(F.col("name"))))
    hits = said.distinct().select("name", "book", F.explode(asked).alias("k")).select("name", "book", "k.*").join(keys, ["kind", "key"])
    hits = hits.where(F.col("books").isNull() | (F.size("books") == 0) | F.col("book").isNull() | F.array_contains("books", F.col("book")))
    hits = stage(hits.select("name", "book", "stage", F.col("id").alias("entry"), "rank", "context"), "chain_hits")
    best = hits.groupBy(F.col("name").alias("_name"), F.col("book").alias("_book")).agg(F.min("stage").alias("_stage"))
    met = hits.join(best, (F.col("name") == F.col("_name")) & F.col("book").eqNullSafe(F.col("_book")) & (F.col("stage") == F.col("_stage")))
    return met.select("name", "book", "entry", "rank", "context").distinct()


def resolved_names(chains: DataFrame, id_col: str, registry: DataFrame) -> DataFrame:
    """(id, pos, name, entry) of ``chains`` (id, book, names): of several entries the first by rank whose context names somebody before in the chain, else the first by rank; null for nobody."""
    each = chains.select(F.col(id_col).alias("_id"), "book", F.col("names").alias("_all"), F.posexplode("names").alias("pos", "name"))
    each = stage(each.select("_id", "book", "pos", "name", F.transform(F.slice("_all", 1, F.col("pos")), arabic.normalize).alias("before")), "chain_names")
    found = stage(found_by_name(each.select("name", "book"), registry), "chain_found")
    order = F.struct("rank", "entry")
    default = found.groupBy("name", "book").agg(F.min_by("entry", order).alias("first"), F.count("*").alias("n"))
    same = lambda a, b: (a["name"] == b["name"]) & a["book"].eqNullSafe(b["book"])
    told = found.where("context <> ''").withColumn("context", arabic.normalize(F.col("context"))).alias("f")
    e = each.alias("e")
    met = e.join(told, same(_of("e"), _of("f"))).where(F.exists("e.before", lambda p: (p != "") & F.contains(F.col("f.context"), p)))
    near = met.groupBy("e._id", "e.pos").agg(F.min_by("f.entry", F.struct("f.rank", "f.entry")).alias("near"))
    out = e.join(default.alias("d"), same(_of("e"), _of("d")), "left").select("e._id", "e.pos", "e.name", "d.first", "d.n").join(near, ["_id", "pos"], "left")
    return out.select(F.col("_id").alias(id_col), "pos", "name", F.when(F.col("n") > 1, F.coalesce("near", "first")).otherwise(F.col("first")).alias("entry"))


def _of(alias: str) -> dict[str, Column]:
    return {c: F.col(f"{alias}.{c}") for c in ("name", "book")}


def linked_chains(texts: DataFrame, id_col: str, text: Column, book: Column, registry: DataFrame, bare: bool = False, base: str = "/people/narrators/") -> DataFrame:
    """(id, chain, rest, parts, ids): each text's chain as parts (kind, text, path), what follows it, and the entries found, in order.

    Only names travel to the registry and back; a text without a chain has no
    parts, and its rest is all of it.
    """
    cut = texts.select(F.col(id_col).alias("_id"), book.alias("book"), names.chain_and_rest(text, bare).alias("x")).select("_id", "book", "x.*")
    cut = stage(cut.withColumn("names", F.coalesce(names.chain_names(F.col("chain"), bare), F.array().cast("array<string>"))), "chains")
    entries = resolved_names(cut, "_id", registry)
    told = entries.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("name").alias("text"), F.col("entry").alias("id")))).alias("told"))
    met = cut.join(told, "_id", "left")
    pairs = F.transform("told", lambda x: F.struct(x["text"].alias("text"), x["id"].alias("id")))
    met = met.withColumn("told", pairs)
    parts = names.chain_parts(F.col("chain"), F.col("told"), base)["parts"]
    ids = F.filter(F.transform(F.coalesce("told", F.array().cast(met.schema["told"].dataType)), lambda x: x["id"]), lambda x: x.isNotNull())
    return met.select(F.col("_id").alias(id_col), "chain", "rest", F.when(F.col("told").isNotNull(), parts).alias("parts"), ids.alias("ids"))
