"""Phrases in texts, names inside names, keyword votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Phrases, keys or keywords up to this number are sent to all tasks; more are joined with.
MOST_PHRASES = 200_000
#: So few phrases are looked for one by one in each text.
FEW_PHRASES = 64


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_PHRASES + 1).count() <= MOST_PHRASES else df


def contained(texts: DataFrame, id_col: str, text: Column, phrases: DataFrame, phrase_id: str, phrase: str, size: int = 4) -> DataFrame:
    """(id, phrase_id): which texts hold which phrases, anywhere, as ``contains`` says.

    A few phrases are each looked for in the text. Of more, an equi-join on the
    first ``size`` characters of a phrase, and only what meets there is
    searched; shorter phrases are joined whole.
    """
    named = phrases.select(F.col(phrase_id).alias("_pid"), F.col(phrase).alias("_phrase")).where(F.col("_phrase") != "")
    long, short = named.where(F.length("_phrase") >= size), named.where(F.length("_phrase") < size)
    said = texts.select(F.col(id_col).alias("_id"), text.alias("_text"))
    few = named.limit(FEW_PHRASES + 1).collect()
    if len(few) <= FEW_PHRASES:
        kind = named.schema
        held = F.array(*[F.when(F.col("_text").contains(p["_phrase"]), F.struct(F.lit(p["_pid"]).cast(kind["_pid"].dataType).alias("_pid"))) for p in few]) if few else F.array().cast("array<struct<_pid:string>>")
        held = F.filter(held, lambda x: x.isNotNull())
        return said.select("_id", F.explode(held).alias("x")).select(F.col("_id").alias(id_col), F.col("x._pid").alias(phrase_id)).distinct()
    # A look-ahead gives overlapping runs in one pass over the text. Only they travel; what meets a phrase meets its text again.
    grams = F.array_distinct(F.regexp_extract_all("_text", F.lit(f"(?s)(?=(.{{{size}}}))"), 1))
    met = said.select("_id", F.explode(grams).alias("_gram")).join(_sent(long.withColumn("_gram", F.left("_phrase", F.lit(size)))), "_gram").drop("_gram")
    found = said.join(met, "_id").where(F.col("_text").contains(F.col("_phrase"))).select("_id", "_pid")
    # What is shorter is one of the runs of its own length.
    runs = F.flatten(F.array(*[F.array_distinct(F.regexp_extract_all("_text", F.lit(f"(?s)(?=(.{{{k}}}))"), 1)) for k in range(1, size)]))
    if not short.isEmpty():
        found = found.unionByName(said.select("_id", F.explode(runs).alias("_phrase")).join(_sent(short), "_phrase").select("_id", "_pid"))
    return found.distinct().select(F.col("_id").alias(id_col), F.col("_pid").alias(phrase_id))


def inner_names(names: DataFrame, id_col: str, name: Column, least: int = 4) -> DataFrame:
    """(inner_id, outer_id): names that stand, as whole words, inside another name.

    All runs of words of a name meet the names that are such a run, so nothing
    is compared that doesn't share all its words.
    """
    keys = names.select(F.col(id_col).alias("_id"), F.trim(F.regexp_replace(name, r"\s+", " ")).alias("_key")).where(F.length("_key") >= least)
    words = keys.withColumn("_w", F.split("_key", " "))
    n = F.size("_w")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice("_w", i, k), " "))))
    inside = words.select(F.col("_id").alias("outer_id"), F.col("_key").alias("_outer"), F.explode(F.array_distinct(runs)).alias("_key"))
    met = inside.where(F.col("_key") != F.col("_outer")).join(keys.withColumnRenamed("_id", "inner_id"), "_key")
    return met.select("inner_id", "outer_id")


def voted(texts: DataFrame, id_col: str, text: Column, keywords: DataFrame, keyword: str, topic: str, top: int = 3) -> DataFrame:
    """(id, topic, votes, place): for each text the topics with the most keywords in it, the lesser name on ties."""
    words = keywords.select(F.col(keyword).alias("_k"), F.col(topic).alias("_t")).distinct()
    hits = contained(texts, id_col, text, words.select("_k").distinct(), "_k", "_k", size=3).join(_sent(words), "_k")
    votes = hits.groupBy(id_col, F.col("_t").alias(topic)).agg(F.count("*").alias("votes"))
    place = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("votes"), topic))
    return votes.withColumn("place", place.cast("long")).where(F.col("place") <= top)


def overlapping_titles(left: DataFrame, title: Column, right: DataFrame, other: Column) -> DataFrame:
    """The distinct titles of ``left`` that hold a title of ``right`` or stand in one."""
    a, b = left.select(title.alias("title")).where(F.col("title") != "").distinct(), right.select(other.alias("title")).where(F.col("title") != "").distinct()
    holds = contained(a, "title", F.col("title"), b.withColumnRenamed("title", "_o"), "_o", "_o").select("title")
    stands = contained(b.withColumnRenamed("title", "_o"), "_o", F.col("_o"), a, "title", "title").select("title")
    return holds.unionByName(stands).distinct()


def agreement(left: DataFrame, right: DataFrame, keys: list[str], id_col: str, name: str) -> DataFrame:
    """(keys, n_left, n_right, n_agree): rows of both sides place by place; they agree by id, or if one name holds the other."""
    *group, place = keys
    b = right.select(*keys, F.col(id_col).alias("_id"), F.col(name).alias("_name"))
    met = left.select(*keys, id_col, name).join(b, keys, "full")
    holds = F.col(name).contains(F.col("_name")) | F.col("_name").contains(F.col(name))
    same = (F.col(id_col) == F.col("_id")) | holds
    return met.groupBy(*group).agg(F.count(name).alias("n_left"), F.count("_name").alias("n_right"), F.count_if(F.coalesce(same, F.lit(False))).alias("n_agree"))
