"""Queries of whole lists: postings, groups, books and languages, in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import ordering
from textloom.plans.registry import query
from textloom.tables import table

SIZE = 100


def _joined(items: Column | str = "items") -> Column:
    return F.array_join(F.transform(items, lambda x: x.cast("string")), " ")


def _sql(rows: str, keys: str, item: str) -> str:
    return f"""
WITH r AS ({rows}), n AS (SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY {item}) - 1) // {SIZE} AS block FROM r)
SELECT {keys}, block, count(*) AS n, string_agg({item}::VARCHAR, ' ' ORDER BY {item}) AS items FROM n GROUP BY {keys}, block
"""


@query(_sql("SELECT DISTINCT event_type, user_id FROM events", "event_type", "user_id"))
def inverted_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole posting lists: all users of each type of event."""
    rows = table(spark, sf, "events").select("event_type", "user_id").distinct()
    return ordering.blocked_lists(rows, ["event_type"], ["user_id"], SIZE).withColumn("items", _joined())


@query(_sql("SELECT source, lang, doc_id FROM documents", "source, lang", "doc_id"))
def source_lang_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of each source, language by language."""
    return ordering.blocked_lists(table(spark, sf, "documents"), ["source", "lang"], ["doc_id"], SIZE).withColumn("items", _joined())


@query(_sql("SELECT r_name AS book, n_name AS chapter, c_custkey AS verse FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", "book, chapter", "verse"))
def book_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Books with the verses of their chapters."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("r_name").alias("book"), F.col("n_name").alias("chapter"), F.col("c_custkey").alias("verse"))
    return ordering.blocked_lists(rows, ["book", "chapter"], ["verse"], SIZE).withColumn("items", _joined())


@query(_sql("SELECT md5(lower(text)) AS same, doc_id FROM documents WHERE text IS NOT NULL QUALIFY count(*) OVER (PARTITION BY md5(lower(text))) > 1", "same", "doc_id"))
def duplicate_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """All members of each group of copies."""
    d = table(spark, sf, "documents").where("text IS NOT NULL").select(F.md5(F.lower("text")).alias("same"), "doc_id")
    twice = d.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same")
    return ordering.blocked_lists(d.join(twice, "same"), ["same"], ["doc_id"], SIZE).withColumn("items", _joined())
