"""Between flat rows and nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lang_counts(rows: DataFrame, key: str, lang: str, value: str, langs: list[str]) -> DataFrame:
    """(key, lang, n_there, n_holes, most) of each language among the rows of a key."""
    own = lambda x: F.when(F.col(lang) == x, F.col(value))
    one = lambda x: F.struct(F.lit(x).alias("lang"), F.count(own(x)).alias("n_there"), (F.count("*") - F.count(own(x))).alias("n_holes"), F.max(own(x)).alias("most"))
    held = rows.groupBy(key).agg(F.array(*map(one, langs)).alias("x"))
    return held.select(key, F.explode("x").alias("x")).select(key, "x.*")


def nest(rows: DataFrame) -> DataFrame:
    """(book, chapters[chapter, verses[]]) from (book, chapter, verse), everything in order."""
    chapters = rows.groupBy("book", "chapter").agg(F.sort_array(F.collect_list("verse")).alias("verses"))
    return chapters.groupBy("book").agg(F.sort_array(F.collect_list(F.struct("chapter", "verses"))).alias("chapters"))


def book_counts(rows: DataFrame) -> DataFrame:
    """(book, n_chapters, n_verses, first_verse) of the same books, without nesting them."""
    chapters = rows.groupBy("book", "chapter").agg(F.count("verse").alias("n"), F.min("verse").alias("first"))
    return chapters.groupBy("book").agg(F.count("*").alias("n_chapters"), F.sum("n").alias("n_verses"), F.min("first").alias("first_verse"))


def flatten(books: DataFrame) -> DataFrame:
    """The inverse of nest, with positions from 1."""
    c = books.select("book", F.posexplode("chapters").alias("_c", "chapter")).select("book", (F.col("_c") + 1).alias("chapter_index"), "chapter.chapter", F.posexplode("chapter.verses").alias("_v", "verse"))
    return c.select("book", "chapter", "verse", "chapter_index", (F.col("_v") + 1).alias("verse_index"))


def leaves(nodes: DataFrame, path: str, parent: str) -> DataFrame:
    """Nodes that are no node's parent."""
    return nodes.join(nodes.select(F.col(parent).alias(path)).where(F.col(path).isNotNull()).distinct(), path, "left_anti")


def optional_levels(rows: DataFrame, group: str, levels: list[str]) -> DataFrame:
    """(group, has_<level>): a level exists where it has more than one value."""
    return rows.groupBy(group).agg(*[(F.count_distinct(x) > 1).alias(f"has_{x}") for x in levels])


def shells(rows: DataFrame, chapter: str, order: str, kind: str, path: str) -> DataFrame:
    """(chapter, refs): an ordered array of what a chapter refers to; headings stand inline, without a path."""
    ref = F.struct(F.col(order).alias("local_index"), F.col(kind).alias("part_type"), F.when(F.col(kind) != "Heading", F.col(path)).alias("path"))
    return rows.groupBy(chapter).agg(F.sort_array(F.collect_list(ref)).alias("refs"))


def unpivot_map(rows: DataFrame, keys: list[str], m: str) -> DataFrame:
    """(keys, lang, value) of a map column."""
    return rows.select(*keys, F.explode(m).alias("lang", "value"))


def outer_titles(a: DataFrame, b: DataFrame, path: str) -> DataFrame:
    """Full outer merge of two title tables (path, title): one row a path with both titles."""
    return a.select(path, F.col("title").alias("title_a")).join(b.select(path, F.col("title").alias("title_b")), path, "full")
