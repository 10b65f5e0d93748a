"""Search over postings: documents, terms, ranked answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.operators.matching import MOST_PHRASES
from textloom.tables import spread, stage

#: Texts of a task, and pairs of a query and a block: what is added up for them fits a task's memory.
TEXTS, PAIRS = 2048, 4096
#: Numbers of texts by term are sent to all tasks up to so many terms.
MOST_TERMS = 1_000_000


def _sent(df: DataFrame, most: int | None = None) -> DataFrame:
    """Rows that are sent to all tasks if they are few; else they are joined with, however small their files."""
    most = MOST_PHRASES if most is None else most
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df.hint("merge")


def book_docs(rows: DataFrame, path: str, title: Column, texts: Column, default: Column, book: str) -> DataFrame:
    """(book, path, title, text): what of a row is searched: its default text, tags stripped; generic titles are empty."""
    clean = F.trim(F.regexp_replace(F.coalesce(F.try_element_at(texts, default), F.lit("")), "<[^>]+>", ""))
    return rows.select(F.col(book).alias("book"), F.col(path).alias("path"), F.when(~title.rlike("^Chapter [0-9]+$"), title).otherwise("").alias("title"), clean.alias("text"))


def postings(docs: DataFrame, id_col: str, words: Column, rows: int | None = None, blocks: int | None = None) -> DataFrame:
    """(term, id, n, length): how often each document has each term, and its length; a row each, never a list.

    Texts are laid out by id, so that what is counted by document travels no
    more. Where there are about ``rows`` of them, a task's part doesn't grow
    with the table; with ``blocks``, they are laid out by so many blocks of
    documents instead, and the block is one more column.
    """
    key = "block" if blocks else id_col
    d = docs.withColumn("block", _block(id_col, blocks)) if blocks else docs
    d = (d.repartition(F.col(key)) if rows is None else spread(d, rows, key, each=TEXTS)).select(*{id_col: 0, key: 0}, words.alias("_w"))
    by = ["term", id_col, "length", *(["block"] if blocks else [])]
    return d.select(*d.columns[:-1], F.size("_w").cast("long").alias("length"), F.explode("_w").alias("term")).groupBy(*by).agg(F.count("*").alias("n"))


def _block(id_col: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(blocks))


def lengths(docs: DataFrame, id_col: str, words: Column) -> DataFrame:
    """(id, length) of the documents that have words, as their postings say it."""
    return docs.select(id_col, F.size(words).cast("long").alias("length")).where("length > 0").distinct()


def ranked(index: DataFrame, id_col: str, queries: DataFrame, query_id: str, terms: Column, top: int = 5, prefix: int = 0, k1: float = 1.2, b: float = 0.75, docs: DataFrame | None = None) -> DataFrame:
    """(query_id, id, score, place): the best documents of each query by BM25 (Robertson and Walker, 1994).

    A term of a query stands for itself or, with ``prefix``, for all terms that
    start with it, if it has so many characters. What is asked is sent to the
    postings, so they are scored where they are, postings of other terms aren't
    made, and only documents that share a term are scored. Numbers of texts are
    sent but for terms that only one text has, which are most. ``docs`` are the
    ``lengths``, if they are at hand; else they are taken from the index.
    """
    docs = index.select(id_col, "length").distinct() if docs is None else docs
    corpus = docs.agg(F.count("*").alias("_docs"), F.avg("length").alias("_mean"))  # one row
    asked = queries.select(query_id, F.explode(F.array_distinct(terms)).alias("asked"))
    if prefix:
        # A longer one adds nothing to its own beginning, so a term meets a query once.
        short = asked.where(F.length("asked") == prefix).select(query_id, F.col("asked").alias("_short"))
        asked = asked.join(short, (F.left("asked", F.lit(prefix)) == F.col("_short")) & (F.length("asked") > prefix) & (asked[query_id] == short[query_id]), "left_anti")
    asked = stage(asked.distinct(), "search_asked")
    held = _sent(asked.select("asked").distinct())
    starts = F.when(F.length("term") > prefix, F.array("term", F.left("term", F.lit(prefix)))).otherwise(F.array("term")) if prefix else F.array("term")
    keyed = index.select("*", F.explode(starts).alias("asked")) if prefix else index.withColumn("asked", F.col("term"))
    df = keyed.join(held, "asked", "left_semi").groupBy("term", "asked").agg(F.count("*").alias("df")).where("df > 1")
    df = stage(df.groupBy("term").agg(F.max("df").alias("df")), "search_terms")
    met = keyed.join(_sent(asked), "asked").join(_sent(df, MOST_TERMS), "term", "left").withColumn("df", F.coalesce("df", F.lit(1))).join(F.broadcast(corpus))
    idf = F.log(1 + (F.col("_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("n") * (k1 + 1) / (F.col("n") + k1 * (1 - b + b * F.col("length") / F.col("_mean")))
    scored = met.groupBy(query_id, id_col).agg(F.round(F.sum(weight), 6).alias("score"))
    place = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("score"), id_col))
    return scored.withColumn("place", place.cast("long")).where(F.col("place") <= top)


def block_postings(index: DataFrame, id_col: str, per_block: int = 256, k1: float = 1.2, b: float = 0.75, docs: DataFrame | None = None, asked: DataFrame | None = None) -> DataFrame:
    """(term, block, docs, most): the postings in blocks of documents, each with its documents' weights by BM25 and the largest of them.

    A document is in one block, the same for all its terms, and a block has
    about ``per_block`` documents; so a term that most documents have is many
    rows, and its documents are counted from the blocks. Postings that are laid
    out by block stay where they are. If only the terms ``asked`` will be, no
    others are made.
    """
    docs = index.select(id_col, "length").distinct() if docs is None else docs
    docs = docs.agg(F.count("*").alias("_docs"), F.avg("length").alias("_mean")).first()  # two numbers
    n_docs, mean = docs["_docs"], docs["_mean"] or 1.0
    if "block" not in index.columns:
        index = index.withColumn("block", _block(id_col, max(1, -(-n_docs // per_block))))
    if asked is not None:
        index = index.join(_sent(asked.select("term").distinct()), "term", "left_semi")
    part = lambda n, length: n * (k1 + 1) / (n + k1 * (1 - b + b * length / F.lit(mean)))
    each = F.collect_list(F.struct(F.col(id_col).alias("id"), "n", "length"))
    blocks = stage(index.groupBy("term", "block").agg(each.alias("docs"), F.count("*").alias("_n"), F.max(part(F.col("n"), F.col("length"))).alias("_part")), "search_blocks")
    df = stage(blocks.groupBy("term").agg(F.sum("_n").alias("df")), "search_terms")
    idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = F.transform("docs", lambda d: F.struct(d["id"].alias("id"), (F.col("_idf") * part(d["n"], d["length"])).alias("weight")))
    return blocks.join(_sent(df.select("term", idf.alias("_idf")), MOST_TERMS), "term").select("term", "block", weighed.alias("docs"), (F.col("_idf") * F.col("_part")).alias("most"))


#: Sums of weights differ in their last digits by the order in which they are added.
SLACK = 1e-5


def pruned_blocks(blocks: DataFrame, queries: DataFrame, query_id: str, terms: Column, id_col: str, top: int = 5, first: int = 4) -> tuple[DataFrame, DataFrame]:
    """((query_id, id, score, place), (query_id, block, bound, scored)): the best documents, and what blocks could have held any.

    A block's documents can't score more than its largest weights add up to.
    The ``first`` blocks by that bound are scored, which gives each query the
    score that a document must reach; blocks whose bound doesn't reach it are
    left out. The result is that of scoring all. A block is scored in one task,
    which gets its postings and the queries that need it, so neither pairs of
    queries, blocks and terms nor scores travel, but for each task's best.
    """
    asked = stage(queries.select(F.col(query_id).alias("_q"), F.explode(F.array_distinct(terms)).alias("term")), "search_asked")
    held, asked = _sent(asked.select("term").distinct()), _sent(asked)
    bounds = blocks.select("term", "block", "most").join(asked, "term").groupBy("_q", "block").agg(F.sum("most").alias("bound"))
    bounds = stage(bounds, "search_bounds")
    place = Window.partitionBy("_q").orderBy(F.desc("bound"), "block")
    ahead = bounds.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= first).select("_q", "block")
    best = Window.partitionBy("_q").orderBy(F.desc("score"), "_id")
    placed = lambda df: df.withColumn("place", F.row_number().over(best).cast("long")).where(F.col("place") <= top)

    def scored(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs, "search_pairs")
        needed = blocks.select("term", "block", "docs").join(held, "term", "left_semi").join(_sent(pairs.select("block").distinct()), "block", "left_semi")
        by_block = pairs.groupBy("block").agg(F.collect_list("_q").alias("_qs")).hint("shuffle_hash")
        met = spread(needed, pairs.count(), "block", each=PAIRS).join(by_block, "block").join(asked, "term").where(F.array_contains("_qs", F.col("_q")))
        each = met.select("_q", "block", F.explode("docs").alias("d")).groupBy("_q", "block", F.col("d.id").alias("_id")).agg(F.round(F.sum("d.weight"), 6).alias("score"))
        return stage(placed(each.drop("block")), "search_scored")

    one = scored(ahead)
    least = one.where(F.col("place") == top).select("_q", F.col("score").alias("_least"))
    rest = bounds.join(ahead.withColumn("_done", F.lit(True)), ["_q", "block"], "left").join(least, "_q", "left")
    rest = rest.withColumn("scored", F.col("_done").isNotNull() | F.col("_least").isNull() | (F.col("bound") + SLACK >= F.col("_least")))
    two = scored(rest.where("scored AND _done IS NULL").select("_q", "block"))
    found = placed(one.unionByName(two).drop("place"))
    return found.withColumnsRenamed({"_q": query_id, "_id": id_col}), rest.select(F.col("_q").alias(query_id), "block", "bound", "scored")


def write_search(docs: DataFrame, path: str) -> DataFrame:
    """Write what is searched, (book, path, title, text), as JSON lines: ``titles`` of all books, ``books`` by book, and ``meta`` with the number of texts and titles of each book; the numbers."""
    docs.where("title <> ''").select("book", "path", "title").write.mode("overwrite").json(f"{path}/titles")
    docs.write.mode("overwrite").partitionBy("book").json(f"{path}/books")
    meta = docs.groupBy("book").agg(F.count_if(F.col("text") != "").alias("n_texts"), F.count_if(F.col("title") != "").alias("n_titles"))
    meta.write.mode("overwrite").json(f"{path}/meta")
    return meta
