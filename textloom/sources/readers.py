"""Readers: explicit schemas, bad records kept apart, an ordinal wherever order matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VERSE = "struct<index: int, local_index: int, path: string, part_type: string, text: array<string>, translations: map<string, array<string>>>"
CHAPTER = f"struct<path: string, part_type: string, titles: map<string, string>, verses: array<{VERSE}>>"
BOOK = f"index string, kind string, data struct<path: string, titles: map<string, string>, chapters: array<{CHAPTER}>>"
RESPONSE = "verse_path string, ai_attribution struct<model: string, generated_date: string, pipeline_version: string>, result string"
EVENT = "session string, at timestamp, event string, verse_id string, status string, detail string"


def documents(spark: SparkSession, path: str, schema: str, keep: str = "*.json") -> DataFrame:
    """One JSON document a file, found recursively, with its ``file``; what isn't JSON has null columns and its text in ``_bad``."""
    reader = spark.read.schema(f"{schema}, _bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", keep).json(path).withColumn("file", F.input_file_name())


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Wrapped answers keyed by verse_path; the last file of a key wins, records without key or result are skipped. ``result`` is a variant."""
    read = documents(spark, path, RESPONSE).where("_bad is null and verse_path is not null and result is not null")
    last = F.row_number().over(Window.partitionBy("verse_path").orderBy(F.desc("file")))
    return read.withColumn("_n", last).where("_n = 1").select("verse_path", "ai_attribution", F.try_parse_json("result").alias("result"))


def verses(books: DataFrame) -> DataFrame:
    """Flat verse rows of nested books, in order: (book, chapter_path, chapter_pos, verse_pos, path, part_type, text, translations)."""
    c = books.select(F.col("data.path").alias("book"), F.posexplode("data.chapters").alias("chapter_pos", "c"))
    v = c.select("book", F.col("c.path").alias("chapter_path"), "chapter_pos", F.posexplode("c.verses").alias("verse_pos", "v"))
    return v.select("book", "chapter_path", "chapter_pos", "verse_pos", "v.path", "v.part_type", "v.text", "v.translations")


def numbered_lines(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """(n, line) of one text file without blank lines and comments, numbered from 1 in file order.

    A positional source is one file of bounded size (a translation of a book),
    so numbering it in one task is its own bound.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    kept = lines.where((F.trim("line") != "") & ~F.col("line").startswith(comment))
    return kept.select(F.row_number().over(Window.orderBy("at")).cast("long").alias("n"), "line")


def xml_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """One row for each element ``tag``; attributes are columns that start with an underscore."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def grouped_jsonl(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """(key, entries[]) of a splittable JSON-lines file; bad lines are dropped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*rows.columns)).alias("entries"))


def feature_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated rows of a location ``(a:b:c:d)``, a form, a tag and ``KEY:value|FLAG`` features, as columns and a map."""
    rows = spark.read.option("sep", "\t").option("comment", "#").schema("location string, form string, tag string, features string").csv(path)
    steps = F.split(F.translate("location", "()", ""), ":")
    bag = F.map_from_entries(F.array_distinct(F.transform(F.split("features", r"\|"), lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("k"), F.when(x.contains(":"), F.regexp_replace(x, "^[^:]*:", "")).otherwise("1").alias("v")))))
    return rows.where(F.size(steps) == 4).select(*[steps[i].try_cast("int").alias(c) for i, c in enumerate(("chapter", "verse", "word", "segment"))], "form", "tag", bag.alias("features"))


def html_elements(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, pos, kind, level, text): headings and paragraphs of each page, in order."""
    found = F.regexp_extract_all(html_col, F.lit(r"(?is)<(?:h[1-6]|p)\b[^>]*>.*?</(?:h[1-6]|p)>"), 0)
    e = pages.select(id_col, F.posexplode(found).alias("pos", "e"))
    level = F.regexp_extract("e", r"(?i)^<h([1-6])", 1).try_cast("int")
    text = F.trim(F.regexp_replace(F.regexp_replace("e", r"(?s)<[^>]+>", " "), r"(?U)\s+", " "))
    return e.select(id_col, "pos", F.when(level.isNotNull(), "heading").otherwise("paragraph").alias("kind"), level.alias("level"), text.alias("text"))


def sections(elements: DataFrame, id_col: str, start: str, continuation: str = " ") -> DataFrame:
    """(id, section, heading, text): elements grouped under each one that fulfils ``start`` (a SQL condition), paragraphs joined in order."""
    order = Window.partitionBy(id_col).orderBy("pos")
    numbered = elements.withColumn("section", F.sum(F.expr(f"cast({start} as int)")).over(order))
    parts = F.sort_array(F.collect_list(F.when(~F.expr(start), F.struct("pos", "text"))))
    out = numbered.groupBy(id_col, "section").agg(F.min_by(F.when(F.expr(start), F.col("text")), "pos").alias("heading"), F.array_join(F.transform(parts, lambda p: p["text"]), continuation).alias("text"))
    return out.where("section > 0")


def event_log(spark: SparkSession, path: str, session: str | None = None) -> DataFrame:
    rows = spark.read.schema(EVENT).option("mode", "DROPMALFORMED").json(path)
    return rows if session is None else rows.where(F.col("session") == session)


def html_files(spark: SparkSession, path: str, keep: str = "*.html") -> DataFrame:
    """(stem, html) of page files, found recursively; bytes that aren't UTF-8 become marks of that."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", keep).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
