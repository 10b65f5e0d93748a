"""Columns that hold several encodings of the same thing, read as VARIANT: no schema is fixed, and what doesn't fit is left out row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import edge_trimmed_tokens, tokens

# Classes of grades, and what tells them, in order of precedence.
GRADE_CLASSES = {"sahih": ["صحيح", "sahih"], "hasan": ["حسن", "hasan"], "da'if": ["ضعيف", "da'if", "daif"], "mu'tabar": ["معتبر", "mu'tabar", "muatabar", "mutabar"], "majhul": ["مجهول", "majhul"], "muwathaq": ["موثق", "muwathaq"]}
SURFACE_MARKS = "،؛؟!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’"


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, ... of a variant; null of null."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def items(v: Column, path: str) -> Column:
    """The elements of an array in a variant; none if something else is there."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def said(v: Column, path: str) -> Column:
    """The text at a path; null if it isn't one."""
    at = F.try_variant_get(v, path, "variant")
    return F.when(kind(at) == "STRING", at.cast("string"))


def shapes(rows: DataFrame, v: str, *by: str) -> DataFrame:
    """(by, shape, n, whole): how many rows of a group have which schema, and the group's merged one."""
    each = rows.select(*by, F.schema_of_variant(v).alias("shape")).groupBy(*by, "shape").agg(F.count("*").alias("n"))
    whole = rows.groupBy(*by).agg(F.schema_of_variant_agg(v).alias("whole"))
    met = each.withColumns({f"_{c}": F.col(c) for c in by}).join(whole.withColumnsRenamed({c: f"_w_{c}" for c in by}), [F.col(f"_{c}").eqNullSafe(F.col(f"_w_{c}")) for c in by])
    return met.select(*by, "shape", "n", "whole")


def grade_class(c: Column) -> Column:
    low = F.lower(c)
    told = [F.when(F.greatest(*[F.contains(low, F.lit(w)) for w in words]) if len(words) > 1 else F.contains(low, F.lit(words[0])), name) for name, words in GRADE_CLASSES.items()]
    return F.coalesce(*told, F.lit("other"))


def graded(rows: DataFrame, v: str, *keys: str) -> DataFrame:
    """(keys, scholar, grade) of grades that are an object {scholar: term} or an array of "scholar: <span>term</span> ..."; of a scholar named twice the later one."""
    each = rows.select(*keys, v).lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(v).outer()))
    line = F.when(F.col("key").isNull() & (kind(F.col("value")) == "STRING"), F.col("value").cast("string"))
    before, behind = F.rtrim(F.substring_index(line, "<span>", 1)), F.substr(line, F.instr(line, "<span>") + 6)
    term = F.trim(F.substring_index(behind, "</span>", 1))
    listed = line.contains("<span>") & behind.contains("</span>") & before.endswith(":") & (term != "")
    value = F.col("value").cast("string")
    scholar = F.when(F.col("key").isNotNull(), F.when(~F.coalesce(value, F.lit("")).isin("", "0", "false", "{}", "[]"), F.col("key"))).when(listed, F.trim(F.left(before, F.length(before) - 1)))
    found = each.select(*keys, "pos", scholar.alias("scholar"), grade_class(F.when(F.col("key").isNotNull(), value).otherwise(term)).alias("grade")).where("scholar <> ''")
    return found.groupBy(*keys, "scholar").agg(F.max_by("grade", "pos").alias("grade"))


def surfaces(v: Column) -> Column:
    """The words of a response, without marks at their edges: of its chunks if any has text, else of its word list."""
    texts = F.transform(items(v, "$.chunks"), lambda x: F.coalesce(said(x, "$.arabic_text"), F.lit("")))
    words = F.transform(items(v, "$.word_analysis"), lambda x: F.btrim(F.coalesce(said(x, "$.word"), F.lit("")), F.lit(SURFACE_MARKS)))
    chunked = F.flatten(F.transform(texts, lambda t: edge_trimmed_tokens(t, SURFACE_MARKS)))
    return F.when(F.exists(texts, lambda t: F.trim(t) != ""), chunked).otherwise(F.filter(F.transform(words, F.trim), lambda w: w != ""))


def tagged_words(v: Column) -> Column:
    """(word, pos) of a response: of its tags, else of its word list, else of its chunks, whose words have the tag N."""
    pair = lambda w, p: F.struct(w.alias("word"), p.alias("pos"))
    tags, listed, chunks = items(v, "$.word_tags"), items(v, "$.word_analysis"), items(v, "$.chunks")
    of_tags = F.transform(F.filter(tags, lambda x: F.try_variant_get(x, "$[1]", "string").isNotNull()), lambda x: pair(F.try_variant_get(x, "$[0]", "string"), F.try_variant_get(x, "$[1]", "string")))
    of_list = F.filter(F.transform(listed, lambda x: pair(said(x, "$.word"), said(x, "$.pos"))), lambda p: (F.coalesce(p["word"], F.lit("")) != "") & (F.coalesce(p["pos"], F.lit("")) != ""))
    of_chunks = F.flatten(F.transform(chunks, lambda x: F.transform(tokens(F.coalesce(said(x, "$.arabic_text"), F.lit(""))), lambda w: pair(w, F.lit("N")))))
    return F.when(F.size(tags) > 0, of_tags).when(F.size(listed) > 0, of_list).otherwise(of_chunks)


def response_fields(v: Column) -> Column:
    """A first-phase response with all its fields, of fixed types; what is missing or of another type is empty."""
    texts = lambda path: F.transform(items(v, path), lambda x: x.cast("string"))
    english = lambda name: F.coalesce(said(v, f"$.translations.en.{name}"), F.lit("")).alias(name)
    words = lambda x, path: F.coalesce(F.try_variant_get(x, path, "map<string,string>"), F.create_map().cast("map<string,string>"))
    chunks = F.transform(
        items(v, "$.chunks"), lambda x: F.struct(F.coalesce(said(x, "$.chunk_type"), F.lit("")).alias("chunk_type"), F.coalesce(said(x, "$.arabic_text"), F.lit("")).alias("arabic_text"), words(x, "$.translations").alias("translations"))
    )
    return F.struct(
        F.coalesce(F.try_variant_get(v, "$.has_chain", "boolean"), F.lit(False)).alias("has_chain"), texts("$.tags").alias("tags"), F.coalesce(said(v, "$.content_type"), F.lit("")).alias("content_type"), texts("$.topics").alias("topics"), chunks.alias("chunks"),
        F.struct(english("summary"), english("seo_question"), words(v, "$.translations.en.key_terms").alias("key_terms")).alias("en"), items(v, "$.related_quran").alias("related_quran"),
    )


def response_path(v: Column, file: Column) -> Column:
    """The path that a response names, else that of its file: book_1_2.json is /books/book:1:2."""
    stem = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[^.]*$", "")
    steps = F.split(stem, "_")
    made = F.concat(F.lit("/books/"), steps[0], F.when(F.size(steps) > 1, F.concat(F.lit(":"), F.array_join(F.slice(steps, 2, F.size(steps)), ":"))).otherwise(""))
    return F.coalesce(F.nullif(said(v, "$.verse_path"), F.lit("")), made)
