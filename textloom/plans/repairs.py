"""Queries of corrections, phrase dictionaries and broken JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import json_repair
from textloom.operators import answers, dictionaries
from textloom.plans.registry import query
from textloom.tables import table


@query("""
WITH RECURSIVE c AS (SELECT item_id * 2 + k AS pos, before, after FROM (
    SELECT item_id, 0 AS k, string_split(text, ' ')[1] || ' ' AS before, '[' || item_id || '] ' AS after FROM benchmark UNION ALL SELECT item_id, 1, '] ' || string_split(text, ' ')[2], '' FROM benchmark) WHERE before IS NOT NULL),
l AS (SELECT list({'before': before, 'after': after} ORDER BY pos) AS steps FROM c),
d AS (SELECT doc_id, text, 0 AS done FROM documents WHERE text IS NOT NULL
      UNION ALL SELECT doc_id, replace(text, steps[done + 1].before, steps[done + 1].after), done + 1 FROM d, l WHERE done < len(steps))
SELECT doc_id, md5(text) AS corrected FROM d, l WHERE done = len(steps) UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL
""")
def corrected_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections that build on each other, two of every passage, in all documents."""
    b = table(spark, sf, "benchmark")
    words = F.split("text", " ")
    first = b.select((F.col("item_id") * 2).alias("pos"), F.concat(words[0], F.lit(" ")).alias("before"), F.concat(F.lit("["), F.col("item_id").cast("string"), F.lit("] ")).alias("after"))
    second = b.select((F.col("item_id") * 2 + 1).alias("pos"), F.concat(F.lit("] "), F.get(words, F.lit(1))).alias("before"), F.lit("").alias("after"))
    done = dictionaries.corrected(table(spark, sf, "documents").select("doc_id", "text"), "text", first.unionByName(second))
    return done.select("doc_id", F.md5("text").alias("corrected"))


@query("""
SELECT page_id, md5(CASE regexp_extract(html, '<html lang="(\\w*)"', 1) WHEN 'en' THEN replace(replace(html, '<p>', '<p dir="ltr">'), 'dir="ltr"><b', 'class="b"><b') WHEN 'de' THEN replace(html, '<b>', '') ELSE html END) AS corrected FROM pages
""")
def corrected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections by the language of a page."""
    rows = [("en", 1, "<p>", '<p dir="ltr">'), ("en", 2, 'dir="ltr"><b', 'class="b"><b'), ("de", 1, "<b>", None), ("xx", 1, "a", "b")]
    steps = spark.createDataFrame(rows, "key string, pos int, before string, after string")
    p = table(spark, sf, "pages").select("page_id", "html")
    done = dictionaries.corrected_by_key(p, F.regexp_extract("html", '<html lang="([A-Za-z0-9_]*)"', 1), "html", steps)
    return done.select("page_id", F.md5("html").alias("corrected"))


@query("""
WITH p AS (SELECT DISTINCT unnest(string_split(text, '. ')) AS phrase, item_id FROM benchmark), f AS (SELECT phrase, min(item_id) AS item_id FROM p WHERE phrase <> '' GROUP BY phrase)
SELECT doc_id, phrase, item_id FROM documents JOIN f ON contains(text, phrase)
""")
def sentences_in_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every sentence of every passage, wherever a document holds it."""
    p = table(spark, sf, "benchmark").select(F.explode(F.split("text", r"\. ")).alias("phrase"), "item_id").where("phrase <> ''").groupBy("phrase").agg(F.min("item_id").alias("item_id"))
    found = dictionaries.phrases_found(table(spark, sf, "documents"), "doc_id", F.col("text"), p, "phrase", "phrase").distinct()
    return found.join(p, "phrase").select("doc_id", "phrase", "item_id")


@query(r"""
WITH w AS (SELECT conv_id, turn, role, string_split(text, ' ') AS w FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, role, md5(array_to_string([CASE WHEN i % 4 = 0 THEN '"' || x || '"' ELSE x END FOR x, i IN w], ' ')) AS said FROM w
""")
def mended_json(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with words in quotes, written as JSON, left unescaped, mended and read again."""
    c = table(spark, sf, "conversations").where("text IS NOT NULL")
    quoted = F.array_join(F.transform(F.split("text", " "), lambda x, i: F.when((i + 1) % 4 == 0, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x)), " ")
    whole = F.to_json(F.struct("role", F.array(quoted, F.lit("end")).alias("said"), F.struct("conv_id", quoted.alias("again")).alias("more")))
    broken = c.select("conv_id", "turn", F.replace(whole, F.lit('\\"'), F.lit('"')).alias("broken"))
    read = broken.select("conv_id", "turn", F.try_parse_json(json_repair.json_mended(F.col("broken"))).alias("v"))
    said, again = (F.try_variant_get("v", p, "string") for p in ("$.said[0]", "$.more.again"))
    return read.select("conv_id", "turn", F.try_variant_get("v", "$.role", "string").alias("role"), F.when(said == again, F.md5(said)).alias("said"))


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as answers with faults that follow from their ids and turns."""
    t = F.col("turn")
    words = F.split(F.coalesce("text", F.lit("")), " ")
    range_ = F.struct(t.cast("int").alias("word_start"), (t + F.when(t % 2 == 0, 0).otherwise(2)).cast("int").alias("word_end"))
    person = F.struct(F.when(t % 5 != 4, F.concat(F.lit("p"), t.cast("string"))).alias("name_en"), F.when(t % 3 == 0, "likely").otherwise("definite").alias("identity_confidence"), F.when(F.col("role") == "user", "known").alias("ambiguity_note"), F.array(range_).alias("word_ranges"))
    part = lambda end: F.struct(F.lit(0).alias("word_start"), end.cast("int").alias("word_end"))
    topics = F.when(t % 4 == 1, F.array(F.lit("none"))).when(t % 4 == 2, F.array(F.lit("faith"), F.col("role"))).when(t % 4 == 3, F.array(F.lit("faith")))
    return table(spark, sf, "conversations").select("conv_id", "turn", words.alias("words"), F.array(F.coalesce("text", F.lit(""))).alias("texts"), F.array(person).alias("narrators"), F.array(part(F.lit(1)), part(F.size(words) - F.when(t % 2 == 0, 1).otherwise(0))).alias("chunks"), topics.alias("topics"))


@query("""
WITH a AS (SELECT conv_id, turn, role, len(string_split(coalesce(text, ''), ' ')) AS n FROM conversations)
SELECT conv_id, turn, array_to_string(list_filter([
    CASE WHEN turn % 3 = 0 AND role <> 'user' THEN 'auto-filled ambiguity_note for ' || CASE WHEN turn % 5 = 4 THEN '?' ELSE 'p' || turn END END, CASE WHEN turn % 2 = 0 THEN 'corrected last chunk word_end from ' || (n - 1) || ' to ' || n END,
    CASE WHEN turn % 2 = 0 THEN 'corrected narrator ' || CASE WHEN turn % 5 = 4 THEN '?' ELSE 'p' || turn END || ' word_end from ' || turn || ' to ' || (turn + 1) END,
    CASE turn % 4 WHEN 1 THEN 'removed all invalid topics: none' WHEN 2 THEN 'removed invalid topics: ' || role END], lambda x: x IS NOT NULL), '; ') AS fixes,
  n::INTEGER AS last_end, (CASE WHEN turn % 2 = 0 THEN turn + 1 ELSE turn + 2 END)::INTEGER AS narrator_end, CASE WHEN turn % 4 >= 2 THEN 'faith' END AS topics
FROM a
""")
def mended_answers(spark: SparkSession, sf: str) -> DataFrame:
    m = answers.mended(_answers(spark, sf), F.size("words"), "narrators", "chunks", "topics", ["faith", "hope"])
    return m.select("conv_id", "turn", F.array_join("fixes", "; ").alias("fixes"), F.get("chunks", F.lit(1))["word_end"].alias("last_end"), F.get(F.get("narrators", F.lit(0))["word_ranges"], F.lit(0))["word_end"].alias("narrator_end"), F.array_join("topics", " ").alias("topics"))


@query("""
WITH w AS (SELECT conv_id, turn, string_split(coalesce(text, ''), ' ') AS w, coalesce(text, '') AS t FROM conversations),
f AS (SELECT conv_id, turn, w, replace(replace(t, 'the', 'thé'), 'Of', 'Óf') AS t, [CASE x WHEN 'the' THEN 'thé' WHEN 'the,' THEN 'thé,' WHEN 'the.' THEN 'thé.' WHEN 'Of' THEN 'Óf' WHEN 'Of,' THEN 'Óf,' WHEN 'Of.' THEN 'Óf.' ELSE x END FOR x IN w] AS v FROM w)
SELECT conv_id, turn, md5(array_to_string(v, ' ')) AS text, md5(t) AS chunk, len(list_filter(range(1, len(w) + 1), lambda i: w[i] <> v[i]))::INTEGER AS n_fixed FROM f
""")
def marked_answers(spark: SparkSession, sf: str) -> DataFrame:
    m = answers.marked(_answers(spark, sf), "words", "texts", {"the": "thé", "Of": "Óf", "and": "and"})
    return m.select("conv_id", "turn", F.md5("text").alias("text"), F.md5(F.get("texts", F.lit(0))).alias("chunk"), "n_fixed")
