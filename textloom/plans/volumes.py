"""Queries of volumes: outlines of pages by language, passages of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import editions, pages, volumes
from textloom.plans.markup import ARTICLE, _plain
from textloom.plans.registry import query
from textloom.tables import table

#: Places of a page's elements in their volume.
STEP = 1 << 20


@query(rf"""
WITH a AS (SELECT page_id, regexp_extract(html, '<html lang="(\w*)"', 1) AS volume, {ARTICLE} AS h FROM pages),
c AS (SELECT page_id, volume, regexp_extract_all(h, '<(?:h1|p)>(?:[^<]|</?b>|<br>)*') AS cs FROM a),
x AS (SELECT page_id, volume, unnest(cs) AS x, generate_subscripts(cs, 1) - 1 AS pos FROM c),
e AS (SELECT page_id, volume, page_id * {STEP} + pos AS place, trim({_plain("regexp_replace(x, '<[^>]*>', '', 'g')")}) AS text,
             CASE WHEN contains(x, '<h1>') THEN CASE WHEN regexp_matches(x, '^<h1>\s*[AEIOU]') THEN 1 ELSE 2 END WHEN contains(x, '<b>') THEN 3 END AS level FROM x),
h1 AS (SELECT *, max(CASE WHEN level = 1 THEN place END) OVER (PARTITION BY volume ORDER BY place) AS a1, max(CASE WHEN level <= 2 THEN place END) OVER (PARTITION BY volume ORDER BY place) AS a12,
              max(CASE WHEN level = 2 THEN place END) OVER (PARTITION BY volume ORDER BY place) AS a2, max(CASE WHEN level = 3 THEN place END) OVER (PARTITION BY volume ORDER BY place) AS a3 FROM e),
o AS (SELECT volume, page_id, place, text, level, a1, CASE WHEN a2 > coalesce(a1, -1) THEN a2 END AS a2, CASE WHEN a3 > coalesce(a12, -1) THEN a3 END AS a3 FROM h1),
n2 AS (SELECT volume, place, row_number() OVER (PARTITION BY volume, a1 ORDER BY place) AS n FROM o WHERE level = 2),
n3 AS (SELECT volume, place, row_number() OVER (PARTITION BY volume, greatest(coalesce(a1, -1), coalesce(a2, -1)) ORDER BY place) AS n FROM o WHERE level = 3)
SELECT o.volume, o.page_id, o.place - o.page_id * {STEP} AS pos, t1.text AS title_1, t2.text AS title_2, t3.text AS title_3, n2.n AS number_2, n3.n AS number_3, length(o.text) AS n_chars
FROM o LEFT JOIN o t1 ON t1.volume = o.volume AND t1.place = o.a1 LEFT JOIN o t2 ON t2.volume = o.volume AND t2.place = o.a2 LEFT JOIN o t3 ON t3.volume = o.volume AND t3.place = o.a3
LEFT JOIN n2 ON n2.volume = o.volume AND n2.place = o.a2 LEFT JOIN n3 ON n3.volume = o.volume AND n3.place = o.a3 WHERE o.level IS NULL
""")
def page_outline(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of all pages of a language under headings of three levels: titles that begin with a vowel, other titles, bold lines."""
    p = table(spark, sf, "pages").withColumn("volume", F.regexp_extract("html", '<html lang="([A-Za-z]*)"', 1))
    e = pages.segments(p, "html", "article", "page_id", "volume").withColumn("at", F.col("page_id") * STEP + F.col("pos"))
    level = F.when(F.col("name") == "h1", F.when(F.col("text").rlike("^[AEIOU]"), 1).otherwise(2)).when(F.map_contains_key("inner", "b"), 3)
    e = e.select("page_id", "volume", "at", "pos", "text", level.alias("level"))
    o = volumes.outlined(e, ["volume"], "at", "level", "text", 3, 64 * STEP).where("level IS NULL")
    return o.select("volume", "page_id", F.col("pos").cast("long").alias("pos"), "title_1", "title_2", "title_3", "number_2", "number_3", F.length("text").cast("long").alias("n_chars"))


@query(f"""
WITH e AS (SELECT conv_id // 100 AS volume, conv_id * {STEP} + turn AS place, role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT *, sum((role = 'user')::INT) OVER w AS passage, max(CASE WHEN role = 'system' THEN place END) OVER w AS h FROM e WINDOW w AS (PARTITION BY volume ORDER BY place))
SELECT s.volume, s.passage::BIGINT AS passage, max(t.text) AS title, string_agg(s.text, chr(10) ORDER BY s.place) FILTER (s.role = 'user') AS asked, string_agg(s.text, chr(10) ORDER BY s.place) FILTER (s.role = 'assistant') AS answered
FROM s LEFT JOIN e t ON t.volume = s.volume AND t.place = s.h WHERE s.role <> 'system' AND passage > 0 GROUP BY ALL
""")
def turn_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as volumes of a hundred: what a user says begins a passage, answers belong to it, and system turns are headings."""
    c = table(spark, sf, "conversations").select(F.floor(F.col("conv_id") / 100).alias("volume"), (F.col("conv_id") * STEP + F.col("turn")).alias("at"), "role", F.coalesce("text", F.lit("")).alias("text"))
    o = volumes.outlined(c.withColumn("level", F.when(F.col("role") == "system", 1)), ["volume"], "at", "level", "text", 1, 16 * STEP)
    p = volumes.passages(o, ["volume"], "at", F.col("role") == "user", width=16 * STEP).where("role <> 'system' AND passage > 0")
    said = lambda role: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("at", "text")))), lambda x: x["text"]), "\n")
    g = p.groupBy("volume", "passage").agg(F.max("title_1").alias("title"), said("user").alias("asked"), said("assistant").alias("answered"), F.count_if(F.col("role") == "assistant").alias("n"))
    return g.select("volume", "passage", "title", "asked", F.when(F.col("n") > 0, F.col("answered")).alias("answered"))


_BLANK = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''"


@query(f"""
WITH r AS (SELECT source, doc_id, md5(lower(text)) AS content_id, text FROM documents WHERE {_BLANK}),
f AS (SELECT source, content_id, min(doc_id) AS first FROM r GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY first, content_id) - 1 AS block FROM f)
SELECT source, doc_id, block, length(text) AS n_chars, doc_id = first AS is_first FROM r JOIN b USING (source, content_id)
""")
def edition_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Sources as parts of an edition whose equal texts are one block."""
    d = table(spark, sf, "documents").select("source", "doc_id", F.md5(F.lower("text")).alias("content_id"), "text")
    content = d.groupBy("content_id").agg(F.min("text").alias("text"))
    placed = editions.edition_places(d, content, "source", "doc_id", "content_id", "text")
    return placed.select("source", "doc_id", "block", F.length("text").cast("long").alias("n_chars"), F.col("first").alias("is_first"))
