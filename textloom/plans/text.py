"""Text function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import arabic, paths, text
from textloom.operators import graph
from textloom.plans.registry import query
from textloom.tables import table


@query(r"""
SELECT doc_id, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS n_squeezed, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS squeezed, md5(text)[1:12] AS short_hash,
       len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::INTEGER AS n_words
FROM documents
""")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    squeezed = arabic.squeeze_blanks(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.length(squeezed).cast("long").alias("n_squeezed"), F.sha2(squeezed, 256).alias("squeezed"), text.short_md5(F.col("text")).alias("short_hash"), text.word_count(F.col("text")).alias("n_words"))


@query(r"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\[[0-9]+\]', '', 'g'))) AS stripped, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""")
def strip_html(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.sha2(text.strip_tags(F.col("html")), 256).alias("stripped"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query(r"""
SELECT lang, count_if(regexp_matches(text, '\p{Latin}'))::BIGINT AS latin, count_if(regexp_matches(text, '\p{Arabic}'))::BIGINT AS arabic, count_if(regexp_matches(text, '\p{Han}'))::BIGINT AS han,
       count_if(regexp_matches(text, '[äöüß]'))::BIGINT AS german, count_if(regexp_matches(text, '[éèêç]'))::BIGINT AS french
FROM documents GROUP BY lang
""")
def script_checks(spark: SparkSession, sf: str) -> DataFrame:
    has = lambda s: F.count_if(text.has_script(F.col("text"), s))
    return table(spark, sf, "documents").groupBy("lang").agg(has("Latin").alias("latin"), has("Arabic").alias("arabic"), has("Han").alias("han"), F.count_if(F.col("text").rlike("[äöüß]")).alias("german"), F.count_if(F.col("text").rlike("[éèêç]")).alias("french"))


@query("""
WITH a AS (SELECT p_brand, p_partkey, p_name AS t, lead(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS u FROM part),
w AS (SELECT *, string_split(t, ' ') AS wa, string_split(u, ' ') AS wb FROM a WHERE u IS NOT NULL)
SELECT p_partkey, CASE WHEN t = u THEN 1 ELSE 3 END AS tier,
       round(CASE WHEN t = u THEN 1.0 WHEN greatest(length(t), length(u)) > 2 * least(length(t), length(u)) THEN 0.0 ELSE 1 - levenshtein(t, u) / greatest(length(t), length(u)) END, 6)::DOUBLE AS confidence,
       CASE WHEN t = u THEN 0 ELSE (len(list_filter(wa, lambda x: NOT list_contains(wb, x))) > 0)::INTEGER + (len(list_filter(wb, lambda x: NOT list_contains(wa, x))) > 0)::INTEGER + (len(wa) <> len(wb))::INTEGER END AS n_differences
FROM w
""")
def tier_compare(spark: SparkSession, sf: str) -> DataFrame:
    pairs = graph.next_of(table(spark, sf, "part"), ["p_brand"], [F.col("p_partkey")], ["p_name"]).where("next_p_name is not null")
    made = pairs.select("p_partkey", text.compare(F.col("p_name"), F.col("next_p_name")).alias("c"))
    return made.select("p_partkey", "c.tier", F.round("c.confidence", 6).alias("confidence"), F.size("c.differences").alias("n_differences"))


@query(r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, replace(replace(url, '/', '_'), ':', '_') AS file, TRY_CAST(regexp_extract(url, '([0-9]+)', 1) AS INTEGER) AS first_number FROM pages
""")
def path_codecs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.translate("url", "/:", "__").alias("file"), text.first_integer(F.col("url")).alias("first_number"))


@query("""
SELECT '/books/' || r_regionkey || ':' || n_nationkey || ':' || c_custkey AS path, r_regionkey || ':' || n_nationkey || ':' || c_custkey AS index,
       '/books/' || r_regionkey || '/' || n_nationkey || '/' || c_custkey || '.json' AS file, r_regionkey || '_' || n_nationkey || '_' || c_custkey AS id,
       r_regionkey::VARCHAR AS slug, '/books/' || r_regionkey || ':' || n_nationkey AS parent
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def tree_paths(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = F.concat(F.lit("/books/"), F.concat_ws(":", *[F.col(c).cast("string") for c in ("r_regionkey", "n_nationkey", "c_custkey")]))
    p = F.col("path")
    return rows.select(path.alias("path")).select("path", paths.index_of(p).alias("index"), paths.file_of(p).alias("file"), paths.id_of(p).alias("id"), paths.slug_of(p).alias("slug"), paths.parent_of(p).alias("parent"))


@query("""
SELECT event_type, count_if(k IS NOT NULL)::BIGINT AS n_parsed, min(k) AS least, max(k) AS most, sum(k)::BIGINT AS total
FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type
""")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count_if(F.col("k").isNotNull()).alias("n_parsed"), F.min("k").alias("least"), F.max("k").alias("most"), F.sum("k").alias("total"))


@query(r"""
SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z'']+'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'of', 'que', 'der', 'die', 'und', 'las', 'los')))::INTEGER AS n_content,
       array_to_string((list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))[1:8], ' ') AS snippet
FROM documents
""")
def content_words(spark: SparkSession, sf: str) -> DataFrame:
    stop = ["the", "and", "of", "que", "der", "die", "und", "las", "los"]
    return table(spark, sf, "documents").select("doc_id", F.size(text.latin_tokens(F.col("text"), stop, 2)).alias("n_content"), text.snippet(F.col("text")).alias("snippet"))
