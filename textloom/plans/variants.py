"""Queries of columns with several encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import merging_groups as groups
from textloom.operators import variants
from textloom.plans.registry import query
from textloom.tables import table

TERMS = ["Sahih", "hasan li-ghayrihi", "Daif", "mu'tabar", "unclear", "majhul", "muwathaq"]
_TERM = f"[{', '.join(repr(t) if chr(39) not in t else chr(39) + t.replace(chr(39), chr(39) * 2) + chr(39) for t in TERMS)}][k % {len(TERMS)} + 1]"
_CLASS = "['sahih', 'hasan', 'da''if', 'mu''tabar', 'other', 'majhul', 'muwathaq'][k % 7 + 1]"


def mixed_grades(events: DataFrame) -> DataFrame:
    """(event_id, event_type, k, v): what an event says in five encodings, by its id."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = events.select("event_id", "event_type", "props", k.alias("k"))
    term = F.element_at(F.array(*map(F.lit, TERMS)), (F.col("k") % len(TERMS) + 1).cast("int"))
    told: Column = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"first": "'), term, F.lit('", "second": "", "third": null}')))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit('["none", "first: <span>other</span>", 5, "first:  <span> '), term, F.lit(' </span> - a note", "last <span>x</span>"]')))
        .when(F.col("event_id") % 5 == 2, F.col("props")).when(F.col("event_id") % 5 == 3, F.to_json(F.struct(term.alias("text")))).otherwise(F.lit('{"broken": '))
    )
    return e.select("event_id", "event_type", "k", F.try_parse_json(told).alias("v"))


@query(f"""
WITH e AS (SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events)
SELECT event_id, 'first' AS scholar, {_CLASS} AS grade FROM e WHERE event_id % 5 IN (0, 1)
UNION ALL SELECT event_id, 'k', 'other' FROM e WHERE event_id % 5 = 2 AND k <> 0
UNION ALL SELECT event_id, 'text', {_CLASS} FROM e WHERE event_id % 5 = 3
""")
def mixed_gradings(spark: SparkSession, sf: str) -> DataFrame:
    return variants.graded(mixed_grades(table(spark, sf, "events")), "v", "event_id")


@query("""
SELECT event_type, CASE event_id % 5 WHEN 0 THEN 'OBJECT<first: STRING, second: STRING, third: VOID>' WHEN 1 THEN 'ARRAY<VARIANT>' WHEN 2 THEN 'OBJECT<k: BIGINT>' WHEN 3 THEN 'OBJECT<text: STRING>' END AS shape, count(*) AS n FROM events GROUP BY ALL
""")
def event_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return variants.shapes(mixed_grades(table(spark, sf, "events")), "v", "event_type").drop("whole")


@query(r"""
WITH w AS (SELECT conv_id % 3 AS kind, role, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D\x1C-\x1F\x85\xA0]+')) AS word FROM conversations)
SELECT word, CASE WHEN kind = 2 THEN 'N' ELSE role END AS pos, count(*) AS n FROM w GROUP BY ALL
""")
def mixed_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of turns that are written as tags, as word lists or as chunks."""
    c = table(spark, sf, "conversations").select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"), F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D\x1C-\x1F\x{85}\x{A0}]+"), lambda w: w != "").alias("words"))
    tags = F.to_json(F.struct(F.transform("words", lambda w: F.array(w, F.col("role"))).alias("word_tags")))
    listed = F.to_json(F.struct(F.transform("words", lambda w: F.struct(w.alias("word"), F.col("role").alias("pos"))).alias("word_analysis")))
    chunks = F.to_json(F.struct(F.array(F.struct(F.col("text").alias("arabic_text")), F.struct(F.lit(None).cast("string").alias("arabic_text"))).alias("chunks"), F.array().cast("array<string>").alias("word_tags")))
    v = F.try_parse_json(F.when(F.col("conv_id") % 3 == 0, tags).when(F.col("conv_id") % 3 == 1, listed).otherwise(chunks))
    return c.select(v.alias("v")).select(F.explode(variants.tagged_words(F.col("v"))).alias("w")).groupBy("w.word", "w.pos").agg(F.count("*").alias("n"))


def _copies(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    text = F.lower(F.coalesce("text", F.lit("")))
    return d.select("doc_id", F.md5(text).alias("same"), "n_chars", "source", F.array("lang", "source", F.concat_ws("-", "lang", "source")).alias("names"), F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).otherwise(F.col("lang")).alias("role"))


_COPIES = """
WITH d AS (SELECT doc_id, md5(lower(coalesce(text, ''))) AS same, n_chars, source, lang, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END AS role FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY same ORDER BY n_chars DESC, doc_id) AS winner FROM d)
"""


@query(_COPIES + "SELECT doc_id, winner AS final FROM w WHERE doc_id <> winner")
def copies_redirected(spark: SparkSession, sf: str) -> DataFrame:
    """Copies are merged source by source, and those that stay once more: ids lead to the last one through both."""
    rank = [F.col("n_chars"), -F.col("doc_id")]
    d = _copies(spark, sf)
    near = groups.merged_into(d, F.concat_ws(" ", "same", "source"), "doc_id", rank)
    stay = d.join(near.where("doc_id = winner").select("doc_id"), "doc_id", "left_semi")
    far = groups.merged_into(stay, F.col("same"), "doc_id", rank)
    return groups.followed(near.unionByName(far), "doc_id", "winner")


@query(_COPIES + """, v AS (SELECT winner, doc_id, unnest([source, lang, source, lang || '-' || source]) AS variant, unnest([-1, 0, 1, 2]) AS pos FROM w),
f AS (SELECT *, row_number() OVER (PARTITION BY winner, variant ORDER BY doc_id <> winner, doc_id, pos) AS k FROM v WHERE NOT (pos = -1 AND doc_id = winner))
SELECT winner, variant, doc_id AS from_id, pos FROM f WHERE k = 1
""")  # fmt: skip
def copies_variants(spark: SparkSession, sf: str) -> DataFrame:
    d = _copies(spark, sf)
    return groups.merged_variants(d, groups.merged_into(d, F.col("same"), "doc_id", [F.col("n_chars"), -F.col("doc_id")]), "doc_id", "source", "names")


@query(_COPIES + """
SELECT winner, count(*) AS n_members, (min_by(role, (CASE WHEN doc_id = winner THEN -1 ELSE doc_id END)) FILTER (trim(role) <> '')) AS role, min_by(source, (CASE WHEN doc_id = winner THEN -1 ELSE doc_id END)) AS source FROM w GROUP BY winner
""")
def copies_merged(spark: SparkSession, sf: str) -> DataFrame:
    d = _copies(spark, sf)
    return groups.merged_fields(d, groups.merged_into(d, F.col("same"), "doc_id", [F.col("n_chars"), -F.col("doc_id")]), "doc_id", ["role", "source"])
