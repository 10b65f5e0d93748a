"""Queries of word forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import latin_tokens
from textloom.operators import surfaces
from textloom.plans.registry import query
from textloom.tables import table

POS = ["verb", "noun", "foreign", "adj", "prep"]


@query("""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z'']+'), lambda w: length(w) > 1)) AS surface FROM documents),
c AS (SELECT surface, count(*) AS n, count(DISTINCT doc_id) AS n_paths, array_to_string(list_sort(list_distinct(list(doc_id)))[1:5], ' ') AS paths FROM w GROUP BY surface),
a AS (SELECT *, ['verb', 'noun', 'foreign', 'adj', 'prep'][length(surface) % 5 + 1] AS pos, left(surface, 4) AS lemma, left(surface, 1) || '.#.' || right(surface, 1) AS root, length(surface) % 5 <> 2 AND surface NOT LIKE 'z%' AS known FROM c)
SELECT surface, n, n_paths, paths, CASE WHEN known THEN pos END AS pos, CASE WHEN known THEN '/words/lemmas/' || lemma END AS lemma_link, CASE WHEN known THEN '/words/roots/' || left(surface, 1) || '-_-' || right(surface, 1) END AS root_link,
       CASE WHEN known AND length(surface) > 5 THEN 'prc1=' || left(surface, 2) || '+' ELSE '' END AS clitics,
       CASE WHEN NOT known THEN '' WHEN pos = 'noun' THEN 'name of ' || lemma WHEN pos IN ('verb', 'adj') THEN 'first of ' || lemma ELSE '' END AS gloss
FROM a
""")
def surface_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Word forms with analyses made of their letters, and glosses of lemmas by part of speech."""
    d = table(spark, sf, "documents").repartition("doc_id")  # what is counted by document travels no more
    said = d.select("doc_id", F.explode(latin_tokens(F.col("text"))).alias("surface"))
    s = F.col("surface")
    pos = F.element_at(F.array(*map(F.lit, POS)), F.length(s) % 5 + 1)
    a = said.select("surface").distinct().where(~s.startswith("z")).select("surface", F.left(s, F.lit(4)).alias("lemma"), F.concat(F.left(s, F.lit(1)), F.lit(".#."), F.right(s, F.lit(1))).alias("root"), pos.alias("pos"), F.lit("0").alias("prc0"), F.when(F.length(s) > 5, F.concat(F.left(s, F.lit(2)), F.lit("+"))).otherwise("na").alias("prc1"))
    sense = lambda p, g: F.struct(F.lit(p).alias("pos"), F.concat(F.lit(g), F.col("lemma")).alias("gloss"))
    lemmas = a.select("lemma").distinct().select("lemma", F.create_map(F.lit("en"), F.col("lemma")).alias("translations"), F.array(sense("other", " first of "), sense("Name", "name of ")).alias("senses"))
    items = surfaces.surface_items(surfaces.surface_pages(said, "surface", "doc_id", a), "surface", lemmas)
    told = F.array_join(F.transform(F.map_entries(F.coalesce("morphology.clitics", F.create_map().cast("map<string,string>"))), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    return items.select("surface", "n", "n_paths", F.array_join(F.transform("paths", lambda x: x.cast("string")), " ").alias("paths"), F.col("morphology.pos_camel").alias("pos"), "lemma_link", "root_link", told.alias("clitics"), F.col("en_gloss").alias("gloss"))
