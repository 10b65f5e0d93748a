"""Queries of names and chains: words of documents, spelt in Arabic letters, as names and as chains of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import names
from textloom.operators import linked_chains as chains
from textloom.plans.registry import query
from textloom.tables import table

#: Letters for b to z, none of those that verbs and prepositions of chains need.
LATIN, ARABIC = "bcdefghijklmnopqrstuvwxyz", "بتجحخدذرزسشصضطظغفقكلمهيبت"
_WORDS = f"[translate(w, '{LATIN}', '{ARABIC}') FOR w IN regexp_extract_all(translate(coalesce(text, ''), 'BCDEFGHIJKLMNOPQRSTUVWXYZ', '{LATIN}'), '[b-z]{{3,}}')]"


def _names(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, w): the words of a document of three letters and more, without vowels, spelt anew."""
    low = F.translate(F.coalesce("text", F.lit("")), LATIN.upper(), LATIN)
    return table(spark, sf, "documents").select("doc_id", F.transform(F.regexp_extract_all(low, F.lit("([b-z]{3,})"), 1), lambda w: F.translate(w, LATIN, ARABIC)).alias("w"))


def _picked(xs: list[str], n: int = 1) -> Column:
    return F.element_at(F.array(*map(F.lit, xs)), (F.floor(F.col("doc_id") / n) % len(xs) + 1).cast("int"))


@query(f"""
WITH d AS (SELECT doc_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM documents)
SELECT doc_id, i::INTEGER AS i, 'ا' || w || ' بن ' || w AS key FROM d
""")
def name_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Each word of each document as a name: with vowel marks, letters in variants, a verb before it and a formula behind it."""
    d = _names(spark, sf).select("doc_id", F.posexplode("w").alias("i", "w"))
    marked = F.replace(F.replace("w", F.lit("ب"), F.lit("بَ")), F.lit("م"), F.lit("مّ"))
    name = F.concat(_picked(["", "حَدَّثَنَا ", "روى ", "وَسَمِعْتُ "]), _picked(["أ", "إ", "آ", "ا"], 4), marked, F.lit("  بْنُ "), marked, _picked(["", " عليه السلام", " (ره)", " :", " ( صلى الله عليه وآله )", " رضي الله عنه قال"], 2))
    return d.select("doc_id", (F.col("i") + 1).alias("i"), names.canonical_key(name).alias("key"))

def _told(d: DataFrame) -> Column:
    """The first four words as a chain, the others as what is told."""
    chain = F.concat(_picked(["", "حَدَّثَنَا ", "وَ أَخْبَرَنَا "]), F.when(F.col("doc_id") % 2 == 1, F.array_join(F.slice("w", 1, 4), " عَنْ ")).otherwise(F.array_join(F.slice("w", 1, 4), " عَنِ ")), _picked([" قَالَ", " أَنَّهُ"], 3))
    return F.concat(chain, F.lit(" "), F.array_join(F.slice("w", 5, F.size("w")), " "))


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), c AS (
  SELECT doc_id, w, CASE doc_id % 3 WHEN 1 THEN 'حَدَّثَنَا ' WHEN 2 THEN 'وَ أَخْبَرَنَا ' ELSE '' END || CASE doc_id % 2 WHEN 1 THEN array_to_string(w[1:4], ' عَنْ ') ELSE array_to_string(w[1:4], ' عَنِ ') END || CASE (doc_id // 3) % 2 WHEN 0 THEN ' قَالَ' ELSE ' أَنَّهُ' END AS chain FROM d WHERE len(w) >= 4)
SELECT doc_id, chain, ' ' || array_to_string(w[5:], ' ') AS rest, array_to_string(w[1:4], ' / ') AS names FROM c
""")
def chain_names(spark: SparkSession, sf: str) -> DataFrame:
    """The first four words of each document as a chain of names, the others as what is told."""
    d = _names(spark, sf).where(F.size("w") >= 4)
    cut = d.select("doc_id", names.chain_and_rest(_told(d)).alias("x")).select("doc_id", "x.*")
    return cut.select("doc_id", "chain", "rest", F.array_join(names.chain_names(F.col("chain")), " / ").alias("names"))


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), c AS (
  SELECT doc_id, w[1:4] AS w, CASE doc_id % 3 WHEN 1 THEN 'حَدَّثَنَا ' WHEN 2 THEN 'وَ أَخْبَرَنَا ' ELSE '' END || CASE doc_id % 2 WHEN 1 THEN array_to_string(w[1:4], ' عَنْ ') ELSE array_to_string(w[1:4], ' عَنِ ') END || CASE (doc_id // 3) % 2 WHEN 0 THEN ' قَالَ' ELSE ' أَنَّهُ' END AS chain FROM d WHERE len(w) >= 4),
n AS (SELECT doc_id, unnest(w) AS name, generate_subscripts(w, 1) - 1 AS pos FROM c), r AS (SELECT name, min(doc_id * 10 + pos) AS id FROM n WHERE length(name) % 2 = 0 GROUP BY name),
l AS (SELECT doc_id, string_agg(n.name || '>/people/narrators/' || id, ' ' ORDER BY pos) AS linked, string_agg(id::VARCHAR, ' ' ORDER BY pos) AS ids FROM n JOIN r ON r.name = n.name GROUP BY doc_id)
SELECT doc_id, chain, coalesce(linked, '') AS linked, coalesce(ids, '') AS ids FROM c LEFT JOIN l USING (doc_id)
""")
def linked_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Chains whose names are found in a registry as written or, with vowel marks there, normalised; names of an odd length aren't in it."""
    d = _names(spark, sf).where(F.size("w") >= 4)
    n = d.select("doc_id", F.posexplode(F.slice("w", 1, 4)).alias("pos", "n")).where(F.length("n") % 2 == 0).groupBy("n").agg(F.min(F.col("doc_id") * 10 + F.col("pos")).alias("id"))
    marked = F.replace(F.replace("n", F.lit("ب"), F.lit("بَ")), F.lit("م"), F.lit("مُ"))
    none = F.lit(None).cast("array<string>")
    registry = n.select("id", F.when(F.length("n") % 4 == 0, marked).otherwise(F.lit("")).alias("name"), F.when(F.length("n") % 4 == 2, F.array("n")).alias("variants"), none.alias("books"), F.lit(None).cast("string").alias("context"), F.col("id").alias("rank"))
    made = chains.linked_chains(d.select("doc_id", _told(d).alias("t")), "doc_id", F.col("t"), F.lit(None).cast("string"), registry)
    linked = F.filter("parts", lambda p: p["path"].isNotNull())
    return made.select("doc_id", names.chain_text(F.col("parts")).alias("chain"), F.array_join(F.transform(linked, lambda p: F.concat_ws(">", p["text"], p["path"])), " ").alias("linked"), F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))
