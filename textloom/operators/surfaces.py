"""Pages of word forms: how often and where they stand, what an analyser says of them, and what their lemmas mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.lexicon import POS, root_slug

# Fields of clitics, what an analyser says of words that it doesn't know, and parts of speech of a lexicon that a part of speech agrees with.
CLITICS = ["prc0", "prc1", "prc2", "prc3", "enc0"]
NO_CLITIC, FOREIGN = ["", "0", "na"], "foreign"
PARTICLE = ["particle", "part"]
NOUN, ADJECTIVE = ["noun", "name", "proper noun"], ["adj", "adjective"]
AGREES = {
    "verb": ["verb"], "noun": NOUN, "noun_prop": NOUN, "noun_quant": ["noun", "num"], "noun_num": ["noun", "num"], "adj": ADJECTIVE, "adj.act": [*ADJECTIVE, "verb"], "adj.pass": [*ADJECTIVE, "verb"], "adv": ["adv", "adverb"], "prep": ["prep", "preposition"], "conj": ["conj", "conjunction"],
    "pron": ["pron", "pronoun"], "det": ["det", "determiner", "article"], "intj": ["intj", "interjection"], **dict.fromkeys(["part", "particle", "fut_part", "neg_part", "interrog_part", "focus_part", "prog_part", "voc_part"], PARTICLE),
}
CONTENT = ["verb", "noun", "noun_prop", "noun_quant", "noun_num", "adj", "adj.act", "adj.pass", "adv"]
#: Paths that a surface's item shows.
SHOWN = 5


def is_known(pos: Column, root: Column) -> Column:
    """Whether an analysis says anything."""
    said = (F.coalesce(pos, F.lit("")) != "") | (F.coalesce(root, F.lit("")) != "")
    return said & ~F.coalesce(pos == FOREIGN, F.lit(False)) & ~F.coalesce(root == FOREIGN.upper(), F.lit(False))


def clitics(analysis: dict[str, Column]) -> Column:
    """The clitics that there are, by field."""
    each = [F.struct(F.lit(k).alias("key"), analysis[k].alias("value")) for k in CLITICS if k in analysis]
    return F.map_from_entries(F.filter(F.array(*each), lambda x: x["value"].isNotNull() & ~x["value"].isin(*NO_CLITIC)))


def aligned_gloss(pos: Column, senses: Column) -> Column:
    """The gloss of the first sense (pos, gloss) that agrees with a part of speech, else of the first one for words of content; empty without any."""
    agrees = F.create_map(*[x for k, v in AGREES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    fit = F.filter(senses, lambda s: F.coalesce(F.array_contains(F.try_element_at(agrees, pos), F.lower(F.coalesce(s["pos"], F.lit("")))), F.lit(False)))
    gloss = lambda xs: F.trim(F.coalesce(F.get(xs, F.lit(0))["gloss"], F.lit("")))
    return F.when(F.size(fit) > 0, gloss(fit)).when(pos.isin(*CONTENT) & (F.size(senses) > 0), gloss(senses)).otherwise("")


def surface_pages(said: DataFrame, surface: str, path: str, analyses: DataFrame) -> DataFrame:
    """(surface, n, n_paths, paths, morphology, lemma_link, root_link) of each surface in ``said`` (surface, path).

    ``paths`` are the first few; all of them are rows of ``said``, and
    ``ordering.blocked_lists`` makes lists of them. ``analyses`` has (surface,
    lemma, root, pos) and clitics; of several of a surface the least holds, and
    one that says nothing is none.
    """
    each = said.groupBy(surface, path).agg(F.count("*").alias("_n"))
    place = Window.partitionBy(surface).orderBy(path)
    few = each.withColumn("_k", F.row_number().over(place)).where(F.col("_k") <= SHOWN)  # limited in each task
    few = few.groupBy(F.col(surface).alias("_s")).agg(F.array_sort(F.collect_list(path)).alias("paths"))
    counts = each.groupBy(surface).agg(F.sum("_n").alias("n"), F.count("*").alias("n_paths")).join(few, F.col(surface) == F.col("_s")).drop("_s")
    fields = [c for c in ("lemma", "root", "pos", *CLITICS) if c in analyses.columns]
    known = analyses.where(is_known(F.col("pos"), F.col("root"))).groupBy(F.col(surface).alias("_s")).agg(F.min(F.struct(*fields)).alias("a"))
    met = counts.join(known, F.col(surface) == F.col("_s"), "left").drop("_s")
    names = F.create_map(*[F.lit(x) for pair in POS.items() for x in pair])
    a = {c: F.col("a")[c] for c in fields}
    morphology = F.struct(a["lemma"].alias("lemma_slug"), a["root"].alias("root"), root_slug(a["root"]).alias("root_slug"), F.try_element_at(names, a["pos"]).alias("pos"), a["pos"].alias("pos_camel"), clitics(a).alias("clitics"))
    link = lambda base, slug: F.when(slug.isNotNull(), F.concat(F.lit(base), slug))
    return met.select(surface, "n", "n_paths", "paths", F.when(F.col("a").isNotNull(), morphology).alias("morphology"), link("/words/lemmas/", a["lemma"]).alias("lemma_link"), link("/words/roots/", root_slug(a["root"])).alias("root_link"))


def surface_items(pages: DataFrame, surface: str, lemmas: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``pages`` with what is known of their lemmas, (lemma, translations, senses), and contexts, (surface, contexts): a star of left joins on distinct keys."""
    one = lemmas.groupBy(F.col("lemma").alias("_l")).agg(F.first("translations", ignorenulls=True).alias("lemma_translations"), F.first("senses", ignorenulls=True).alias("_senses"))
    met = pages.join(one, F.col("morphology.lemma_slug") == F.col("_l"), "left").drop("_l")
    met = met.withColumn("en_gloss", F.coalesce(aligned_gloss(F.col("morphology.pos_camel"), F.col("_senses")), F.lit(""))).drop("_senses")
    if contexts is not None:
        met = met.join(contexts.select(F.col(surface).alias("_s"), "contexts"), F.col(surface) == F.col("_s"), "left").drop("_s")
    return met
