"""Answers and relations merged into documents, and documents taken apart again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged_answers(rows: DataFrame, answers: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``columns`` of the answer that has their key (the last by the order of these columns, if there are several) and ``answered``."""
    one = answers.groupBy(key).agg(F.max(F.struct(*columns)).alias("_answer"))
    return rows.join(one, key, "left").select(*rows.columns, *[F.col("_answer")[c].alias(c) for c in columns], F.col("_answer").isNotNull().alias("answered"))


def answered_langs(rows: DataFrame, parent: str, key: str, answers: DataFrame, lang: str, suffix: str = ".ai") -> DataFrame:
    """(parent, n_answered, langs): for each parent, how many of its rows have an answer and in which languages; there are few languages."""
    met = rows.select(parent, key).join(answers.select(key, lang).distinct(), key)
    return met.groupBy(parent).agg(F.count_distinct(key).alias("n_answered"), F.array_sort(F.collect_set(F.concat(F.col(lang), F.lit(suffix)))).alias("langs"))


def joined_relations(rows: DataFrame, key: str, links: DataFrame, kind: str, target: str) -> DataFrame:
    """(key, kind, n_targets, first_target) of all links, given and new: relations united as rows, so no document holds a long list."""
    given = rows.select(key, kind, target)
    both = given.unionByName(links.select(key, kind, target)).where(F.col(target).isNotNull()).distinct()
    return both.groupBy(key, kind).agg(F.count("*").alias("n_targets"), F.min(target).alias("first_target"))


def later_wins(sources: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """(keys, value): of several sources the last one that has a value."""
    tagged = [s.select(*keys, F.col(value).alias("_v"), F.lit(i).alias("_i")) for i, s in enumerate(sources)]
    both = reduce(DataFrame.unionByName, tagged).where(F.col("_v").isNotNull())
    return both.groupBy(*keys).agg(F.max_by("_v", F.struct("_i", "_v")).alias(value))


def stacked(sources: list[DataFrame], number: str) -> DataFrame:
    """All rows of several sources, with the source's number from 1 in place of what they called it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn(number, F.lit(i)) for i, s in enumerate(sources, 1)])


def lean_maps(by_lang: Column, fields: list[str]) -> Column:
    """A map of language -> struct as a struct of maps of language -> field; languages without a field are left out of its map."""
    one = lambda f: F.map_filter(F.transform_values(by_lang, lambda _, v: v[f]), lambda _, v: v.isNotNull())
    return F.struct(*[one(f).alias(f) for f in fields])


def aligned_texts(chunks: Column, texts: Column, field: str) -> Column:
    """Chunks with the text of the same place; a chunk beyond the texts keeps null."""
    return F.transform(chunks, lambda c, i: c.withField(field, F.get(texts, i)))


def slotted_words(rows: Column, langs: list[str], first: int = 3) -> Column:
    """Words given as arrays of slots, as structs: word, pos, and a map from language to gloss for those that have enough slots."""
    whole = F.filter(rows, lambda r: F.size(r) >= first + len(langs))
    return F.transform(whole, lambda r: F.struct(r[0].alias("word"), r[1].alias("pos"), F.map_from_arrays(F.array(*map(F.lit, langs)), F.slice(r, first + 1, len(langs))).alias("glosses")))


def default_text(texts: Column, default: Column, prefix: str, but: str) -> Column:
    """From a map of texts: the default one, else the first whose name has the prefix and isn't ``but``."""
    first = F.filter(F.map_entries(texts), lambda e: e["key"].startswith(prefix) & (e["key"] != but))
    return F.coalesce(F.try_element_at(texts, default), F.try_element_at(first, F.lit(1))["value"])


def assembled(parts: DataFrame, key: str, number: str, text: str, total: str) -> DataFrame:
    """(key, text, starts, complete): the parts of a text put together in order, where each starts (in words), and whether all are there."""
    made = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(number).alias("i"), F.col(text).alias("t")))).alias("_p"), F.max(total).alias("_n"))
    texts = F.transform("_p", lambda x: x["t"])
    words = F.transform(texts, lambda t: F.size(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")))
    starts = F.transform(F.sequence(F.lit(1), F.size("_p")), lambda i: F.aggregate(F.slice(words, 1, i - 1), F.lit(0), lambda a, w: a + w))
    complete = (F.size("_p") == F.col("_n")) & F.forall("_p", lambda x: x["i"].isNotNull())
    return made.select(key, F.array_join(texts, " ").alias("text"), starts.alias("starts"), complete.alias("complete"))
