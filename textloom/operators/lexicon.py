"""Lexicon look-ups and the pages that come of them: words against dictionaries, counts and entry lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lookup(rows: DataFrame, key: Column, index: DataFrame, index_key: str, fold: Column, index_fold: Column, values: list[str]) -> DataFrame:
    """``rows`` with ``values`` of the index and ``found``: by the key as it is, else by the folded key, else null.

    Of several index rows with one folded key the one with the least key
    stands for all. Both look-ups are equi-joins.
    """
    exact = index.select(F.col(index_key).alias("_exact"), F.struct(*values).alias("_a")).groupBy("_exact").agg(F.min("_a").alias("_a"))
    folded = index.where(index_fold.isNotNull() & (index_fold != "")).groupBy(index_fold.alias("_fold")).agg(F.min_by(F.struct(*values), F.col(index_key)).alias("_b"))
    met = rows.withColumns({"_key": key, "_folded": fold}).join(exact, F.col("_key") == F.col("_exact"), "left").join(folded, F.col("_folded") == F.col("_fold"), "left")
    found = F.when(F.col("_a").isNotNull(), "exact").when(F.col("_b").isNotNull(), "folded").otherwise("none")
    best = F.coalesce("_a", "_b")
    return met.select(*rows.columns, *[best[v].alias(v) for v in values], found.alias("found"))


def folded_counts(rows: DataFrame, fold: Column, count: str, item: str) -> DataFrame:
    """(key, n, n_items, first_item): counts summed and distinct items counted over all spellings of a key; empty keys dropped."""
    kept = rows.withColumn("key", fold).where(F.col("key").isNotNull() & (F.col("key") != ""))
    return kept.groupBy("key").agg(F.sum(count).alias("n"), F.count_distinct(item).alias("n_items"), F.min(item).alias("first_item"))


def folded_lists(rows: DataFrame, fold: Column, values: str, order: str) -> DataFrame:
    """(key, values): the arrays of all spellings of a key, one after the other in the given order; a list is as long as a lexicon's entry."""
    kept = rows.withColumn("key", fold).where(F.col("key").isNotNull() & (F.col("key") != ""))
    lists = F.sort_array(F.collect_list(F.struct(order, values)))
    return kept.groupBy("key").agg(F.flatten(F.transform(lists, lambda x: x[values])).alias(values))


def ordered_entries(rows: DataFrame, id_col: str, ids: Column, entries: DataFrame, entry_id: str, columns: list[str]) -> DataFrame:
    """(id, entries): the entries that a row's list of ids names, in the order of the list; ids without an entry drop out, and rows without any."""
    asked = rows.select(id_col, F.posexplode(ids).alias("pos", "_asked"))
    met = asked.join(entries.select(F.col(entry_id).alias("_asked"), *columns), "_asked")
    made = F.sort_array(F.collect_list(F.struct("pos", F.col("_asked").alias(entry_id), *columns)))
    return met.groupBy(id_col).agg(F.transform(made, lambda x: F.struct(x[entry_id].alias(entry_id), *[x[c].alias(c) for c in columns])).alias("entries"))


def best_of(rows: DataFrame, keys: list[str], candidates: DataFrame, on: list[tuple[Column, Column]], order: list[Column]) -> DataFrame:
    """Each row with its best candidate: that of the first pair of equal keys in ``on``, then the first by ``order``, which is of the candidates; ``rank`` tells which pair.

    The candidates of a key are ranked before they meet the rows, so a row
    meets one a pair of keys, however many share its key.
    """
    met = None
    for i, (left, right) in enumerate(on):
        first = F.row_number().over(Window.partitionBy(right).orderBy(*order))
        some = candidates.withColumn("_first", first).where((F.col("_first") == 1) & right.isNotNull()).drop("_first")
        one = rows.join(some, left == right).withColumn("rank", F.lit(i))
        met = one if met is None else met.unionByName(one)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", *order))
    return met.withColumn("_place", place).where("_place = 1").drop("_place")


def merged_senses(entries: Column, most_examples: int = 2) -> Column:
    """The senses of all entries (pos, senses(gloss, examples)) in a row, each with its entry's pos; those without a gloss drop out, examples are few."""
    each = lambda e: F.transform(F.filter(e["senses"], lambda s: F.trim(F.coalesce(s["gloss"], F.lit(""))) != ""), lambda s: F.struct(e["pos"].alias("pos"), s["gloss"].alias("gloss"), F.slice(s["examples"], 1, most_examples).alias("examples")))
    return F.flatten(F.transform(entries, each))


def distinct_in_order(lists: Column) -> Column:
    """What several lists hold, each value where it stands first; null if nothing."""
    out = F.array_distinct(F.flatten(F.filter(lists, lambda x: x.isNotNull())))
    return F.when(F.size(out) > 0, out)


def overridden(rows: DataFrame, key: str, column: str, dictionary: DataFrame, value: str) -> DataFrame:
    """``rows`` with the dictionary's value where it has the key, and ``was`` where that changed something."""
    known = dictionary.groupBy(key).agg(F.max(value).alias("_value"))
    met = rows.join(known, key, "left")
    new = F.coalesce("_value", column)
    return met.withColumns({"was": F.when(F.col("_value").isNotNull() & ~F.col("_value").eqNullSafe(F.col(column)), F.col(column)), column: new}).drop("_value")


def pages(forms: DataFrame, lemma: str, form: str, counts: DataFrame, lexicons: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(lemma, n_forms, n, n_seen, <lexicon> ...): the forms of a lemma against corpus counts (form, n) and, by lemma, each lexicon's value.

    A star join: counts are summed by lemma before the lexicons come in.
    """
    held = forms.select(lemma, form).distinct().join(counts.select(form, "n"), form, "left").groupBy(lemma)
    out = held.agg(F.count("*").alias("n_forms"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("n").alias("n_seen"))
    for name, (lexicon, value) in lexicons.items():
        one = lexicon.groupBy(lemma).agg(F.min(value).alias(name))
        out = out.join(one, lemma, "left")
    return out


def roots(lemmas: DataFrame, root: str, lemma: str, count: str, top: int = 3) -> DataFrame:
    """(root, n_lemmas, n, top): what the lemmas of a root sum up to, and the most frequent ones."""
    place = F.row_number().over(Window.partitionBy(root).orderBy(F.desc(count), lemma))
    some = lemmas.withColumn("_place", place).where(F.col("_place") <= top)  # limited in each task before the shuffle
    named = some.groupBy(F.col(root).alias("_root")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", F.col(lemma).cast("string").alias("name")))), lambda x: x["name"]), " ").alias("top"))
    return lemmas.groupBy(root).agg(F.count("*").alias("n_lemmas"), F.sum(count).alias("n")).join(named, F.col(root).eqNullSafe(F.col("_root"))).select(root, "n_lemmas", "n", "top")


def role_key(aspect: Column, person: Column, gender: Column, number: Column, pos: Column) -> Column:
    """The role of a form: aspect, person, gender and number of a verb, or what kind of noun it is; null for others."""
    # Names of aspects and of derived nouns.
    named = F.when(aspect == "p", "past").when(aspect == "i", "present").when(aspect == "c", "imperative")
    verb = F.concat(named, F.lit("_"), F.nullif(person, F.lit("")), F.nullif(gender, F.lit("")), F.nullif(number, F.lit("")))
    noun = F.when(pos == "verbal_noun", "verbal_noun").when(pos.isin("adj.act", "verb.act_partic"), "active_participle").when(pos.isin("adj.pass", "verb.pass_partic"), "passive_participle")
    return F.coalesce(verb, noun)


#: Parts of speech of the analyser, and what they are called here.
POS = {
    "verb": "V", "noun": "N", "noun_prop": "N", "noun_quant": "N", "noun_num": "N", "adj": "ADJ", "adj_comp": "ADJ", "adj_num": "ADJ", "adv": "ADV", "prep": "PREP", "conj": "CONJ", "sub_conj": "CONJ", "pron": "PRON", "rel_pron": "REL", "dem_pron": "DEM",
    "interrog_pron": "INTERR", "interrog_part": "INTERR", "part": "PART", "neg_part": "NEG", "focus_part": "PART", "voc_part": "PART", "fut_part": "PART", "prog_part": "PART", "intj": "INTJ", "abbrev": "N", "digit": "N",
}


def pos_name(c: Column) -> Column:
    """The name of a part of speech; N for an unknown one."""
    names = F.create_map(*[F.lit(x) for pair in POS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, c), F.lit("N"))


def root_slug(c: Column) -> Column:
    """A root as part of an address; null for none and for foreign words."""
    return F.when((c != "") & (c != "FOREIGN"), F.translate(c, ".#", "-_"))


def pos_without_suffix(c: Column) -> Column:
    """``verb.act`` as ``verb``."""
    return F.regexp_replace(c, r"\..*$", "")


def rendered_slots(slots: Column, before: list[str], after: list[str], labels: dict[str, tuple[str, str]]) -> Column:
    """One line for the clitics of a word (a map from slot to code), those before it and those after it in the order of their slots; an unknown code stands for itself."""
    forms = F.create_map(*[x for code, (form, label) in labels.items() for x in (F.lit(code), F.lit(f'{form} "{label}"'))])

    def part(names: list[str], title: str) -> Column:
        codes = F.filter(F.array(*[F.try_element_at(slots, F.lit(n)) for n in names]), lambda x: F.coalesce(x, F.lit("")) != "")
        said = F.transform(codes, lambda x: F.coalesce(F.try_element_at(forms, x), F.concat(x, F.lit(' "unknown clitic"'))))
        return F.when(F.size(said) > 0, F.concat(F.lit(title), F.array_join(said, " + ")))

    return F.concat_ws("; ", part(before, "proclitics: "), part(after, "enclitics: "))
