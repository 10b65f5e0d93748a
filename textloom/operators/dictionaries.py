"""Ordered corrections and phrase dictionaries, matched by automata over whole texts.

A dictionary goes to the tasks in batches of bounded size, each as an
Aho-Corasick automaton, so it may be of any size: one more batch is one more
pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import arabic

#: Characters and entries of a batch.
BATCH_CHARS, BATCH_ROWS = 4_000_000, 100_000

#: The last automaton of this worker, by the list that it was built of.
_built: list[tuple] = []


def _automaton(shared: Broadcast) -> ahocorasick.Automaton:
    """Of a list of keys, built once a worker; it says the places of a key in the list."""
    if not _built or _built[0][0] is not shared:
        made = ahocorasick.Automaton()
        for i, key in enumerate(shared.value):
            made.add_word(key, (*made.get(key, ()), i))
        made.make_automaton()
        _built[:] = [(shared, made)]
    return _built[0][1]


def _batches(rows: DataFrame, order: str, chars: Column, most_rows: int = BATCH_ROWS, most_chars: int = BATCH_CHARS) -> Iterator[list]:
    """The rows in order, as lists of bounded size; only one is held at a time."""
    held, size = [], 0
    for row in rows.withColumn("_chars", chars).orderBy(order).toLocalIterator():
        if held and (len(held) == most_rows or size + row["_chars"] > most_chars):
            yield held
            held, size = [], 0
        held.append(row)
        size += row["_chars"]
    if held:
        yield held


def corrected_by_key(texts: DataFrame, key: Column, text: str, corrections: DataFrame) -> DataFrame:
    """``texts`` with ``text`` corrected by the ``corrections`` (key, pos, before, after) of its key, one after the other.

    Each replaces in what the one before it has left. The corrections of one
    key are few: they are one list in its row.
    """
    step = F.struct("pos", "before", "after")
    listed = corrections.where("before <> ''").groupBy(F.col("key").alias("_key")).agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    met = texts.withColumn("_key", key).join(listed, "_key", "left")
    done = F.aggregate("_steps", F.col(text), lambda t, s: F.replace(t, s["before"], F.coalesce(s["after"], F.lit(""))))
    return met.withColumn(text, F.when(F.col("_steps").isNull(), F.col(text)).otherwise(done)).drop("_key", "_steps")


def _corrector(before: Broadcast, after: Broadcast) -> Column:
    def one(t: str | None) -> str | None:
        done = -1
        while t:
            due = min((i for _, places in _automaton(before).iter(t) for i in places if i > done), default=None)
            if due is None:
                break
            t, done = t.replace(before.value[due], after.value[due]), due
        return t

    def run(column: pd.Series) -> pd.Series:
        return column.map(one)

    return F.pandas_udf(run, "string")


def corrected(texts: DataFrame, text: str, corrections: DataFrame, most_rows: int = BATCH_ROWS) -> DataFrame:
    """``texts`` with every text corrected by all ``corrections`` (pos, before, after), in order of ``pos``.

    The result is that of replacing each, one after the other. The automaton
    says which ones occur, so a text is gone over again only after a
    correction that has changed it.
    """
    send = texts.sparkSession.sparkContext.broadcast
    rows = corrections.select("pos", "before", F.coalesce("after", F.lit("")).alias("after")).where("before <> ''")
    for batch in _batches(rows, "pos", F.length("before") + F.length("after"), most_rows):
        correct = _corrector(send([r["before"] for r in batch]), send([r["after"] for r in batch]))
        texts = texts.withColumn(text, correct(F.col(text)))
    return texts


def _finder(keys: Broadcast, ids: Broadcast, kind: str) -> Column:
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: [ids.value[i] for i in sorted({i for _, places in _automaton(keys).iter(t) for i in places})])

    return F.pandas_udf(run, f"array<{kind}>")


def phrases_found(texts: DataFrame, id_col: str, text: Column, phrases: DataFrame, phrase_id: str, phrase: str, most_rows: int = BATCH_ROWS) -> DataFrame:
    """(id, phrase_id): the phrases that stand in a text, vowel marks aside; what is nothing but marks stands nowhere."""
    send = texts.sparkSession.sparkContext.broadcast
    said = texts.select(F.col(id_col).alias("_id"), arabic.strip_tashkeel(F.coalesce(text, F.lit(""))).alias("_text"))
    named = phrases.select(F.col(phrase_id).alias("_pid"), arabic.strip_tashkeel(F.col(phrase)).alias("_phrase")).where("_phrase <> ''")
    kind, out = named.schema["_pid"].dataType, None
    for batch in _batches(named, "_pid", F.length("_phrase"), most_rows):
        find = _finder(send([r["_phrase"] for r in batch]), send([r["_pid"] for r in batch]), kind.simpleString())
        found = said.select(F.col("_id").alias(id_col), F.explode(find(F.col("_text"))).alias(phrase_id))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else said.select(F.col("_id").alias(id_col), F.lit(None).cast(kind).alias(phrase_id)).limit(0)


# Categories of phrases that count.
CATEGORIES = ["theological_concept", "well_known_saying", "jurisprudential_term", "quranic_echo", "prophetic_formula"]


def key_phrases(texts: DataFrame, id_col: str, text: Column, phrases: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """(id, phrase_ar, phrase_en, category): the phrases of a dictionary (phrase_ar, phrase_en, category) that a text holds."""
    known = phrases.where(F.col("category").isin(*categories) & (F.col("phrase_ar") != "")).distinct()
    found = phrases_found(texts, id_col, text, known, "phrase_ar", "phrase_ar").distinct()
    return found.join(known, "phrase_ar").select(id_col, "phrase_ar", F.coalesce("phrase_en", F.lit("")).alias("phrase_en"), "category")
