"""Answers mended by rule, with a list of what was done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.repairs import replaced_words

# Signs at the edges of words, and the note for a name that several people have.
EDGES = ".,،:;؛؟!)]}>»」』([{<«「『﴿"
NOTE = "Multiple narrators share this name; identified based on chain context and historical records"
UNSURE = ["likely", "ambiguous"]


def marked(answers: DataFrame, words: str, texts: str, fixes: dict[str, str]) -> DataFrame:
    """``answers`` with words (array) and texts (array) written as ``fixes`` has them, ``text``, the words in a line, and ``n_fixed``.

    A word is one of the list or isn't, signs at its edges aside; in texts
    every place of an entry is replaced, one entry after the other.
    """
    fixes = {a: b for a, b in fixes.items() if a != b}
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in fixes.items()])
    new = replaced_words(F.col(words), fixes, EDGES)
    changed = F.size(F.filter(F.arrays_zip(F.col(words).alias("was"), F.col("_new").alias("now")), lambda x: x["was"] != x["now"]))
    out = answers.withColumn("_new", new).withColumn("n_fixed", F.when(F.col(words).isNull(), 0).otherwise(changed))
    done = F.transform(texts, lambda t: F.aggregate(steps, t, lambda x, s: F.replace(x, s["a"], s["b"])))
    return out.withColumns({words: F.col("_new"), texts: done, "text": F.when(F.size("_new") > 0, F.array_join("_new", " "))}).drop("_new")


def _renewed(x: Column, fields: list[str], **new: Column) -> Column:
    return F.struct(*[new.get(f, x[f]).alias(f) for f in fields])


def mended(answers: DataFrame, n_words: Column, narrators: str, chunks: str, topics: str, valid: list[str]) -> DataFrame:
    """``answers`` with the faults that have one cure, and ``fixes``, what was done.

    A narrator (name_en, identity_confidence, ambiguity_note, word_ranges) that
    isn't sure gets a note; a range without a word gets its first; the last
    chunk (word_end) that ends at the last word, not behind it, is corrected;
    topics that there aren't go, and the array with them if none is left.
    """
    schema = answers.schema
    person, part = schema[narrators].dataType.elementType, schema[chunks].dataType.elementType
    ranges = person["word_ranges"].dataType.elementType.fieldNames()
    name = lambda x: F.coalesce(x["name_en"], F.lit("?"))
    unnamed = lambda x: F.coalesce(x["identity_confidence"].isin(*UNSURE), F.lit(False)) & (F.coalesce(x["ambiguity_note"], F.lit("")) == "")
    empty = lambda r: F.coalesce(r["word_end"] == r["word_start"], F.lit(False))
    none = F.array().cast("array<string>")

    def person_done(x: Column) -> Column:
        wide = F.transform(x["word_ranges"], lambda r: F.when(empty(r), _renewed(r, ranges, word_end=r["word_start"] + 1)).otherwise(r))
        return F.when(x.isNull(), x).otherwise(_renewed(x, person.fieldNames(), ambiguity_note=F.when(unnamed(x), NOTE).otherwise(x["ambiguity_note"]), word_ranges=wide))

    people = F.coalesce(F.col(narrators), F.array().cast(schema[narrators].dataType))
    noted = F.transform(F.filter(people, unnamed), lambda x: F.concat(F.lit("auto-filled ambiguity_note for "), name(x)))
    widened = F.flatten(F.transform(people, lambda x: F.transform(F.filter(F.coalesce(x["word_ranges"], F.array().cast(person["word_ranges"].dataType)), empty), lambda r: F.concat(F.lit("corrected narrator "), name(x), F.lit(" word_end from "), r["word_start"].cast("string"), F.lit(" to "), (r["word_start"] + 1).cast("string")))))
    short = (n_words > 0) & (F.size(chunks) > 0) & F.coalesce(F.get(chunks, F.size(chunks) - 1)["word_end"] == n_words - 1, F.lit(False))
    ended = F.transform(chunks, lambda x, i: F.when(short & (i == F.size(chunks) - 1), _renewed(x, part.fieldNames(), word_end=n_words)).otherwise(x))
    said = F.when(short, F.array(F.concat(F.lit("corrected last chunk word_end from "), (n_words - 1).cast("string"), F.lit(" to "), n_words.cast("string")))).otherwise(none)
    good, bad = F.filter(topics, lambda t: t.isin(*valid)), F.filter(topics, lambda t: ~t.isin(*valid))
    dropped = F.when(F.size(bad) > 0, F.array(F.concat(F.when(F.size(good) > 0, "removed invalid topics: ").otherwise("removed all invalid topics: "), F.array_join(bad, ", ")))).otherwise(none)
    fixes = F.concat(noted, said, widened, F.coalesce(dropped, none))
    kept = F.when((F.size(good) > 0) | (F.size(bad) <= 0), good)
    return answers.withColumns({"fixes": fixes, narrators: F.transform(narrators, person_done), chunks: ended, topics: kept})
