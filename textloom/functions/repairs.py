"""Checks and repairs of answers: what can be mended, where an error lies, what changed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(c: Column, cases: list[tuple[list[str], str]], default: str) -> Column:
    """The name of the first case one of whose words a text contains."""
    out = F.lit(default)
    for words, name in reversed(cases):
        has = F.exists(F.array(*map(F.lit, words)), lambda w: F.coalesce(c, F.lit("")).contains(w))
        out = F.when(has, name).otherwise(out)
    return out


def contains_any(c: Column, words: list[str]) -> Column:
    """Whether a text contains one of the words; null is no text."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.coalesce(c, F.lit("")).contains(w))


def mapped_values(values: Column, valid: list[str], mapping: dict[str, str], most: int = 5, default: str | None = None) -> Column:
    """(values, n_fixed): valid ones as they are, others by the mapping or dropped; distinct, in order, at most so many; the default if none is left."""
    names = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]) if mapping else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    given = F.coalesce(values, F.array().cast("array<string>"))
    new = F.transform(given, lambda v: F.when(v.isin(*valid), v).otherwise(F.try_element_at(names, v)))
    kept = F.array_distinct(F.filter(new, lambda v: v.isNotNull()))
    empty = F.size(kept) == 0
    out = F.when(empty, F.array(F.lit(default))).otherwise(kept) if default else kept
    fixed = F.size(F.filter(given, lambda v: ~v.isin(*valid))) + (empty.cast("int") if default else F.lit(0))
    return F.struct(F.slice(out, 1, most).alias("values"), fixed.alias("n_fixed"))


def replaced_words(words: Column, fixes: dict[str, str], punctuation: str) -> Column:
    """Words by the list of fixes, punctuation at their edges left where it is."""
    names = F.create_map(*[F.lit(x) for pair in fixes.items() for x in pair])
    edge = "[" + "".join("\\" + c for c in punctuation) + "]*"

    def one(w: Column) -> Column:
        inner = F.regexp_extract(w, rf"(?s)^{edge}(.*?){edge}\z", 1)
        return F.concat(F.regexp_extract(w, f"^({edge})", 1), F.coalesce(F.try_element_at(names, inner), inner), F.when(inner != "", F.regexp_extract(w, rf"({edge})\z", 1)).otherwise(""))

    return F.transform(words, one)


def length_flag(source: Column, target: Column) -> Column:
    """'short' or 'long' where a translation has far fewer or more words than its source; wider bounds for sources under three words; null if fine or empty."""
    n = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != ""))
    a, b = n(source), n(target)
    low, high = F.when(a >= 3, 0.4 * a).otherwise(0.25 * a), F.when(a >= 3, 4.0 * a).otherwise(6.0 * a)
    return F.when((a > 0) & (b > 0) & (b < low), "short").when((a > 0) & (b > 0) & (b > high), "long")


#: Verbs that open a chain of transmission, without vowel marks.
CHAIN_OPENERS = ["روى", "رواه", "روي", "حدثنا", "حدثني", "اخبرنا", "اخبرني"]


def type_flag(kind: Column, text: Column, surfaces: Column) -> Column:
    """'no_narrator' for a chain without a known name in it, 'opens_like_chain' for another text that begins with a verb of transmission; null if fine."""
    first = F.regexp_replace(F.try_element_at(F.split(F.trim(text), r"(?U)\s+"), F.lit(1)), "^و(?=.)", "")
    named = (F.size(surfaces) > 0) & ~F.exists(surfaces, lambda s: text.contains(s))
    return F.when((kind == "isnad") & named, "no_narrator").when((kind != "isnad") & first.isin(*CHAIN_OPENERS), "opens_like_chain")


def translation_flags(source: Column, target: Column, other_script: Column, needs_marks: Column) -> Column:
    """(empty, ratio, length, echo, marks): flags of one translation by its length against the source, Arabic letters where there should be none, and missing accents in a long text."""
    blank = F.coalesce(F.trim(target), F.lit("")) == ""
    ratio = F.when(~blank & (F.length(source) > 0), F.round(F.length(target) / F.length(source), 2))
    return F.struct(
        blank.alias("empty"), ratio.alias("ratio"), F.coalesce((ratio < 0.3) | (ratio > 3.5), F.lit(False)).alias("length"),
        (~blank & other_script & target.rlike(r"[\x{0600}-\x{06FF}]")).alias("echo"), (~blank & needs_marks & (F.length(target) > 30) & ~target.rlike(r"[À-ÖØ-öø-ÿĀ-ſ]")).alias("marks"),
    )


def verified(stored: Column, rebuilt: Column) -> Column:
    """(same, reason): whether a stored text is what can be rebuilt, to the byte, and why not."""
    at = F.aggregate(F.sequence(F.lit(1), F.length(stored)), F.lit(0), lambda a, i: F.when((a == 0) & (F.substring(stored, i, F.lit(1)) != F.substring(rebuilt, i, F.lit(1))), i).otherwise(a)) - 1
    reason = (
        F.when(stored.eqNullSafe(rebuilt), F.lit(None).cast("string")).when(stored.isNull() | rebuilt.isNull(), "one is missing").when(F.trim(stored) == F.trim(rebuilt), "white space at the edges")
        .when(F.length(stored) != F.length(rebuilt), F.concat(F.lit("length "), F.length(stored).cast("string"), F.lit(" and "), F.length(rebuilt).cast("string"))).otherwise(F.concat(F.lit("at "), at.cast("string")))
    )
    return F.struct(stored.eqNullSafe(rebuilt).alias("same"), reason.alias("reason"))


def without_verified(result: Column, checks: dict[str, Column]) -> Column:
    """A struct whose fields that can be rebuilt are null; the checks are those of ``verified``."""
    for field, check in checks.items():
        result = result.withField(field, F.when(~check["same"], result[field]))
    return result


def custom_id(c: Column) -> Column:
    """(path, lang) of 'book:1:2__lang', split at the last mark; null if there is none."""
    ok = c.contains("__")
    lang = F.substring_index(c, "__", -1)
    return F.when(ok, F.struct(F.concat(F.lit("/books/"), F.left(c, F.length(c) - F.length(lang) - 2)).alias("path"), lang.alias("lang")))


def quotes_escaped(c: Column) -> Column:
    """JSON text in which a quote inside a value, one that neither opens nor closes it, is escaped."""
    return F.regexp_replace(c, r'(?<=[^\s\\:,{\[])"(?=[^\s:,}\]])', r'\\"')


def shape(kinds: Column, content_type: Column, topics: Column, has_chain: Column, n_words: Column) -> Column:
    """The stratum of a text by its parts."""
    n = F.size(kinds)
    return (
        F.when(F.array_contains(kinds, "quran_quote"), "quran_quoting").when((content_type == "supplication") | F.array_contains(topics, "dua"), "dua").when(n >= 4, "long_multi_chunk")
        .when(has_chain & n.between(2, 3), "medium_isnad_matn").when((n == 1) & (n_words < 50), "short_matn_only").otherwise("other")
    )
