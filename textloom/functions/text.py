"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import arabic


def tokens(c: Column) -> Column:
    """What lies between white space, without empty pieces."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def latin_tokens(c: Column, stop: list[str] = (), longer_than: int = 1) -> Column:
    """Lower-case runs of a-z and apostrophes, without stop words and short ones."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"([a-z']+)"), 1)
    return F.filter(found, lambda w: (F.length(w) > longer_than) & (~w.isin(*stop) if stop else F.lit(True)))


def edge_trimmed_tokens(c: Column, marks: str = ".,;:!?\"'()[]{}«»،؛؟…") -> Column:
    """Tokens without punctuation at their edges; empty ones dropped."""
    return F.filter(F.transform(tokens(c), lambda w: F.btrim(w, F.lit(marks))), lambda w: w != "")


def word_count(c: Column) -> Column:
    """Number of tokens; 0 for null and blank."""
    return F.coalesce(F.size(tokens(c)), F.lit(0))


def shingles(words: Column, n: int = 3) -> Column:
    """Distinct runs of ``n`` words joined by spaces; none if there are fewer words.

    ``words`` should be a column that exists: an expression would be worked
    out anew for every run.
    """
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def strip_tags(c: Column) -> Column:
    """Without tags and bracketed note numbers, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\[[0-9]+\]", ""))


def snippet(c: Column, n: int = 8) -> Column:
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; equal texts 1, one of them empty 0."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def similarity_of_like_lengths(a: Column, b: Column) -> Column:
    """The same, but 0 where one text is over twice as long as the other."""
    longer, shorter = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    return F.when(a == b, F.lit(1.0)).when(longer > 2 * shorter, F.lit(0.0)).otherwise(similarity(a, b))


def compare(a: Column, b: Column) -> Column:
    """Three tiers: 1 equal, 2 equal but for vowel marks, 3 different; with confidence and up to three differences."""
    whole_a, whole_b = arabic.normalize_with_marks(a), arabic.normalize_with_marks(b)
    base_a, base_b = arabic.normalize(a), arabic.normalize(b)
    wa, wb = tokens(base_a), tokens(base_b)
    only = lambda x, y, name: F.when(F.size(F.array_except(x, y)) > 0, F.concat(F.lit(name), F.array_join(F.slice(F.array_sort(F.array_except(x, y)), 1, 5), " ")))
    count = F.when(F.size(wa) != F.size(wb), F.concat(F.lit("word_count: "), F.size(wa).cast("string"), F.lit(" vs "), F.size(wb).cast("string")))
    tier = F.when(whole_a == whole_b, 1).when(base_a == base_b, 2).otherwise(3)
    confidence = F.when(whole_a == whole_b, F.lit(1.0)).when(base_a == base_b, similarity_of_like_lengths(whole_a, whole_b)).otherwise(similarity_of_like_lengths(base_a, base_b))
    differences = F.when(tier == 3, F.array_compact(F.array(only(wa, wb, "source_a_only: "), only(wb, wa, "source_b_only: "), count))).otherwise(F.array().cast("array<string>"))
    return F.struct(tier.alias("tier"), confidence.alias("confidence"), differences.alias("differences"))


def first_integer(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]+)", 1).try_cast("int")


def leading_number(c: Column) -> Column:
    """(n, rest) of 'n - rest'; n null where the text doesn't start with a number."""
    p = r"^\s*([0-9]+)\s*[-–.)]\s*"
    return F.struct(F.regexp_extract(c, p, 1).try_cast("int").alias("n"), F.regexp_replace(c, p, "").alias("rest"))


def short_md5(c: Column) -> Column:
    return F.left(F.md5(c), F.lit(12))


def safe_filename(c: Column) -> Column:
    """Characters that file systems reserve become underscores."""
    return F.translate(c, '<>:"/\\|?*', "_________")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[\s.]+", "-"), r"[^\p{L}\p{N}\-]", "")


def strip_fences(c: Column) -> Column:
    """The inside of a fenced block if there is one, else the trimmed text."""
    inner = F.regexp_extract(c, r"(?s)```(?:[a-zA-Z]+)?\s*(.*?)\s*```", 1)
    return F.when(inner != "", inner).otherwise(F.trim(c))


def json_payload(c: Column) -> Column:
    """The outermost {...} of an answer, fences and talk around it dropped; null where it isn't JSON."""
    body = F.regexp_extract(strip_fences(c), r"(?s)(\{.*\})", 1)
    fixed = F.regexp_replace(F.translate(body, "“”", '""'), r",\s*([}\]])", "$1")
    good = lambda x: F.try_parse_json(x).isNotNull()
    return F.when(body == "", F.lit(None)).when(good(body), body).when(good(fixed), fixed)


def has_script(c: Column, script: str) -> Column:
    """Whether a text holds letters of a Unicode script, such as 'Arabic', 'Han', 'Cyrillic' or 'Latin'."""
    return F.coalesce(c.rlike(rf"\p{{Is{script}}}"), F.lit(False))


def linked_references(c: Column, pattern: str, base: str) -> Column:
    """References (chapter and verse as groups 1 and 2 of ``pattern``) turned into links; text that is a link already stays."""
    return F.when(c.contains("<a "), c).otherwise(F.regexp_replace(c, pattern, f'<a href="{base}$1#h$2">$0</a>'))


def references(c: Column, pattern: str) -> Column:
    """All (chapter, verse) pairs, distinct, in order."""
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), 1).alias("chapter"), F.regexp_extract_all(c, F.lit(pattern), 2).alias("verse"))
    return F.array_distinct(F.transform(pairs, lambda p: F.struct(p["chapter"].try_cast("int").alias("chapter"), p["verse"].try_cast("int").alias("verse"))))


def paragraphs_to_html(c: Column) -> Column:
    """Blocks parted by blank lines, as <p> elements."""
    parts = F.filter(F.transform(F.split(c, r"\n\s*\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.transform(parts, lambda x: F.concat(F.lit("<p>"), F.replace(x, F.lit("\n"), F.lit("<br>")), F.lit("</p>"))), "")


def grade_class(c: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The first class with a word that the lower-cased text contains; 'other' without one."""
    out = F.lit("other")
    low = F.lower(F.coalesce(c, F.lit("")))
    for name, words in reversed(rules):
        out = F.when(F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w)), F.lit(name)).otherwise(out)
    return out
