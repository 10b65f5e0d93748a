"""Arabic text normalisation as column expressions.

The variants differ in the marks that they drop and the letters that they
fold; each keeps a name of its own because their callers rely on the
difference. All are translate and regexp calls, so they fuse into one stage.
"""

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that the normalised forms are defined by.
TASHKEEL = "ًٌٍَُِّْٰٕٖٓٔ"
TATWEEL = "ـ"
LETTERS_FROM = "أإآٱةىؤئیک"
LETTERS_TO = "ااااهيوييك"
PUNCTUATION_FROM, PUNCTUATION_TO = "،؛؟", ",;?"
QURANIC_MARKS = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06DC}\x{06DF}-\x{06E4}\x{06E7}-\x{06E8}]"
WIDE_MARKS = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06DC}\x{06DF}-\x{06E8}\x{06EA}-\x{06ED}\x{08D3}-\x{08FF}]"
_BLANK = r"\s\x{00A0}\x{200B}-\x{200D}\x{FEFF}"
#: Runs of blanks but single spaces, which stay as they are.
BLANKS = rf"(?U) [{_BLANK}]+|[{_BLANK}&&[^ ]][{_BLANK}]*"
ARABIC_BLOCKS = r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}"


def strip_tashkeel(c: Column) -> Column:
    return F.translate(c, TASHKEEL, "")


def strip_tatweel(c: Column) -> Column:
    return F.translate(c, TATWEEL, "")


def fold_letters(c: Column) -> Column:
    return F.translate(c, LETTERS_FROM, LETTERS_TO)


def fold_punctuation(c: Column) -> Column:
    return F.translate(c, PUNCTUATION_FROM, PUNCTUATION_TO)


def squeeze_blanks(c: Column) -> Column:
    """Every run of white space, zero-width characters included, as one space; none at the edges."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def normalize(c: Column) -> Column:
    """For comparison: without tatweel and vowel marks, letters and punctuation folded, blanks squeezed."""
    # One pass; what is dropped comes last, as it has no counterpart.
    return squeeze_blanks(F.translate(c, LETTERS_FROM + PUNCTUATION_FROM + TATWEEL + TASHKEEL, LETTERS_TO + PUNCTUATION_TO))


def normalize_with_marks(c: Column) -> Column:
    """The same, vowel marks kept."""
    return squeeze_blanks(fold_punctuation(fold_letters(strip_tatweel(c))))


def normalize_for_shingles(c: Column) -> Column:
    """For quotation search: Quranic marks dropped; alif, ya and ta marbuta folded."""
    return F.translate(F.regexp_replace(c, QURANIC_MARKS, ""), "إأآةى", "اااهي")


def normalize_key(c: Column) -> Column:
    """For dictionary keys: Quranic marks dropped, trimmed."""
    return F.btrim(F.regexp_replace(c, QURANIC_MARKS, ""), F.lit(" \t\n\r\x0b\f "))


def strip_wide_marks(c: Column) -> Column:
    return F.regexp_replace(c, WIDE_MARKS, "")


def normalize_without_category_mn(c: Column) -> Column:
    """For search: every nonspacing mark dropped, alif and ya folded."""
    return F.translate(F.regexp_replace(c, r"\p{Mn}", ""), "أإآىةـ", "ااايه")


def shingle_tokens(c: Column) -> Column:
    """Words of Arabic letters and digits, after normalize_for_shingles."""
    return F.regexp_extract_all(normalize_for_shingles(c), F.lit(r"([\x{0621}-\x{064A}\x{0660}-\x{0669}]+)"), 1)


def arabic_fraction(c: Column) -> Column:
    """Share of Arabic characters among those that aren't blank; 0 for blank text."""
    dense = F.regexp_replace(c, r"(?U)\s", "")
    return F.coalesce(F.length(F.regexp_replace(dense, f"[^{ARABIC_BLOCKS}]", "")) / F.nullif(F.length(dense), F.lit(0)), F.lit(0.0))


def count_arabic(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"[^{ARABIC_BLOCKS}]", ""))


def marked_word_rate(c: Column) -> Column:
    """Share of words that carry a vowel mark."""
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.coalesce(F.size(F.filter(words, lambda w: F.length(F.translate(w, TASHKEEL, "")) < F.length(w))) / F.nullif(F.size(words), F.lit(0)), F.lit(0.0))


def diacritics_status(original: Column, marked: Column) -> Column:
    """'missing', 'validated' (unchanged), 'added' (the original had no marks) or 'corrected'."""
    bare = F.length(strip_tashkeel(original)) == F.length(original)
    return F.when(F.coalesce(marked, F.lit("")) == "", "missing").when(original == marked, "validated").when(bare, "added").otherwise("corrected")


def nfc(c: Column) -> Column:
    """Unicode normal form C; Spark has no expression for it, so Arrow batches go through Python."""

    def composed(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return F.pandas_udf(composed, "string")(c)


def buckwalter_to_arabic(c: Column) -> Column:
    """Buckwalter transliteration to Arabic letters."""
    # The public Buckwalter table.
    roman = "'|>&<}AbptvjHxd*rzs$SDTZEg_fqklmnhwYyFNKaui~o`{"
    arabic = "ءآأؤإئابةتثجحخدذرزسشصضطظعغـفقكلمنهوىيًٌٍَُِّْٰٱ"
    return nfc(F.translate(c, roman, arabic))
