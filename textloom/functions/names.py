"""Names in chains of transmission: keys to find them by, where a chain ends, its names in order, links, transliteration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import arabic

# Formulas of respect after a name, as they read once normalised, and what else may hang at its end.
FORMULAS = ["عليه السلام", "عليها السلام", "عليهم السلام", "عليهما السلام", "صلي الله عليه واله", "صلي الله عليه واله وسلم", "صلي الله عليه وسلم", "صلوات الله عليه", "صلوات الله عليها", "صلوات الله عليهم", "صلوات الله عليهما", "رضي الله عنه", "رضي الله عنها", "رحمه الله", "رحمه الله تعالي"]
SHORT_FORMULAS = ["ع", "ره", "ص"]
TRAILING_WORDS = ["انه", "قال"]
# Verbs that open a chain, normalised.
OPENING_VERBS = ["وروي", "روي", "وحدثني", "حدثني", "وحدثنا", "حدثنا", "واخبرنا", "اخبرنا", "واخبرني", "اخبرني", "وسمعت", "سمعت"]
# Formulas that name matching deletes, as written.
WRITTEN_FORMULAS = ["( عليه السلام )", "( عليهم السلام )", "( صلى الله عليه وآله )", "( صلوات الله عليه )", "( عليها السلام )", "(عليه السلام)", "(عليهم السلام)", "(صلى الله عليه وآله)"]
# Signs of a chain near the beginning of a text; what ends it; what may open it; what stands between names; all with vowel marks and without.
SIGNALS = r"بْن[ُِ]|(?U)\b(?:بن|عَنْ|عَنِ|عن)\b|حَدَّثَنَا|حَدَّثَنِي|أَخْبَرَنَا|أَخْبَرَنِي|سَمِعْتُ|رَوَى|حدثنا|حدثني|اخبرنا|اخبرني|سمعت|روى"
ENDS = ["قَالَ", "فِي هَذِهِ الْآيَةِ", "يَرْفَعُهُ قَالَ", "رَفَعَهُ قَالَ", "فَكَانَ مِنْ سُؤَالِهِ أَنْ قَالَ", "فِي قَوْلِهِ", "فِي قَوْلِ", "فِي", "وَبِهَذَا الْإِسْنَادِ", "وَفِي رِوَايَةِ", "أَنَّهُ", "أَنَّ", "يَقُولُ", "فَقَالَ", "مِثْلَهُ"]
OPENERS = ["أخْبَرَنَا", "أَخْبَرَنَا", "أَخْبَرَنِي", "وَأَخْبَرَنَا", "وَأَخْبَرَنِي", "حَدَّثَنَا", "حَدَّثَنِي", "وَحَدَّثَنَا", "وَحَدَّثَنِي", "رَوَى", "وَرَوَى", "سَمِعْتُ", "وَسَمِعْتُ", "وَ"]
BETWEEN = ["عَمَّنْ سَمِعَ", "وَ سَمِعْتُ", "وَ", "جَمِيعاً عَنْ", "جَمِيعاً عَنِ", "عَنْ", "عَنِ", "إِلَى", "قَالَ حَدَّثَنِي", "عَمَّنْ", "مِمَّنْ", "مِنْهُمْ", "رَفَعَهُ عَنْ", "رَفَعَهُ إِلَى", "فِي حَدِيثِ", "رَفَعَهُ أَنَّ", "رَفَعَهُ"]
ENDS_BARE = ["قال", "في هذه الاية", "يرفعه قال", "رفعه قال", "فكان من سؤاله ان قال", "في قوله", "في قول", "في", "وبهذا الاسناد", "وفي رواية", "انه", "ان", "يقول", "فقال", "مثله"]
OPENERS_BARE = ["اخبرنا", "اخبرني", "واخبرنا", "واخبرني", "حدثنا", "حدثني", "وحدثنا", "وحدثني", "روى", "وروى", "سمعت", "وسمعت", "و"]
BETWEEN_BARE = ["عمن سمع", "و سمعت", "و", "جميعا عن", "عن", "الى", "قال حدثني", "عمن", "ممن", "منهم", "رفعه عن", "رفعه الى", "في حديث", "رفعه ان", "رفعه"]
SAME_CHAIN_GOES_ON = "حَدَّثَنِي"
# How sources of some books begin before the chain, without vowel marks.
PREAMBLES = ["ما أخبرني به", "أخبرني به", "فأما ما رواه", "ما رواه"]

_any = "|".join
MARKS = f"[{arabic.TASHKEEL}]*"


def without_suffixes(c: Column) -> Column:
    """A normalised name without formulas, abbreviations, particles and punctuation at its end, however many."""
    whole = rf"\s*\(\s*(?:{_any(FORMULAS + SHORT_FORMULAS)})\.?\s*\)|\s+(?:{_any(FORMULAS + SHORT_FORMULAS + TRAILING_WORDS)})|\s*[:,;.?\-–—]"
    return F.regexp_replace(c, rf"(?=[\s(:,;.?\-–—])(?:{whole})+\s*$", "")


def without_opening_verb(c: Column) -> Column:
    """A normalised name without a verb of transmission before it; a lone verb stays."""
    return F.regexp_replace(c, rf"^(?:{_any(OPENING_VERBS)}) \s*(?=\S)", "")


def canonical_key(c: Column) -> Column:
    """What all spellings of a name have in common; empty for null."""
    return F.trim(F.coalesce(without_opening_verb(without_suffixes(arabic.normalize(c))), F.lit("")))


def without_formulas(c: Column) -> Column:
    """Without the formulas as written, wherever they stand."""
    for x in WRITTEN_FORMULAS:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def matching_key(c: Column) -> Column:
    """Formulas dropped, then normalised."""
    return arabic.normalize(without_formulas(c))


def name_cases_folded(c: Column) -> Column:
    """Tokens without brackets, the cases of 'father of' as one."""
    # Three cases of a word.
    cases = F.create_map(*[F.lit(x) for pair in (("ابي", "ابو"), ("ابا", "ابو"), ("لابي", "ابو")) for x in pair])
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: (w != "") & ~w.isin("(", ")", "[", "]"))
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(cases, w), w)), " ")


def is_chain(c: Column, window: int = 120) -> Column:
    """Whether a text seems to open with a chain."""
    start = F.left(F.coalesce(c, F.lit("")), F.lit(window))
    return start.rlike(SIGNALS) | arabic.strip_tashkeel(start).rlike(SIGNALS)


def without_preamble(c: Column) -> Column:
    """Without a number and a preamble before the chain, whatever vowel marks they bear."""
    words = _any(MARKS.join(x) + MARKS for x in PREAMBLES)
    return F.regexp_replace(c, rf"^\s*(?:[0-9]+\s*[-–]\s*)?(?:{words})\s+", "")


def _marked(word: str) -> str:
    return MARKS.join(word) + MARKS


def chain_and_rest(c: Column, bare: bool = False) -> Column:
    """(chain, rest): a text up to the verb that ends its chain, and what follows; chain null if there is none.

    A chain that goes on after its verb is taken with all its parts. ``bare``
    also finds ends without vowel marks, or with others.
    """
    whole = rf"^.*? (?:{_any(ENDS)})(?:(?=[\s:،;]*{SAME_CHAIN_GOES_ON}\s).*? (?:{_any(ENDS)}))*"
    respect = r"^.*?\( عليهم? السلام \)"
    tries = [whole, respect] + ([rf"^.*? (?:{_any(map(_marked, ENDS_BARE))})"] if bare else [])
    chain = F.coalesce(*[F.nullif(F.regexp_extract(c, p, 0), F.lit("")) for p in tries])
    chain = F.when(is_chain(c), chain)
    return F.struct(chain.alias("chain"), F.when(chain.isNull(), c).otherwise(F.substr(c, F.length(chain) + 1)).alias("rest"))


def without_end(chain: Column) -> Column:
    """A chain without the verb that ends it; one that goes on without such a verb stays whole."""
    end = rf"(?:{_any(ENDS)})"
    goes_on = rf"[\s:،;]*{SAME_CHAIN_GOES_ON}\s"
    cut = rf"^(.*? {end}(?:(?={goes_on}).*? {end})*?)(?!{goes_on}).*$"
    upto = F.regexp_extract(chain, cut, 1)
    trimmed = F.regexp_replace(upto, rf" {end}$", "")
    return F.when((upto == "") | (trimmed == "") | chain.rlike(rf" {end}{goes_on}(?!.* {end})"), chain).otherwise(trimmed)


def chain_names(chain: Column, bare: bool = False) -> Column:
    """The names of a chain in order."""
    inner = without_end(chain)

    def names(c: Column, openers: list[str], between: list[str]) -> Column:
        between = [b.replace(" ", r"[:\s]+") for b in between]  # a colon may part the words
        return F.split(F.regexp_replace(c, rf"^(?:[0-9\s-]*|{_any(openers)})* ", ""), f" (?:{_any(between)}) ")

    found = names(inner, OPENERS, BETWEEN)
    if bare:
        found = F.when(F.size(found) > 1, found).otherwise(names(arabic.strip_tashkeel(inner), OPENERS_BARE, BETWEEN_BARE))
    return F.filter(found, lambda n: F.trim(n) != "")


def chain_parts(chain: Column, names: Column, base: str = "/people/narrators/") -> Column:
    """A chain as parts (kind, text, path): ``names`` (text, id) where they stand in order, linked if they have an id, and the text between; names that aren't found are passed over."""
    part = lambda kind, text, path: F.struct(kind.alias("kind"), text.alias("text"), path.alias("path"))
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<struct<kind:string,text:string,path:string>>")

    def add(acc: Column, n: Column) -> Column:
        at = F.position(n["text"], acc["left"])
        before = F.substring(acc["left"], F.lit(1), at - 1)
        plain = F.when(before != "", F.array(part(F.lit("plain"), before, none))).otherwise(empty)
        linked = part(F.when(n["id"].isNotNull(), "narrator").otherwise("plain"), n["text"], F.when(n["id"].isNotNull(), F.concat(F.lit(base), n["id"].cast("string"))))
        after = F.struct(F.substr(acc["left"], at + F.length(n["text"])).alias("left"), F.concat(acc["parts"], plain, F.array(linked)).alias("parts"), acc["missed"].alias("missed"))
        missed = F.struct(acc["left"].alias("left"), acc["parts"].alias("parts"), (acc["missed"] + 1).alias("missed"))
        return F.when(at > 0, after).otherwise(missed)

    start = F.struct(chain.alias("left"), empty.alias("parts"), F.lit(0).alias("missed"))
    return F.aggregate(names, start, add, lambda a: F.struct(F.when(a["left"] != "", F.concat(a["parts"], F.array(part(F.lit("plain"), a["left"], none)))).otherwise(a["parts"]).alias("parts"), a["missed"].alias("missed")))


def parts_if_all(chain: Column, names: Column) -> Column:
    """The same parts, but null unless every name is found in its turn."""
    made = chain_parts(chain, names)
    return F.when((made["missed"] == 0) & (F.size(names) > 0), made["parts"])


def chain_text(parts: Column) -> Column:
    """The chain that parts were made of; null without any text."""
    return F.nullif(F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""), F.lit(""))


# Letters and vowel marks in Latin script, the letters that the article takes on, and well-known names.
LETTERS = {
    "ا": "", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z", "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "'", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l", "م": "m", "ن": "n", "ه": "h", "و": "w", "ي": "y",
    "ة": "a", "ى": "a", "ء": "'", "أ": "a", "إ": "i", "ؤ": "'", "ئ": "'", "آ": "a", "ٱ": "a",
}
VOWELS = {"َ": "a", "ُ": "u", "ِ": "i", "ً": "an", "ٌ": "un", "ٍ": "in", "ّ": "", "ْ": ""}
SUN_LETTERS = "تثدذرزسشصضطظنل"
KNOWN = {
    "محمد": "Muhammad", "علي": "Ali", "حسن": "Hasan", "حسين": "Husayn", "جعفر": "Ja'far", "موسى": "Musa", "عيسى": "Isa", "يحيى": "Yahya", "ابراهيم": "Ibrahim", "اسماعيل": "Isma'il", "يعقوب": "Ya'qub", "يوسف": "Yusuf", "يونس": "Yunus", "سليمان": "Sulayman", "داود": "Dawud",
    "ابو": "Abu", "ابي": "Abi", "ابن": "Ibn", "بن": "ibn", "بنت": "bint", "ام": "Umm", "الله": "Allah", "رسول": "Rasul", "صادق": "Sadiq", "باقر": "Baqir", "كاظم": "Kazim", "رضا": "Rida", "هادي": "Hadi", "عسكري": "Askari", "مهدي": "Mahdi", "زيد": "Zayd", "زياد": "Ziyad", "عمر": "Umar", "عثمان": "Uthman",
    "احمد": "Ahmad", "سهل": "Sahl", "صالح": "Salih", "هشام": "Hisham", "حكم": "Hakam", "عده": "Idda", "اصحابنا": "Ashabina", "بصير": "Basir", "فضيل": "Fudayl", "منصور": "Mansur", "سنان": "Sinan", "حمزه": "Hamza", "جميله": "Jamila", "سالم": "Salim", "حمران": "Humran",
}
RESPECT = {"( عليه السلام )": "(a)", "( عليهم السلام )": "(a)", "( صلى الله عليه وآله )": "(s)", "( صلوات الله عليه )": "(s)", "( عليها السلام )": "(a)"}


def _spelled(c: Column) -> Column:
    """Letter by letter; a doubling mark repeats the letter that it follows."""
    c = F.regexp_replace(F.replace(c, F.lit(arabic.TATWEEL), F.lit("")), "(.)\u0651", "$1$1")
    each = LETTERS | VOWELS
    one = {a: b for a, b in each.items() if len(b) < 2}
    # A letter without a counterpart is at the end of the list, where translate drops it.
    order = sorted(one, key=lambda a: not one[a])
    c = F.translate(c, "".join(order), "".join(one[a] for a in order))
    for a, b in each.items():
        if len(b) > 1:
            c = F.replace(c, F.lit(a), F.lit(b))
    return c


def transliterated(c: Column) -> Column:
    """Names in Latin letters: known words by list, the article with its sun letters, the rest letter by letter; the first letter is a capital."""
    for a, b in RESPECT.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def word(w: Column) -> Column:
        bare = arabic.strip_tashkeel(w)
        folded = F.translate(bare, "أإآٱةى", "اااا" + "هي")
        stem = F.substr(folded, F.lit(3))
        sun = F.left(stem, F.lit(1)).isin(*SUN_LETTERS)
        article = F.concat(F.when(sun, F.concat(F.lit("a"), _spelled(F.left(stem, F.lit(1))))).otherwise("al"), F.lit("-"), _spelled(stem))
        named = F.coalesce(F.try_element_at(known, bare), F.try_element_at(known, folded), F.concat(F.lit("al-"), F.when(folded.startswith("ال"), F.try_element_at(known, stem))))
        return F.coalesce(named, F.when(folded.startswith("ال") & (stem != ""), article), _spelled(w))

    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    out = F.array_join(F.transform(words, word), " ")
    return F.concat(F.upper(F.left(out, F.lit(1))), F.substr(out, F.lit(2)))
