"""Wikitext and Markdown as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITE = " \n\t\r"


def _pieces(c: Column, opening: str) -> tuple[Column, Column]:
    """What stands before the first ``opening``, and what follows each."""
    parts = F.split(F.coalesce(c, F.lit("")), rf"\Q{opening}\E")
    return parts[0], F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _after(piece: Column, closing: str) -> Column:
    """What follows the first ``closing``; nothing without one."""
    return F.when(F.instr(piece, closing) > 0, F.substr(piece, F.instr(piece, closing) + len(closing)))


def with_links(c: Column, shown: bool = True, dropped: tuple[str, ...] = ()) -> Column:
    """Each [[link]] as the text that a reader sees, which follows its last bar; links into the name spaces ``dropped`` go. A link without an end stays as it is."""
    lead, links = _pieces(c, "[[")

    def read(piece: Column) -> Column:
        inside, rest = F.substring_index(piece, "]]", 1), _after(piece, "]]")
        space = F.lower(F.trim(F.substring_index(inside, ":", 1)))
        gone = inside.contains(":") & space.isin(*dropped) if dropped else F.lit(False)
        kept = F.substring_index(inside, "|", -1) if shown else F.concat(F.lit("[["), inside, F.lit("]]"))
        return F.when(rest.isNull(), F.concat(F.lit("[["), piece)).when(gone, rest).otherwise(F.concat(kept, rest))

    return F.when(c.isNotNull(), F.concat(lead, F.array_join(F.transform(links, read), "")))


def without_markup(c: Column) -> Column:
    """Links as their text, without the runs of apostrophes that mean bold and italics."""
    return F.trim(F.replace(F.replace(with_links(c), F.lit("'''"), F.lit("")), F.lit("''"), F.lit("")))


def infobox_field(c: Column, *names: str) -> Column:
    """The value of the first of these fields that says something, markup dropped; null if none does."""
    lines = F.split(c, r"\|(?=[^\n=|\]]*=)|\n")
    out = []
    for n in names:
        named = F.filter(lines, lambda x: F.lower(F.trim(F.substring_index(x, "=", 1))) == n.lower())  # noqa: B023
        value = without_markup(F.trim(_after(F.get(named, F.lit(0)), "="), F.lit(_WHITE)))
        out.append(F.when((value != "") & ~F.lower(value).isin("unknown", "n/a"), value))
    return F.coalesce(*out)


# Fields that a grade stands in, what grades are called, and the words that tell them.
GRADE_FIELDS = ["Reliability", "Grade", "Status", "Authenticity"]
GRADES = {"Thiqah (Trustworthy)": ["thiqa", "thiqah", "trustworthy", "trustworthiness"], "Da'if (Weak)": ["da'if", "da`if"], "Majhul (Unknown)": ["majhul"], "Muwaththaq (Reliable)": ["muwathaq", "muwaththaq"], "Hasan (Good)": ["hasan"]}
#: One of these must follow "hasan" in its line, which is a name, too.
GRADED = ["narrator", "hadith", "tradition"]


def reliability(c: Column) -> Column:
    """The grade that a field gives, else the first grade of the list that a word of the text tells."""
    words = F.transform(F.split(F.lower(c), "[^a-z'`]+"), lambda w: F.trim(w, F.lit("'`")))
    good = F.exists(F.split(F.lower(c), "\n"), lambda line: F.greatest(*[F.instr(_after(line, "hasan"), w) for w in GRADED]) > 0)
    told = [F.when(F.arrays_overlap(words, F.array(*map(F.lit, ws))) & (good if name.startswith("Hasan") else F.lit(True)), name) for name, ws in GRADES.items()]
    return F.coalesce(infobox_field(c, *GRADE_FIELDS), *told)


def listed_names(c: Column, *fields: str) -> Column:
    """The names in a field, parted by commas, semicolons or line breaks; marks of lists are dropped."""
    value = F.translate(F.coalesce(infobox_field(c, *fields), F.lit("")), "،;\n", ",,,")
    parts = F.split(F.regexp_replace(value, "(?i)<br[ /]*>", ","), ",")
    return F.filter(F.transform(parts, lambda x: F.trim(F.ltrim(F.trim(x), F.lit("*- ")))), lambda x: x != "")


def without_templates(c: Column) -> Column:
    """Without what stands in {{ }}, nested ones included."""
    pieces = F.regexp_extract_all(c, F.lit(r"(?s)(\{\{|\}\}|[^{}]+|[{}])"), 1)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        depth = F.when(x == "{{", acc["depth"] + 1).when(x == "}}", F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        kept = F.when((acc["depth"] == 0) & ~x.isin("{{", "}}"), F.concat(acc["kept"], F.array(x))).otherwise(acc["kept"])
        return F.struct(depth.alias("depth"), kept.alias("kept"))

    return F.aggregate(pieces, start, step, lambda a: F.array_join(a["kept"], ""))


def without_notes(c: Column) -> Column:
    """Without <ref> notes and without tags; a tag without an end stays."""
    lead, notes = _pieces(c, "<ref")
    alone = lambda p: F.substring_index(p, ">", 1).endswith("/")
    kept = F.transform(notes, lambda p: F.coalesce(F.when(alone(p), _after(p, ">")), _after(p, "</ref>"), F.lit("")))
    lead, tags = _pieces(F.concat(lead, F.array_join(kept, "")), "<")
    return F.concat(lead, F.array_join(F.transform(tags, lambda p: F.coalesce(_after(p, ">"), F.concat(F.lit("<"), p))), ""))


def summary(c: Column, least: int = 50, most: int = 1000) -> Column:
    """The first paragraph that is more than a heading, at most ``most`` characters; null without one."""
    clean = with_links(without_templates(c), False, ("category", "file", "image"))
    plain = lambda p: F.trim(without_notes(without_markup(p)), F.lit(_WHITE))
    fit = F.filter(F.transform(F.split(clean, "\n\n"), plain), lambda t: (F.length(t) > least) & ~t.startswith("=="))
    return F.left(F.try_element_at(fit, F.lit(1)), F.lit(most))


def _inline(text: Column) -> Column:
    """Emphasis, code and links of a line of text; what stands in code is left alone, and all else is escaped.

    The text is parted at its backticks: odd parts with an end are code. A
    star opens emphasis only before, and ends it only behind, a character that
    isn't blank. Links go to web addresses and to places of the same site.
    """
    escaped = F.replace(F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    parts = F.split(escaped, "`")

    def shown(part: Column, i: Column) -> Column:
        for pattern, new in ((r"\*\*(?=\S)([^*]+?)(?<=\S)\*\*", "<strong>$1</strong>"), (r"\*(?=\S)([^*]+?)(?<=\S)\*", "<em>$1</em>"), (r"\[([^\]]+)\]\(((?:https?://|[/#])[^)\s]*)\)", '<a href="$2">$1</a>')):
            plain = F.regexp_replace(part if pattern.startswith(r"\*\*") else plain, pattern, new)  # noqa: F821
        code = (i % 2 == 1) & (i + 1 < F.size(parts))
        return F.when(code, F.concat(F.lit("<code>"), part, F.lit("</code>"))).when(i % 2 == 1, F.concat(F.lit("`"), plain)).otherwise(plain)

    return F.array_join(F.transform(parts, shown), "")


# Fenced blocks that become marked divs.
LANGUAGES = {"arabic": ' lang="ar" dir="rtl"', "english": "", "urdu": ' lang="ur" dir="rtl"'}


def markdown(c: Column) -> Column:
    """A subset of Markdown as HTML: headings, emphasis, code, links, lists and paragraphs; fenced blocks in named languages become marked divs, others preformatted text. All text is escaped."""
    # Blank lines inside a fence don't part blocks.
    lead, fences = _pieces(c, "```")
    odd = lambda i: i % 2 == 0  # noqa: E731  the first piece behind the lead is inside
    held = F.concat(lead, F.array_join(F.transform(fences, lambda p, i: F.concat(F.when(odd(i), "\n\n```").otherwise("\n\n"), F.when(odd(i), F.replace(p, F.lit("\n\n"), F.lit("\n\u0001\n"))).otherwise(p))), ""))
    blocks = F.filter(F.transform(F.split(held, r"\n[ \t]*\n"), lambda x: F.trim(x, F.lit(" \n"))), lambda x: x != "")

    def fenced(x: Column) -> Column:
        name = F.trim(F.substring_index(F.substr(x, F.lit(4)), "\n", 1))
        inside = F.replace(F.trim(F.coalesce(_after(x, "\n"), F.lit("")), F.lit("\n")), F.lit("\u0001"), F.lit(""))
        text = F.replace(F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        out = F.concat(F.lit("<pre>"), text, F.lit("</pre>"))
        for k, attributes in LANGUAGES.items():
            out = F.when(name == k, F.concat(F.lit(f'<div class="tafsir-{k}"{attributes}>'), text, F.lit("</div>"))).otherwise(out)
        return out

    def listed(x: Column, tag: str, mark: str) -> Column:
        items = F.transform(F.split(x, "\n"), lambda line: F.concat(F.lit("<li>"), _inline(F.regexp_replace(line, mark, "")), F.lit("</li>")))
        return F.concat(F.lit(f"<{tag}>\n"), F.array_join(items, "\n"), F.lit(f"\n</{tag}>"))

    def block(x: Column) -> Column:
        level = F.length(F.regexp_extract(x, "^(#{1,6}) ", 1)).cast("string")
        return (
            F.when(x.startswith("```"), fenced(x))
            .when(x.rlike("^#{1,6} "), F.concat(F.lit("<h"), level, F.lit(">"), _inline(F.regexp_replace(x, "^#{1,6} ", "")), F.lit("</h"), level, F.lit(">")))
            .when(x.rlike(r"^[*-]\s+"), listed(x, "ul", r"^[*-]\s+"))
            .when(x.rlike(r"^[0-9]+\.\s+"), listed(x, "ol", r"^[0-9]+\.\s+"))
            .otherwise(F.concat(F.lit("<p>"), _inline(x), F.lit("</p>")))
        )

    return F.array_join(F.transform(blocks, block), "\n")
