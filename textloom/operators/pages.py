"""Lexicon pages as nested entries, and the ordered segments of entries with mixed content."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from textloom.functions import arabic, markup

HEADWORDS = "array<struct<headword: string, summary: string, entries: array<struct<lexicon_id: string, lexicon: string, lexicon_ar: string, permalink: string, body_html: string, body: string>>>>"


@dataclass(frozen=True)
class Layout:
    """Where a lexicon's pages have what: ``name.class`` of each element."""

    # The classes of the dictionary site.
    container: str = "div.dictionary-entry-container"
    title: str = "h1.dictionary-entry-title"
    word: str = "dfn"
    summary: str = "div.description-of-entry"
    entry: str = "div.definition-container"
    lexicon: str = "dictionary_"
    credit: str = "div.credits"
    credit_ar: str = "span.ar"
    permalink: str = "div.sectionperma"
    body: str = "div.definition"


def _first(node: markup.Node | None, selector: str) -> markup.Node | None:
    return next(markup.found(node, selector), None) if node and selector else None


def _said(node: markup.Node | None, but: markup.Node | None = None) -> str:
    return markup.text(node, but) if node else ""


def _entry(node: markup.Node, at: Layout) -> dict:
    link = _first(_first(node, at.credit), "a")
    other = _first(link, at.credit_ar)
    body = _first(node, at.body) if at.body else node
    lexicon = next((k for k in node.attrs.get("class", "").split() if k.startswith(at.lexicon)), "")
    return {"lexicon_id": lexicon, "lexicon": _said(link, other), "lexicon_ar": _said(other), "permalink": _said(_first(node, at.permalink)), "body_html": markup.written(markup.walked(body)) if body else "", "body": _said(body)}


def headwords(c: Column, layout: Layout = Layout()) -> Column:
    """A page's headwords with their entries, in order, bodies as safe HTML and as text; none of a page without any, null of null.

    Every container with a title is a headword; a title without text is none.
    """

    def read(html: str | None) -> list[dict] | None:
        if html is None:
            return None
        out = []
        for box in markup.found(markup.tree(html), layout.container):
            title = _first(box, layout.title)
            word = _said(_first(title, layout.word) or title)
            if word:
                out.append({"headword": word, "summary": _said(_first(box, layout.summary)), "entries": [_entry(e, layout) for e in markup.found(box, layout.entry)]})
        return out

    return F.pandas_udf(lambda pages: pages.map(read), HEADWORDS)(c)


def lexicon_entries(pages: DataFrame, html_col: str, layout: Layout = Layout(), *keep: str) -> DataFrame:
    """A row for each entry: (keep, headword_pos, headword, summary, entry_pos, lexicon_id, lexicon, lexicon_ar, permalink, body_html, body); a headword without entries has one of nulls."""
    w = pages.select(*keep, F.posexplode(headwords(F.col(html_col), layout)).alias("headword_pos", "w"))
    return w.select(*keep, "headword_pos", "w.headword", "w.summary", F.posexplode_outer("w.entries").alias("entry_pos", "e")).select(*keep, "headword_pos", "headword", "summary", "entry_pos", "e.*")


SEGMENT = "entry int, attrs map<string,string>, around map<string,string>, pos int, name string, of map<string,string>, text string, inner map<string,string>"


class _Open:
    """An entry that is being read: the child that is open in it, and the text so far."""

    def __init__(self, ordinal: int, depth: int, attrs: dict, around: dict) -> None:
        self.ordinal, self.depth, self.attrs, self.around, self.n = ordinal, depth, attrs, around, 0
        self.start(None, {})

    def start(self, name: str | None, of: dict) -> None:
        self.name, self.of, self.said, self.inner = name, of, [], {}

    def segment(self) -> tuple | None:
        """What has been read since the last one; a child without text counts, blank text between children doesn't."""
        text = "".join(self.said).strip()
        if self.name is None and not text:
            return None
        self.n += 1
        return self.ordinal, self.attrs, self.around, self.n - 1, self.name, self.of, text, self.inner


@udtf(returnType=SEGMENT)
class MixedContent:
    """The segments of every element ``entry``: its own texts (``name`` null) and its children in order.

    ``around`` has the attribute ``n`` of the elements that hold the entry;
    ``inner`` the text with which each element inside a child begins. An entry
    within an entry is one of its own, and its text isn't the outer one's. For
    HTML, elements left open end with the entry or with the next block.
    """

    def eval(self, source: str, entry: str, xml: bool) -> Iterator[tuple]:
        if source is None:
            return
        entries: list[_Open] = []
        stack: list[tuple[str, str | None]] = []
        made = 0
        for e in markup.walked(markup.tree(source, xml)):
            now = entries[-1] if entries else None
            name = e.name.rpartition(":")[2] if e.kind != "text" else ""
            if e.kind == "text":
                if now:
                    now.said.append(e.name)
                    if now.name is not None and stack[-1][0] not in now.inner and e.name.strip():
                        now.inner[stack[-1][0]] = e.name.strip()
            elif e.kind == "open":
                if now and (len(stack) == now.depth or name == entry):
                    done = now.segment()
                    if done:
                        yield done
                    now.start(name if name != entry else None, dict(e.attrs))
                stack.append((name, e.attrs.get("n")))
                if name == entry:
                    entries.append(_Open(made, len(stack), dict(e.attrs), {k: n for k, n in stack[:-1] if n is not None}))
                    made += 1
            else:
                if now and (len(stack) == now.depth or len(stack) == now.depth + 1):
                    done = now.segment()
                    if done:
                        yield done
                    now.start(None, {})
                if now and len(stack) == now.depth:
                    entries.pop()
                stack.pop()


def segments(docs: DataFrame, markup_col: str, entry: str, *keep: str, xml: bool = False) -> DataFrame:
    """Rows of ``MixedContent`` for the markup of each row, beside the columns ``keep``."""
    read = MixedContent(F.col(markup_col).outer(), F.lit(entry.lower()), F.lit(xml))
    return docs.select(*keep, markup_col).lateralJoin(read).select(*keep, "entry", "attrs", "around", "pos", "name", "of", "text", "inner")


def dictionary_segments(docs: DataFrame, xml_col: str, *keep: str) -> DataFrame:
    """Segments of a dictionary in TEI: (keep, id, key, type, letter, root, headword, pos, kind, text, text_ar, n).

    Entries without an id are dropped. The headword is the transliterated form
    of the entry's first form; pages are numbers, other breaks are dropped.
    """
    rows = segments(docs, xml_col, "entryFree", *keep, xml=True).where(F.col("attrs")["id"].isNotNull())
    name, of = F.col("name"), F.col("of")
    foreign = (name == "orth") | (name == "foreign") & (of["lang"] == "ar")
    number = of["n"].try_cast("int")
    kind = F.when(name == "form", "form").when((name == "hi") & (of["rend"] == "ital"), "italic_en").when(foreign, "arabic").when(name == "quote", "quote").when(name == "pb", "page_break").otherwise("text")
    rows = rows.withColumn("kind", kind).withColumn("n", F.when(name == "pb", number))
    said = F.when(F.col("kind") == "arabic", F.col("inner")[name]).otherwise(F.col("text"))
    rows = rows.withColumn("text", said).where(((F.col("kind") == "page_break") & F.col("n").isNotNull()) | (F.col("kind") != "page_break") & (F.coalesce("text", F.lit("")) != ""))
    written = F.when(F.col("kind") == "arabic", arabic.buckwalter_to_arabic(F.col("text"))).when(F.col("kind") == "form", arabic.buckwalter_to_arabic(F.col("inner")["orth"]))
    got = {k: F.coalesce(F.col("attrs")[k], F.lit("")) for k in ("key", "type")}
    return rows.select(*keep, F.col("attrs")["id"].alias("id"), got["key"].alias("key"), got["type"].alias("type"), F.col("around")["div1"].alias("letter"), F.col("around")["div2"].alias("root"), "pos", "kind", "text", written.alias("text_ar"), "n")


def citation_codes(c: Column) -> Column:
    """Abbreviations in brackets, such as (S, K, Msb:), in order."""
    code = "[A-Z][A-Za-z]{0,5}"
    inside = F.regexp_extract_all(c, F.lit(rf"\(({code}(?:,\s*{code})*)\s*[,:]?\s*\)"), 1)
    return F.flatten(F.transform(inside, lambda x: F.split(x, r",\s*")))


def dictionary_entries(segments: DataFrame) -> DataFrame:
    """One row an entry: (id, key, type, letter, root, headword, body, source_refs, plain); ``plain`` is the body as one line, quotations in marks, page breaks left out.

    An id that stands in several places is one entry for each of them.
    """
    by = ["id", "key", "type", "letter", "root"]
    shown = F.when(F.col("kind") == "quote", F.concat(F.lit("'"), F.col("text"), F.lit("'"))).when(F.col("kind") == "arabic", F.coalesce("text_ar", "text")).when(F.col("kind").isin("text", "italic_en"), F.col("text"))
    rows = segments.withColumn("shown", shown).withColumn("codes", F.when(F.col("kind") == "text", citation_codes(F.col("text"))))
    part = F.struct("pos", "kind", "text", "text_ar", "n", "shown", "codes")
    e = rows.groupBy(*by).agg(F.min(F.when(F.col("kind") == "form", F.struct("pos", "text_ar"))).alias("form"), F.array_sort(F.collect_list(part)).alias("parts"))
    body = F.filter("parts", lambda p: p["kind"] != "form")
    refs = F.array_distinct(F.flatten(F.transform(F.filter("parts", lambda p: p["codes"].isNotNull()), lambda p: p["codes"])))
    plain = F.array_join(F.transform("parts", lambda p: p["shown"]), " ")
    return e.select(*by, F.coalesce("form.text_ar", F.lit("")).alias("headword"), F.transform(body, lambda p: F.struct(*[p[k].alias(k) for k in ("kind", "text", "text_ar", "n")])).alias("body"), refs.alias("source_refs"), plain.alias("plain"))
