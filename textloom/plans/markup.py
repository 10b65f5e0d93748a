"""Queries of markup: safe pages, lexicon entries, segments of mixed content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.operators import pages
from textloom.plans.registry import query
from textloom.tables import table


def _plain(c: str) -> str:
    """References resolved; the tables have these only."""
    for name, sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        c = f"replace({c}, '&{name};', '{sign}')"
    return c


def _escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(rf"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<(meta|link)[^>]*>', '', 'g'), '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(h, '</?(html|head|title|body|nav|article|h1|footer)(\s[^>]*)?>', '', 'g') AS h FROM a),
c AS (SELECT page_id, regexp_extract_all(h, '<[^>]*>|[^<]+') AS pieces FROM b)
SELECT page_id, trim(regexp_replace(array_to_string([CASE WHEN x[1] = '<' THEN x ELSE {_escaped(_plain("x"))} END FOR x IN pieces], ''), '\s{{2,}}', ' ', 'g')) AS safe FROM c
""")
def safe_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", markup.safe_html(F.col("html")).alias("safe"))


#: The tables' pages as a lexicon: an article is a headword's, its paragraphs are the entries.
ARTICLES = pages.Layout(container="article", title="h1", word="", summary="h1", entry="p", credit="", credit_ar="", permalink="", body="")
ARTICLE = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
PARAGRAPH = "<p>((?:[^<]|</?b>|<br>)*)"


@query(rf"""
WITH a AS (SELECT page_id, {ARTICLE} AS h FROM pages),
p AS (SELECT page_id, trim({_plain("regexp_extract(h, '<h1>([^<]*)</h1>', 1)")}) AS headword, unnest(regexp_extract_all(h, '{PARAGRAPH}', 1)) AS p, generate_subscripts(regexp_extract_all(h, '{PARAGRAPH}', 1), 1) - 1 AS entry_pos FROM a)
SELECT page_id, headword, entry_pos::INTEGER AS entry_pos, trim({_escaped(_plain("regexp_replace(p, '</?b>|<br>', '', 'g')"))}) AS said,
       array_to_string(list_filter([trim({_plain("x")}) FOR x IN regexp_split_to_array(p, '</?b>|<br>')], lambda x: x <> ''), ' ') AS body, contains(p, '<b>') AS bold
FROM p WHERE headword <> ''
""")
def page_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Headwords with nested entries, one row an entry; the safe body without its marks, to be read by SQL."""
    e = pages.lexicon_entries(table(spark, sf, "pages"), "html", ARTICLES, "page_id")
    bare = F.trim(F.regexp_replace("body_html", "</?b>|<br>", ""))
    return e.select("page_id", "headword", "entry_pos", bare.alias("said"), "body", F.col("body_html").contains("<b>").alias("bold"))


@query(rf"""
WITH a AS (SELECT page_id, {ARTICLE} AS h FROM pages),
c AS (SELECT page_id, regexp_extract_all(h, '<(?:h1|p)>(?:[^<]|</?b>|<br>)*') AS cs FROM a),
x AS (SELECT page_id, unnest(cs) AS x, generate_subscripts(cs, 1) - 1 AS pos FROM c)
SELECT page_id, pos::INTEGER AS pos, regexp_extract(x, '^<(\w+)>', 1) AS name, trim({_plain("regexp_replace(x, '<[^>]*>', '', 'g')")}) AS text, contains(x, '<b>') AS has_bold FROM x
""")
def page_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The ordered children of every article."""
    s = pages.segments(table(spark, sf, "pages"), "html", "article", "page_id")
    return s.select("page_id", "pos", "name", "text", F.map_contains_key("inner", "b").alias("has_bold"))


def as_dictionary(turns: DataFrame) -> DataFrame:
    """(part, xml): conversations written as dictionary entries, one document for those whose ids agree but for the last digits; every turn is a segment of its role's kind."""
    said = F.replace(F.replace(F.replace(F.trim(F.coalesce("text", F.lit("")), F.lit(" \n\t\r\x0b\f")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    piece = F.when(F.col("role") == "user", F.concat(F.lit('<hi rend="ital">'), said, F.lit("</hi>"))).when(F.col("role") == "system", F.concat(F.lit("<quote>"), said, F.lit("</quote>"))).otherwise(said)
    page = F.concat(F.lit('<pb n="'), F.col("turn").cast("string"), F.lit('"/>'))
    one = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(page, piece).alias("x")))).alias("xs"))
    head = F.concat(F.lit('<entryFree id="n'), F.col("conv_id").cast("string"), F.lit('" key="k" type="main"><form><orth lang="ar">qAl</orth></form>'))
    entry = F.concat(head, F.array_join(F.transform("xs", lambda x: x["x"]), " "), F.lit("</entryFree>"))
    book = one.select(F.floor(F.col("conv_id") / 20).alias("part"), "conv_id", entry.alias("e")).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("conv_id", "e"))).alias("es"))
    body = F.array_join(F.transform("es", lambda x: x["e"]), "\n")
    return book.select("part", F.concat(F.lit('<TEI.2><text><div1 n="q"><div2 n="'), F.col("part").cast("string"), F.lit('">'), body, F.lit("</div2></div1></text></TEI.2>")).alias("xml"))


_CODES = r"flatten([string_split_regex(c, ',\s*') FOR c IN regexp_extract_all(t, '\(([A-Z][A-Za-z]{0,5}(?:,\s*[A-Z][A-Za-z]{0,5})*)\s*[,:]?\s*\)', 1)])"


@query(rf"""
WITH t AS (SELECT conv_id, turn, role, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM conversations),
s AS (SELECT *, {_CODES} AS codes FROM t WHERE t <> ''),
g AS (SELECT conv_id, string_agg(CASE role WHEN 'system' THEN '''' || t || '''' ELSE t END, ' ' ORDER BY turn) AS plain, list(turn || ':' || CASE role WHEN 'user' THEN 'italic_en' WHEN 'system' THEN 'quote' ELSE 'text' END ORDER BY turn) AS kinds,
        flatten(list(codes ORDER BY turn) FILTER (role NOT IN ('user', 'system'))) AS codes FROM s GROUP BY conv_id),
n AS (SELECT conv_id, count(*) AS n_pages FROM t GROUP BY conv_id)
SELECT 'n' || conv_id AS id, (conv_id // 20)::VARCHAR AS root, 'قال' AS headword, coalesce(plain, '') AS plain, coalesce(array_to_string(kinds, ' '), '') AS kinds, n_pages,
       coalesce(array_to_string([c FOR c, i IN codes IF list_position(codes, c) = i], ','), '') AS refs
FROM n LEFT JOIN g USING (conv_id)
""")
def dictionary_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations written as dictionary entries and read again: bodies in order, page breaks, codes of sources."""
    e = pages.dictionary_entries(pages.dictionary_segments(as_dictionary(table(spark, sf, "conversations")), "xml"))
    # Each segment follows its page break.
    start = F.struct(F.lit("").alias("page"), F.array().cast("array<string>").alias("kinds"))
    step = lambda a, p: F.when(p["kind"] == "page_break", F.struct(p["n"].cast("string").alias("page"), a["kinds"].alias("kinds"))).otherwise(F.struct(a["page"].alias("page"), F.concat(a["kinds"], F.array(F.concat(a["page"], F.lit(":"), p["kind"]))).alias("kinds")))
    kinds = F.aggregate("body", start, step, lambda a: F.array_join(a["kinds"], " "))
    n_pages = F.size(F.filter("body", lambda p: p["kind"] == "page_break")).cast("long")
    return e.select("id", "root", "headword", "plain", kinds.alias("kinds"), n_pages.alias("n_pages"), F.array_join("source_refs", ",").alias("refs"))
