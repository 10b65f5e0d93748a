"""Linking, resolving and graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.nested import jaccard
from textloom.functions.text import latin_tokens, tokens
from textloom.operators import graph, linking, merging, ordering, resolving
from textloom.plans.registry import query
from textloom.tables import table

WORDS = r"list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')"
QUOTES = rf"""
dw AS (SELECT doc_id, {WORDS} AS w FROM documents), bw AS (SELECT item_id, {WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM dw)),
bs AS (SELECT DISTINCT item_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 1)) AS i FROM bw WHERE len(w) >= 4)),
bn AS (SELECT item_id, count(*) AS n_passage FROM bs GROUP BY item_id),
q AS (SELECT doc_id, item_id, n_passage, count(*) AS n_shared FROM ds JOIN bs USING (s) JOIN bn USING (item_id) GROUP BY ALL HAVING count(*) >= 0.5 * n_passage)
"""


def _quotes(spark: SparkSession, sf: str) -> DataFrame:
    words = tokens(F.lower("text"))
    return linking.quotations(table(spark, sf, "documents"), table(spark, sf, "benchmark"), words, words, "doc_id", "item_id")


@query(f"WITH {QUOTES} SELECT doc_id, item_id, n_shared, n_passage, n_shared / n_passage AS score FROM q")
def quote_containment(spark: SparkSession, sf: str) -> DataFrame:
    return _quotes(spark, sf).select("doc_id", "item_id", "n_shared", "n_passage", "score")


@query(f"WITH {QUOTES} SELECT item_id, count(*) AS n_docs, min(doc_id) AS first_doc, sum(doc_id)::BIGINT AS sum_docs FROM q GROUP BY item_id")
def quote_inverse(spark: SparkSession, sf: str) -> DataFrame:
    docs = linking.inverse(_quotes(spark, sf), "doc_id", "item_id", "docs")
    summed = F.aggregate("docs", F.lit(0).cast("long"), lambda a, x: a + x)
    return docs.groupBy("item_id").agg(F.sum("n").alias("n_docs"), F.min(F.element_at("docs", 1)).alias("first_doc"), F.sum(summed).alias("sum_docs"))


@query(f"WITH {QUOTES} SELECT doc_id, item_id FROM q ANTI JOIN (SELECT doc_id FROM labels WHERE quality = 1) l USING (doc_id)")
def quote_not_known(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return linking.without_known(_quotes(spark, sf).select("doc_id", "item_id"), known, ["doc_id"])


#: A document's title is its first line.
TITLE = "list_filter(regexp_extract_all(lower(string_split(text, chr(10))[1]), '[a-z'']+'), lambda w: length(w) > 1)"


@query(rf"""
WITH d AS (SELECT doc_id, source, {TITLE} AS w FROM documents),
t AS (SELECT doc_id, source, len(w) AS length, x AS term, count(*) AS n FROM (SELECT doc_id, source, w, unnest(w) AS x FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
v AS (SELECT doc_id, source, term, n / length * (ln((SELECT count(*) FROM d) / (df + 1)) + 1) AS weight FROM t JOIN f USING (term)),
m AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM v GROUP BY doc_id),
u AS (SELECT doc_id, source, term, weight / norm AS weight FROM v JOIN m USING (doc_id)),
p AS (SELECT a.doc_id, b.doc_id AS other, round(sum(a.weight * b.weight), 6) AS similarity FROM u a JOIN u b ON a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, other) AS place FROM p WHERE similarity >= 0.3)
SELECT doc_id, other, similarity, place FROM r WHERE place <= 5
""")
def related_titles_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return linking.related(table(spark, sf, "documents"), "doc_id", "source", latin_tokens(title))


CHAINS = """
b AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT l_orderkey, string_agg(p_brand, '-' ORDER BY p_brand) AS key, count(*) AS length FROM b GROUP BY l_orderkey),
g AS (SELECT key, count(*) AS n_items, min(l_orderkey) AS first_item, max(l_orderkey) AS last_item FROM c WHERE length >= 3 GROUP BY key HAVING count(*) BETWEEN 2 AND 20)
"""


def _chains(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    held = brands.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("p_brand")).alias("brands"))
    chains = held.select("l_orderkey", F.array_join("brands", "-").alias("key"), F.size("brands").alias("length"))
    return linking.shared_chains(chains, "l_orderkey", "key", "length")


@query(f"WITH {CHAINS} SELECT * FROM g")
def shared_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _chains(spark, sf).select("key", "n_items", F.element_at("items", 1).alias("first_item"), F.element_at("items", -1).alias("last_item"))


@query(f"WITH {CHAINS} SELECT a.l_orderkey AS item, count(DISTINCT b.l_orderkey) AS n_related, min(b.l_orderkey) AS first_related FROM c a JOIN g USING (key) JOIN c b USING (key) WHERE a.l_orderkey <> b.l_orderkey GROUP BY 1")
def chain_relations(spark: SparkSession, sf: str) -> DataFrame:
    related = linking.co_members(_chains(spark, sf))
    return related.select("item", F.size("related").cast("long").alias("n_related"), F.element_at("related", 1).alias("first_related"))


@query("""
WITH n AS (SELECT c_custkey, c_name AS name FROM customer), s AS (SELECT s_suppkey, s_name AS name FROM supplier),
e AS (SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM n JOIN s USING (name) GROUP BY 1),
f AS (SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM n JOIN s ON regexp_replace(lower(n.name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(s.name), '[^a-z0-9]', '', 'g') GROUP BY 1),
d AS (SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM n JOIN s ON ltrim(regexp_replace(n.name, '[^0-9]', '', 'g'), '0') = ltrim(regexp_replace(s.name, '[^0-9]', '', 'g'), '0') WHERE ltrim(regexp_replace(n.name, '[^0-9]', '', 'g'), '0') <> '' GROUP BY 1)
SELECT c_custkey, coalesce(e.s_suppkey, f.s_suppkey, d.s_suppkey) AS s_suppkey, CASE WHEN e.s_suppkey IS NOT NULL THEN 'exact' WHEN f.s_suppkey IS NOT NULL THEN 'folded' WHEN d.s_suppkey IS NOT NULL THEN 'digits' ELSE 'none' END AS stage
FROM n LEFT JOIN e USING (c_custkey) LEFT JOIN f USING (c_custkey) LEFT JOIN d USING (c_custkey)
""")
def cascade_resolve(spark: SparkSession, sf: str) -> DataFrame:
    fold = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    digits = lambda c: F.ltrim(F.regexp_replace(c, "[^0-9]", ""), F.lit("0"))
    a, b = F.col("c_name"), F.col("s_name")
    keys = [("exact", a, b), ("folded", fold(a), fold(b)), ("digits", digits(a), digits(b))]
    return resolving.cascade(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", table(spark, sf, "supplier").select("s_suppkey", "s_name"), keys, "s_suppkey", [F.col("s_suppkey")])


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part), m AS (SELECT p_name AS title FROM n),
s AS (SELECT p_name, title, round(1 - levenshtein(p_name, title) / greatest(length(p_name), length(title)), 6) AS similarity FROM n JOIN m ON p_name <> title),
r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY similarity DESC, title) AS place FROM s WHERE similarity >= 0.6)
SELECT p_name, title, similarity, place FROM r WHERE place <= 5
""")
def fuzzy_names(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select("p_name").distinct()
    found = resolving.fuzzy(names, names.withColumnRenamed("p_name", "title"), "p_name", "title", threshold=0.6, top=6)
    return found.where("p_name <> title").select("p_name", "title", "similarity", (F.col("place") - 1).alias("place"))


@query("""
WITH e AS (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
SELECT least(event_type, nxt) AS a, greatest(event_type, nxt) AS b, count(*) AS weight FROM e WHERE nxt IS NOT NULL AND nxt <> event_type GROUP BY 1, 2
""")
def cooccurrence_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.neighbour_edges(table(spark, sf, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type")


@query("""
WITH e AS (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events),
p AS (SELECT event_type AS a, nxt AS b, count(*) AS n FROM e WHERE nxt IS NOT NULL AND nxt <> event_type GROUP BY 1, 2)
SELECT node, sum(o)::BIGINT AS n_out, sum(i)::BIGINT AS n_in FROM (SELECT a AS node, n AS o, 0 AS i FROM p UNION ALL SELECT b, 0, n FROM p) GROUP BY node
""")
def transmission_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(graph.directed_edges(table(spark, sf, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type"))


@query("""
WITH RECURSIVE d AS (SELECT doc_id, md5(text) AS h, n_chars || '/' || lang || '/' || source AS k FROM documents),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM (SELECT h, min(doc_id) AS doc_id FROM d GROUP BY h) a JOIN d b USING (h) UNION SELECT a.doc_id, b.doc_id FROM (SELECT k, min(doc_id) AS doc_id FROM d GROUP BY k) a JOIN d b USING (k)),
s AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(n, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT s.y, r.c FROM r JOIN s ON s.x = r.n)
SELECT n AS doc_id, min(c) AS component FROM r GROUP BY n
""")
def components(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    keys = F.array(F.md5("text"), F.concat_ws("/", F.col("n_chars").cast("string"), "lang", "source"))
    return graph.clusters(d.select("doc_id", F.explode(keys).alias("key")), "doc_id", "key").select("doc_id", "component")


@query("""
WITH w AS (SELECT doc_id, lang, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS s FROM documents),
p AS (SELECT doc_id, s, lead(doc_id) OVER o AS other, lead(s) OVER o AS t FROM w WINDOW o AS (PARTITION BY lang ORDER BY doc_id))
SELECT doc_id, other, len(list_intersect(s, t)) / (len(s) + len(t) - len(list_intersect(s, t))) AS jaccard FROM p WHERE other IS NOT NULL
""".replace("\\\\", "\\"))
def jaccard_pairs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    pairs = ordering.next_keys(d, ["lang"], "doc_id").where("next is not null")
    sets = d.select("doc_id", F.array_distinct(tokens(F.lower("text"))).alias("s"))
    met = pairs.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("next"), F.col("s").alias("t")), "next")
    return met.select("doc_id", F.col("next").alias("other"), jaccard(F.col("s"), F.col("t")).alias("jaccard"))


@query("""
WITH n AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (0, 1, 2))
SELECT c_mktsegment, count(c_nationkey) AS checked, count_if(c_nationkey IS NOT NULL AND n_nationkey IS NULL)::BIGINT AS broken, count_if(c_nationkey IS NULL)::BIGINT AS without
FROM customer LEFT JOIN n ON c_nationkey = n_nationkey GROUP BY 1
""")
def fk_audit(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").where("n_regionkey in (0, 1, 2)")
    return merging.broken_links(table(spark, sf, "customer"), "c_nationkey", nations, "n_nationkey", ["c_mktsegment"])


@query("SELECT doc_id, lang, source FROM documents d ANTI JOIN labels USING (doc_id) WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.item_id = d.doc_id)")
def resume_queue(spark: SparkSession, sf: str) -> DataFrame:
    quarantined = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"))
    return merging.remaining(table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), quarantined, "doc_id")


@query("""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY text) AS n FROM documents)
SELECT min(doc_id) AS first_doc, max(CASE WHEN k = n THEN doc_id END) AS winner, count(*) AS n FROM p WHERE n > 1 GROUP BY text
""")
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = resolving.duplicate_ends(table(spark, sf, "documents"), F.col("text"), "doc_id")
    return groups.select(F.col("first").alias("first_doc"), F.col("last").alias("winner"), "n")
