"""Window, tree, positional and incremental queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import tokens
from textloom.operators import merging, nesting, ordering
from textloom.plans.registry import query
from textloom.tables import table


@query("""
WITH t AS (SELECT r_regionkey AS region, n_nationkey AS nation, c_custkey AS customer, c_acctbal > 0 AS counted FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT region, nation, customer, row_number() OVER (PARTITION BY region, nation ORDER BY customer) AS local_index,
       CASE WHEN counted THEN (count_if(counted) OVER (ORDER BY region, nation, customer))::BIGINT END AS index,
       lag(customer) OVER (PARTITION BY region, nation ORDER BY customer) AS prev, lead(customer) OVER (PARTITION BY region, nation ORDER BY customer) AS next
FROM t
""")
def hier_numbering(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("r_regionkey").alias("region"), F.col("n_nationkey").alias("nation"), F.col("c_custkey").alias("customer"), (F.col("c_acctbal") > 0).alias("counted"))
    rows = ordering.siblings(rows, ["region", "nation"], [F.col("customer")], "customer")
    rows = ordering.running_number(rows, ["region", "nation"], [F.col("customer")], F.col("counted"), [F.col("region"), F.col("nation")])
    return rows.select("region", "nation", "customer", "local_index", "index", "prev", "next")


@query("""
SELECT conv_id, turn, role, row_number() OVER w AS local_index, lag(role) OVER w AS prev, lead(role) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def turn_nav(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.siblings(table(spark, sf, "conversations"), ["conv_id"], [F.col("turn")], "role").select("conv_id", "turn", "role", "local_index", "prev", "next")


@query("""
WITH o AS (SELECT o_orderpriority, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS before FROM orders)
SELECT o_orderpriority, o_orderkey AS after, before, before - o_orderkey - 1 AS missing FROM o WHERE before > o_orderkey + 1
""")
def sequence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.sequence_gaps(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderkey")


@query("""
WITH e AS (SELECT user_id, event_type, row_number() OVER w AS pos, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM e)
SELECT user_id, run::BIGINT AS run, event_type, count(*) AS n, min(pos) AS first FROM r GROUP BY ALL
""")
def run_length_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.runs(table(spark, sf, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type")


@query(r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents),
t AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS position FROM d),
b AS (SELECT DISTINCT unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS word FROM benchmark),
r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id, position) AS place FROM t SEMI JOIN b USING (word))
SELECT word, doc_id, position, array_to_string(w[greatest(position - 10, 0) + 1 : position + 11], ' ') AS context, place FROM r WHERE place <= 3
""")
def context_windows(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    wanted = table(spark, sf, "benchmark").select(F.explode(tokens(F.col("text"))).alias("word"))
    return ordering.context_windows(docs, "doc_id", tokens(F.col("text")), wanted)


@query("""
WITH r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY md5('sample:' || doc_id), doc_id) AS place FROM documents) SELECT * FROM r WHERE place <= 3
""")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 3)


@query("""
WITH t AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY md5(doc_id::VARCHAR), doc_id) AS turn FROM documents),
r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang ORDER BY turn, source, doc_id) AS place FROM t) SELECT * FROM r WHERE place <= 15
""")
def round_robin_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.round_robin(table(spark, sf, "documents").select("doc_id", "lang", "source"), "lang", "source", "doc_id", 15)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100")
def range_slice(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.range_slice(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 101, 150)


@query("""
WITH a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations WHERE role = 'user'),
b AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations WHERE role = 'assistant')
SELECT conv_id, position, a.turn AS left, b.turn AS right FROM a FULL JOIN b USING (conv_id, position)
""")
def positional_merge(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations")
    return merging.zip_positions(said.where("role = 'user'"), said.where("role = 'assistant'"), ["conv_id"], "turn", "turn")


@query("""
SELECT doc_id, CASE WHEN c.doc_id IS NULL THEN 'all' WHEN c.n_chars <> d.n_chars THEN 'n_chars' WHEN c.lang <> d.lang THEN 'lang' ELSE 'none' END AS recompute
FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS lang FROM documents SEMI JOIN labels USING (doc_id)) c USING (doc_id)
""")
def staleness_plan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    cached = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi").withColumns({"n_chars": F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")), "lang": F.when(F.col("doc_id") % 7 == 0, F.lit("xx")).otherwise(F.col("lang"))})
    return merging.staleness(docs, cached, "doc_id", ["n_chars", "lang"])


@query("SELECT user_id, count(*) AS n_failures, arg_max(event_type, {'at': ts, 'e': event_type}) AS last_error FROM events WHERE value < 20 GROUP BY user_id HAVING count(*) >= 3")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    failures = table(spark, sf, "events").where("value < 20").select("user_id", F.col("event_type").alias("error"), F.col("ts").alias("at"))
    return merging.dead_letters(failures, "user_id")


@query("""
WITH n AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(o_orderkey, -1) AS last_order FROM customer LEFT JOIN n ON o_custkey = c_custkey
""")
def latest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    last = merging.latest(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderkey")]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"))
    last = last.join(table(spark, sf, "customer"), "c_custkey", "left_semi")
    return merging.upsert(table(spark, sf, "customer").select("c_custkey", F.lit(-1).cast("long").alias("last_order")), last, ["c_custkey"])


@query("""
SELECT source, l.lang, count(CASE WHEN d.lang = l.lang THEN 1 END) AS n_there, count(CASE WHEN d.lang <> l.lang THEN 1 END) AS n_holes, max(CASE WHEN d.lang = l.lang THEN n_chars END) AS most
FROM documents d CROSS JOIN (VALUES ('de'), ('en'), ('es'), ('fr')) l(lang) GROUP BY ALL
""")
def split_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return nesting.lang_counts(table(spark, sf, "documents"), "source", "lang", "n_chars", ["de", "en", "es", "fr"])


@query("""
SELECT r_name AS book, count(DISTINCT n_nationkey) AS n_chapters, count(*) AS n_verses, min(c_custkey) AS first_verse
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def nested_books(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nesting.book_counts(rows.select(F.col("r_name").alias("book"), F.col("n_nationkey").alias("chapter"), F.col("c_custkey").alias("verse")))
