"""Queries of lexicon pages, merged answers, phrases, search and chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import latin_tokens
from textloom.operators import chapters, counting, documents, lexicon, matching, search
from textloom.plans.registry import ORACLE, query
from textloom.tables import spread, stage, table

SPELT = "spelt AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) END AS word, min(p_type) AS gloss, count(*) AS n FROM part WHERE p_size > 25 GROUP BY 1)"


def _spelt(spark: SparkSession, sf: str) -> DataFrame:
    word = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name"))
    return table(spark, sf, "part").where("p_size > 25").groupBy(word.alias("word")).agg(F.min("p_type").alias("gloss"), F.count("*").alias("n"))


@query(f"""
WITH {SPELT}, f AS (SELECT lower(word) AS fold, arg_min(gloss, word) AS gloss, arg_min(n, word) AS n FROM spelt GROUP BY 1)
SELECT p_partkey, coalesce(s.gloss, f.gloss) AS gloss, coalesce(s.n, f.n) AS n, CASE WHEN s.word IS NOT NULL THEN 'exact' WHEN f.fold IS NOT NULL THEN 'folded' ELSE 'none' END AS found
FROM part LEFT JOIN spelt s ON s.word = p_name LEFT JOIN f ON f.fold = lower(p_name)
""")
def lexicon_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    return lexicon.lookup(rows, F.col("p_name"), _spelt(spark, sf), "word", F.lower("p_name"), F.lower("word"), ["gloss", "n"]).drop("p_name")


@query(f"WITH {SPELT} SELECT lower(word) AS key, sum(n)::BIGINT AS n, count(DISTINCT word) AS n_items, min(word) AS first_item FROM spelt GROUP BY 1")
def lexicon_folded_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.folded_counts(_spelt(spark, sf), F.lower("word"), "n", "word")


@query(f"WITH {SPELT} SELECT lower(word) AS key, string_agg(word || ',' || gloss, ',' ORDER BY word) AS entry FROM spelt GROUP BY 1")
def lexicon_folded_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = _spelt(spark, sf).withColumn("entry", F.array("word", "gloss"))
    return lexicon.folded_lists(rows, F.lower("word"), "entry", "word").select("key", F.array_join("entry", ",").alias("entry"))


@query("""
WITH n AS (SELECT p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), f AS (SELECT DISTINCT p_brand, p_name FROM part),
t AS (SELECT p_brand, min(p_type) AS type FROM part GROUP BY 1), s AS (SELECT p_brand, min(p_size) AS size FROM part WHERE p_size > 45 GROUP BY 1)
SELECT p_brand, count(*) AS n_forms, coalesce(sum(n), 0)::BIGINT AS n, count(n) AS n_seen, min(type) AS type, min(size) AS size FROM f LEFT JOIN n USING (p_name) LEFT JOIN t USING (p_brand) LEFT JOIN s USING (p_brand) GROUP BY 1
""")
def lexicon_pages(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    sold = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    counts = sold.groupBy("p_name").agg(F.count("*").alias("n"))
    return lexicon.pages(part, "p_brand", "p_name", counts, {"type": (part, "p_type"), "size": (part.where("p_size > 45"), "p_size")})


@query("""
WITH l AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS k FROM l)
SELECT p_brand, count(*) AS n_lemmas, sum(n)::BIGINT AS n, string_agg(p_name, ' ' ORDER BY k) FILTER (k <= 3) AS top FROM r GROUP BY 1
""")
def lexicon_roots(spark: SparkSession, sf: str) -> DataFrame:
    lemmas = table(spark, sf, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    return lexicon.roots(lemmas, "p_brand", "p_name", "n")


@query("""
WITH a AS (SELECT o_orderkey, unnest([o_custkey, o_orderkey % 97, -1, o_custkey % 31]) AS c_custkey, unnest([0, 1, 2, 3]) AS pos FROM orders)
SELECT o_orderkey, string_agg(c_custkey || ':' || c_mktsegment, ' ' ORDER BY pos) AS entries FROM a JOIN customer USING (c_custkey) WHERE c_acctbal > 0 GROUP BY 1
""")
def ordered_entries(spark: SparkSession, sf: str) -> DataFrame:
    ids = F.array(F.col("o_custkey"), F.col("o_orderkey") % 97, F.lit(-1).cast("long"), F.col("o_custkey") % 31)
    made = lexicon.ordered_entries(table(spark, sf, "orders"), "o_orderkey", ids, table(spark, sf, "customer").where("c_acctbal > 0"), "c_custkey", ["c_mktsegment"])
    return made.select("o_orderkey", F.array_join(F.transform("entries", lambda x: F.concat_ws(":", x["c_custkey"].cast("string"), x["c_mktsegment"])), " ").alias("entries"))


@query("""
WITH m AS (SELECT c_custkey, s_suppkey, s_acctbal, 0 AS rank FROM customer JOIN supplier ON c_custkey = s_suppkey UNION ALL SELECT c_custkey, s_suppkey, s_acctbal, 1 FROM customer JOIN supplier ON c_nationkey = s_nationkey)
SELECT c_custkey, s_suppkey, rank FROM m QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY rank, s_acctbal DESC, s_suppkey) = 1
""")
def best_candidate(spark: SparkSession, sf: str) -> DataFrame:
    on = [(F.col("c_custkey"), F.col("s_suppkey")), (F.col("c_nationkey"), F.col("s_nationkey"))]
    best = lexicon.best_of(table(spark, sf, "customer"), ["c_custkey"], table(spark, sf, "supplier"), on, [F.desc("s_acctbal"), F.col("s_suppkey")])
    return best.select("c_custkey", "s_suppkey", "rank")


@query("""
WITH k AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 'xx' ELSE 'en' END) AS v FROM labels GROUP BY 1)
SELECT doc_id, coalesce(v, lang) AS lang, CASE WHEN v IS NOT NULL AND v IS DISTINCT FROM lang THEN lang END AS was FROM documents LEFT JOIN k USING (doc_id)
""")
def overridden_values(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 0, "xx").otherwise("en").alias("v"))
    return lexicon.overridden(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", "lang", known, "v")


@query("""
WITH a AS (SELECT doc_id, max({'q': quality, 't': toxic}) AS x FROM labels GROUP BY 1)
SELECT doc_id, source, x.q AS quality, x.t AS toxic, x IS NOT NULL AS answered FROM documents LEFT JOIN a USING (doc_id)
""")
def merged_answers(spark: SparkSession, sf: str) -> DataFrame:
    return documents.merged_answers(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])


@query("""
SELECT source, count(DISTINCT doc_id) AS n_answered, array_to_string(list_sort(list(DISTINCT lang || '.ai')), ' ') AS langs FROM documents SEMI JOIN labels USING (doc_id) GROUP BY 1
""")
def answered_langs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    answers = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi")
    return documents.answered_langs(docs.select("source", "doc_id"), "source", "doc_id", answers, "lang").select("source", "n_answered", F.array_join("langs", " ").alias("langs"))


@query("""
WITH u AS (SELECT c_nationkey AS key, c_mktsegment AS kind, c_custkey AS target FROM customer UNION SELECT s_nationkey, 'FURNITURE', s_suppkey FROM supplier)
SELECT key, kind, count(*) AS n_targets, min(target) AS first_target FROM u WHERE target IS NOT NULL GROUP BY ALL
""")
def joined_relations(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_mktsegment").alias("kind"), F.col("c_custkey").alias("target"))
    new = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), F.lit("FURNITURE").alias("kind"), F.col("s_suppkey").alias("target"))
    return documents.joined_relations(given, "key", new, "kind", "target")


@query("""
WITH s AS (SELECT s_nationkey AS key, max(s_name) AS name FROM supplier GROUP BY 1) SELECT coalesce(key, n_nationkey) AS key, coalesce(name, n_name) AS name FROM nation FULL JOIN s ON key = n_nationkey
""")
def later_titles(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    second = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), F.col("s_name").alias("name"))
    return documents.later_wins([first, second], ["key"], "name")


@query("SELECT volume, count(*) AS n, min(o_orderkey) AS first_order FROM (SELECT o_orderkey, 1 AS volume FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 3 FROM orders WHERE o_totalprice > 200000) GROUP BY 1")
def stacked_volumes(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("volume", F.lit(9))
    made = documents.stacked([orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus = 'F'"), orders.where("o_totalprice > 200000").drop("o_orderdate")], "volume")
    return made.groupBy("volume").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))


@query("""
WITH p AS (SELECT conv_id, max(turn) AS last, count(*) AS n, string_agg(text, ' ' ORDER BY turn) AS text, array_agg(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) ORDER BY turn) AS w FROM conversations WHERE turn <> 3 GROUP BY 1)
SELECT p.conv_id, md5(text) AS text, array_to_string(list_transform(range(len(w)), lambda i: coalesce(list_sum(w[1:i]), 0)), ' ') AS starts, n = total AS complete
FROM p JOIN (SELECT conv_id, count(*) AS total FROM conversations GROUP BY 1) t USING (conv_id)
""".replace("\\\\", "\\"))
def assembled_parts(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations")
    total = said.groupBy("conv_id").agg(F.count("*").alias("total"))
    made = documents.assembled(said.where("turn <> 3").join(total, "conv_id"), "conv_id", "turn", "text", "total")
    return made.select("conv_id", F.md5("text").alias("text"), F.array_join(F.transform("starts", lambda x: x.cast("string")), " ").alias("starts"), "complete")


@query("WITH p AS (SELECT item_id, array_to_string(string_split(text, ' ')[1:2], ' ') AS p FROM benchmark) SELECT doc_id, item_id FROM documents JOIN p ON contains(text, p) WHERE p <> ''")
def phrases_in_texts(spark: SparkSession, sf: str) -> DataFrame:
    phrases = table(spark, sf, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 2), " ").alias("p"))
    return matching.contained(table(spark, sf, "documents"), "doc_id", F.coalesce("text", F.lit("")), phrases, "item_id", "p")


@query("WITH n AS (SELECT p_name AS name FROM part UNION SELECT string_split(p_name, ' ')[2] FROM part UNION SELECT n_name || ' ' || p_name FROM part JOIN nation ON p_size = n_nationkey) SELECT a.name AS inner_id, b.name AS outer_id FROM n a JOIN n b ON a.name <> b.name AND length(a.name) >= 4 AND contains(' ' || b.name || ' ', ' ' || a.name || ' ')")
def inner_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    within = part.join(table(spark, sf, "nation"), F.col("p_size") == F.col("n_nationkey")).select(F.concat_ws(" ", "n_name", "p_name").alias("name"))
    names = part.select(F.col("p_name").alias("name")).unionByName(part.select(F.split("p_name", " ")[1].alias("name"))).unionByName(within).distinct()
    return matching.inner_names(names, "name", F.col("name"))


KEYWORDS = [("the ", "english"), ("and ", "english"), ("der ", "german"), ("und ", "german"), ("les ", "french"), ("que ", "french"), ("que ", "spanish"), ("los ", "spanish"), ("token", "secret"), ("@", "mail"), (".example", "mail")]


@query(f"""
WITH k(k, topic) AS (VALUES {", ".join(f"('{k}', '{t}')" for k, t in KEYWORDS)}),
v AS (SELECT doc_id, topic, count(*) AS votes FROM documents JOIN k ON contains(lower(text), k) GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, topic) AS place FROM v QUALIFY place <= 3
""")
def topic_votes(spark: SparkSession, sf: str) -> DataFrame:
    named = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("topic")) for k, t in KEYWORDS])
    keywords = spark.range(1).select(F.explode(named).alias("x")).select("x.*")
    return matching.voted(table(spark, sf, "documents"), "doc_id", F.lower("text"), keywords, "k", "topic")


@query("""
WITH a AS (SELECT DISTINCT p_name AS title FROM part), b AS (SELECT DISTINCT lower(p_type) AS t FROM part UNION SELECT DISTINCT p_name || ' of ' || p_brand FROM part WHERE p_size < 5) SELECT title FROM a WHERE EXISTS (SELECT 1 FROM b WHERE contains(title, t) OR contains(t, title))
""")
def overlapping_titles(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    other = part.select(F.lower("p_type").alias("t")).unionByName(part.where("p_size < 5").select(F.concat_ws(" of ", "p_name", "p_brand").alias("t")))
    return matching.overlapping_titles(part, F.col("p_name"), other, F.col("t"))


@query("""
WITH a AS (SELECT conv_id, turn, length(text) AS id, role FROM conversations), b AS (SELECT conv_id, turn + 2 AS turn, length(text) AS id, role FROM conversations)
SELECT conv_id, count(a.role) AS n_left, count(b.role) AS n_right, count_if(coalesce(a.id = b.id OR contains(a.role, b.role) OR contains(b.role, a.role), FALSE))::BIGINT AS n_agree FROM a FULL JOIN b USING (conv_id, turn) GROUP BY 1
""")
def place_agreement(spark: SparkSession, sf: str) -> DataFrame:
    said = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("id"), "role")
    return matching.agreement(said, said.withColumn("turn", F.col("turn") + 2), ["conv_id", "turn"], "id", "role")


LATIN = "list_filter(regexp_extract_all(lower({}), '[a-z'']+'), lambda w: length(w) > 1)"
INDEX = f"d AS (SELECT doc_id, {LATIN.format('text')} AS w FROM documents), i AS (SELECT term, doc_id, length, count(*) AS n FROM (SELECT doc_id, len(w) AS length, unnest(w) AS term FROM d) GROUP BY ALL)"


def _lengths(spark: SparkSession, sf: str) -> DataFrame:
    return search.lengths(table(spark, sf, "documents"), "doc_id", latin_tokens(F.col("text")))


def _index(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return search.postings(docs, "doc_id", latin_tokens(F.col("text")), rows=docs.count())


@query(f"WITH {INDEX} SELECT term, count(*) AS df, sum(n)::BIGINT AS n, max(length) AS longest FROM i GROUP BY 1")
def search_postings(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("n"), F.max("length").alias("longest"))


SCORED = """
c AS (SELECT count(*) AS docs, avg(length) AS mean FROM (SELECT DISTINCT doc_id, length FROM i)), f AS (SELECT term, count(*) AS df FROM i GROUP BY 1),
s AS (SELECT item_id, doc_id, round(sum(ln(1 + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * n * 2.2::DOUBLE / (n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 6) AS score FROM i JOIN q USING (term) JOIN f USING (term), c GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s QUALIFY place <= 5
"""


@query(f"WITH {INDEX}, q AS (SELECT DISTINCT item_id, unnest({LATIN.format('text')}) AS term FROM benchmark), {SCORED}")
def search_top5(spark: SparkSession, sf: str) -> DataFrame:
    return search.ranked(_index(spark, sf), "doc_id", table(spark, sf, "benchmark"), "item_id", latin_tokens(F.col("text")), docs=_lengths(spark, sf))


@query(ORACLE["search_top5"])
def search_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same answers from postings in blocks, of which those are left out whose documents can't be among the best."""
    docs, queries, words = table(spark, sf, "documents"), table(spark, sf, "benchmark"), latin_tokens(F.col("text"))
    rows = docs.count()
    index = search.postings(docs, "doc_id", words, rows=rows, blocks=max(1, -(-rows // 256)))
    blocks = search.block_postings(index, "doc_id", docs=_lengths(spark, sf), asked=queries.select(F.explode(words).alias("term")))
    found, _ = search.pruned_blocks(blocks, queries, "item_id", words, "doc_id")
    return found


@query(f"WITH {INDEX}, a AS (SELECT DISTINCT item_id, left(unnest({LATIN.format('text')}), 6) AS asked FROM benchmark), q AS (SELECT DISTINCT item_id, term FROM a JOIN (SELECT DISTINCT term FROM i) t ON term = asked OR (length(asked) = 6 AND starts_with(term, asked))), {SCORED}")
def search_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    asked = F.transform(latin_tokens(F.col("text")), lambda w: F.left(w, F.lit(6)))
    return search.ranked(_index(spark, sf), "doc_id", table(spark, sf, "benchmark"), "item_id", asked, prefix=6, docs=_lengths(spark, sf))


@query("SELECT lang AS book, doc_id AS path, CASE WHEN regexp_full_match(source, 'Chapter [0-9]+') THEN '' ELSE source END AS title, md5(trim(regexp_replace(coalesce(CASE WHEN lang = 'en' THEN text ELSE '<b>' || source || '</b> ' || lang END, ''), '<[^>]+>', '', 'g'))) AS text FROM documents")
def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    texts = F.map_from_arrays(F.array(F.lit("en.first"), F.lit("xx.other")), F.array("text", F.concat(F.lit("<b>"), F.col("source"), F.lit("</b> "), F.col("lang"))))
    made = search.book_docs(docs, "doc_id", F.col("source"), texts, F.when(F.col("lang") == "en", "en.first").otherwise("xx.other"), "lang")
    return made.withColumn("text", F.md5("text"))


SOLD = "l AS (SELECT o_orderpriority AS chapter, l_orderkey AS item, l_suppkey AS member, o_custkey AS cluster FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _sold(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    rows = lines.count()
    met = spread(lines, rows, "l_orderkey").join(spread(orders, rows, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return met.select(F.col("o_orderpriority").alias("chapter"), F.col("l_orderkey").alias("item"), F.col("l_suppkey").alias("member"), F.col("o_custkey").alias("cluster"))


def _buyers(spark: SparkSession, sf: str) -> DataFrame:
    """(item, cluster), each once."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("cluster"))
    return spread(orders, orders.count(), "item").distinct()


@query(f"""
WITH {SOLD}, s AS (SELECT DISTINCT chapter, item, member FROM l), t AS (SELECT chapter, count(DISTINCT item) AS n_items FROM s GROUP BY 1),
n AS (SELECT chapter, member, count(*) AS n FROM s WHERE member NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 2000) GROUP BY ALL)
SELECT chapter, member, n, round(n / n_items, 3) AS share, row_number() OVER (PARTITION BY chapter ORDER BY n DESC, member) AS place FROM n JOIN t USING (chapter) QUALIFY place <= 15
""")
def chapter_prolific(spark: SparkSession, sf: str) -> DataFrame:
    left_out = table(spark, sf, "supplier").where("s_acctbal < 2000").select(F.col("s_suppkey").alias("member"))
    return chapters.prolific(_sold(spark, sf), "chapter", "item", "member", left_out)


@query(f"WITH {SOLD}, n AS (SELECT chapter, item, count(*) AS n FROM l GROUP BY ALL) SELECT chapter, count(*) AS n_chains, min(n) AS least, max(n) AS most, round(avg(n), 2) AS mean, floor(median(n))::BIGINT AS median FROM n GROUP BY 1")
def chapter_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return chapters.chain_lengths(_sold(spark, sf), "chapter", "item")


@query(f"WITH {SOLD}, n AS (SELECT chapter, item, count(*) AS length FROM l GROUP BY ALL) SELECT chapter, length, count(*) AS n_chains FROM n GROUP BY ALL")
def chapter_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return chapters.length_histogram(_sold(spark, sf), "chapter", "item")


@query("SELECT source, lang AS scholar, CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' ELSE 'other' END AS grade, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def chapter_gradings(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return chapters.grading_mix(rows, "source", F.col("lang"), F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").otherwise("other"))


@query(f"WITH {SOLD} SELECT chapter, member, count(DISTINCT item) AS n_items, count(DISTINCT cluster) AS n_paths FROM l GROUP BY ALL HAVING n_items >= 2 AND n_paths >= 2")
def chapter_corroboration(spark: SparkSession, sf: str) -> DataFrame:
    return chapters.corroboration(_sold(spark, sf), "chapter", "item", "member", _buyers(spark, sf), "cluster", rows=table(spark, sf, "lineitem").count())


@query(f"WITH {SOLD}, n AS (SELECT cluster, member, count(DISTINCT item) AS n FROM l GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, member) AS place FROM n WHERE n > 1 QUALIFY place <= 5")
def chapter_spine(spark: SparkSession, sf: str) -> DataFrame:
    return chapters.shared_members(_sold(spark, sf), "item", "member", _buyers(spark, sf), "cluster", rows=table(spark, sf, "lineitem").count())


@query("WITH p AS (SELECT user_id, count_if(event_type IN ('view', 'click')) AS s, count(*) AS n, avg(value) AS v FROM events GROUP BY 1) SELECT user_id, (s > 0 AND 2 * s >= n) AS is_source, user_id % 10 = 0 OR (s > 0 AND 2 * s >= n) AS is_excluded FROM p")
def chapter_excluded(spark: SparkSession, sf: str) -> DataFrame:
    profile = counting.role_profile(table(spark, sf, "events"), "user_id", "event_type", ["view", "click"]).select("user_id", "is_source")
    return chapters.excluded(profile, F.col("user_id") % 10 == 0)


@query("SELECT user_id, row_number() OVER (ORDER BY min({'ts': ts, 'e': event_id}), user_id) AS id FROM events GROUP BY 1")
def first_seen_ids(spark: SparkSession, sf: str) -> DataFrame:
    return chapters.first_seen_ids(table(spark, sf, "events"), "user_id", [F.col("ts"), F.col("event_id")])


@query("""
WITH s AS (SELECT n_nationkey, count(c_custkey) AS size FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1), e AS (SELECT *, sum(size) OVER (ORDER BY n_nationkey) AS last FROM s)
SELECT p_partkey, n_nationkey, (p_partkey - (last - size))::BIGINT AS place FROM part JOIN e ON p_partkey > last - size AND p_partkey <= last
""")
def cumulative_place(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").join(table(spark, sf, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_nationkey").agg(F.count("c_custkey").alias("size"))
    return chapters.cumulative_place(nations, F.col("n_nationkey"), "size", table(spark, sf, "part").select("p_partkey"), "p_partkey").select("p_partkey", "n_nationkey", "place")
