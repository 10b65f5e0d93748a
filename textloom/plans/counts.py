"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import edge_trimmed_tokens, latin_tokens
from textloom.operators import counting, merging
from textloom.plans.registry import query
from textloom.tables import table

SURFACES = r"""
s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '\s+'), lambda w: trim(w, '.,;:!?"''()[]{}«»،؛؟…')), lambda w: w <> '')) AS surface FROM documents),
c AS (SELECT surface, count(*) AS n, count(DISTINCT doc_id) AS n_texts, min(doc_id) AS first_text FROM s GROUP BY surface)
"""


def _surfaces(spark: SparkSession, sf: str) -> DataFrame:
    return counting.surface_counts(table(spark, sf, "documents"), "doc_id", edge_trimmed_tokens(F.col("text")))


@query(f"WITH {SURFACES} SELECT * FROM c")
def surface_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _surfaces(spark, sf)


@query(f"WITH {SURFACES} SELECT count(*) AS n_surfaces, sum(n)::BIGINT AS n_tokens, max(n) AS most, min(n) AS least, count_if(n = 1)::BIGINT AS n_once, count_if(n >= 10)::BIGINT AS n_often FROM c")
def surface_summary(spark: SparkSession, sf: str) -> DataFrame:
    return counting.surface_summary(_surfaces(spark, sf))


@query("SELECT event_type, count(DISTINCT user_id) AS n_items, min(user_id) AS first_item, max(user_id) AS last_item FROM events GROUP BY event_type")
def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    index = counting.posting_ends(table(spark, sf, "events"), ["event_type"], "user_id")
    return index.select("event_type", "n_items", F.col("first").alias("first_item"), F.col("last").alias("last_item"))


@query("""
WITH v AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_returnflag) AS k, sum(n) OVER (PARTITION BY l_partkey) AS total FROM v)
SELECT l_partkey, l_returnflag AS winner, n AS votes, total::BIGINT AS total FROM r WHERE k = 1 AND total >= 10 AND n >= 0.5 * total
""")
def modal_vote(spark: SparkSession, sf: str) -> DataFrame:
    return counting.modal_vote(table(spark, sf, "lineitem"), "l_partkey", "l_returnflag", least=10, share=0.5)


@query("""
SELECT user_id, count(event_type) AS n_roles, count_if(event_type IN ('view', 'click'))::BIGINT AS n_source,
       count_if(event_type IN ('view', 'click'))::BIGINT > 0 AND 2 * count_if(event_type IN ('view', 'click'))::BIGINT >= count(event_type) AS is_source
FROM events GROUP BY user_id
""")
def role_profile(spark: SparkSession, sf: str) -> DataFrame:
    return counting.role_profile(table(spark, sf, "events"), "user_id", "event_type", ["view", "click"])


@query("""
SELECT r_name, n_name, c_mktsegment, 3 - bit_count(grouping_id(r_name, n_name, c_mktsegment)::INTEGER)::BIGINT AS level, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 0
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)
""")
def count_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return counting.rollup_counts(rows, ["r_name", "n_name", "c_mktsegment"], F.col("c_acctbal") > 0)


KEYWORDS = r"list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z'']+'), lambda w: length(w) > 4))"


@query(rf"""
WITH x AS (SELECT w.a, t.b, count(*) AS n FROM (SELECT doc_id, unnest({KEYWORDS}) AS a FROM documents) w JOIN (SELECT doc_id, unnest(['quality:' || quality, 'toxic:' || toxic]) AS b FROM labels) t USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS place FROM x WHERE n >= 3)
SELECT a, b, n, place FROM r WHERE place <= 20
""")
def keyword_topics(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    topics = F.array(F.concat(F.lit("quality:"), F.col("quality").cast("string")), F.concat(F.lit("toxic:"), F.col("toxic").cast("string")))
    met = counting.cooccurrence(rows, "doc_id", latin_tokens(F.col("text"), longer_than=4), topics)
    return counting.top_per_key(met.where("n >= 3"), ["b"], [F.desc("n"), F.col("a")], 20)


@query("""
WITH o AS (SELECT o_orderstatus AS outcome, count(*) AS n, sum(o_totalprice) AS total, avg(o_totalprice) AS mean, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders GROUP BY 1)
SELECT outcome, n, round(total, 2) AS total, round(mean, 4) AS mean, least, most, round(total / sum(total) OVER (), 6) AS share FROM o
""")
def run_costs(spark: SparkSession, sf: str) -> DataFrame:
    stats = counting.outcome_stats(table(spark, sf, "orders"), F.col("o_orderstatus"), F.col("o_totalprice"))
    return stats.select("outcome", "n", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), "least", "most", F.round("share", 6).alias("share"))


@query("SELECT lang, min(n_chars) AS least, max(n_chars) AS most, round(avg(n_chars), 4) AS mean, median(n_chars) AS median, count(n_chars) AS n FROM documents GROUP BY lang")
def length_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = counting.length_stats(table(spark, sf, "documents"), ["lang"], F.col("n_chars"))
    return stats.withColumn("mean", F.round("mean", 4))


@query("""
WITH m AS (SELECT unnest([{'metric': 'has_chars', 'has': n_chars > 0}, {'metric': 'is_long', 'has': n_chars > 2000}, {'metric': 'is_english', 'has': lang = 'en'}], recursive := true) FROM documents)
SELECT metric, count_if(has)::BIGINT AS n, count(*) AS total, round(100 * count_if(has)::BIGINT / count(*), 4) AS per_cent FROM m GROUP BY metric
""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return counting.coverage(table(spark, sf, "documents"), {"has_chars": F.col("n_chars") > 0, "is_long": F.col("n_chars") > 2000, "is_english": F.col("lang") == "en"})


#: Price per unit by the longest prefix of a part's type; the empty prefix is the default.
PRICES = [("", 1.0), ("S", 0.5), ("ST", 0.75), ("STANDARD", 2.5), ("PROMO", 0.25), ("ECONOMY ANODIZED", 4.0)]


@query(f"""
WITH p(prefix, price) AS (VALUES {', '.join(f"('{a}', {b}::DOUBLE)" for a, b in PRICES)}),
m AS (SELECT p_partkey, arg_max(price, length(prefix)) AS price FROM part JOIN p ON starts_with(p_type, prefix) GROUP BY 1)
SELECT p_brand, round(sum(price * greatest(l_quantity - 1, 0)), 4) AS cost, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN m USING (p_partkey) GROUP BY 1
""")
def cost_model(spark: SparkSession, sf: str) -> DataFrame:
    prices = spark.createDataFrame(PRICES, "prefix string, price double")
    priced = merging.priced(table(spark, sf, "part"), "p_type", prices, "prefix")
    rows = table(spark, sf, "lineitem").join(priced, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand").agg(F.round(F.sum(F.col("price") * F.greatest(F.col("l_quantity") - 1, F.lit(0))), 4).alias("cost"), F.count("*").alias("n"))


@query("""
SELECT CASE WHEN q.doc_id IS NULL THEN 'missing_page' WHEN NOT (quality = 1) THEN 'skipped_invalid' WHEN q.n_chars > 1000 THEN 'skipped_existing' ELSE 'updated' END AS outcome, count(*) AS n
FROM labels LEFT JOIN (SELECT doc_id, n_chars FROM documents WHERE lang <> 'es') q USING (doc_id) GROUP BY 1
""")
def merge_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "documents").where("lang <> 'es'").select("doc_id", F.when(F.col("n_chars") > 1000, F.col("n_chars")).alias("has"))
    return merging.outcomes(table(spark, sf, "labels"), pages, "doc_id", F.col("quality") == 1, "has")
