"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import checking
from textloom.operators.checking import Rule
from textloom.plans.registry import query
from textloom.tables import table


def _document_rules() -> list[Rule]:
    return [
        Rule("text", "error", "empty text", F.col("text").isNull() | (F.trim("text") == "")),
        Rule("n_chars", "error", "n_chars differs from the text", F.col("n_chars") != F.length("text")),
        Rule("lang", "error", "unknown language", ~F.col("lang").isin("en", "fr", "de")),
        Rule("text", "warning", "very short", F.col("n_chars") < 100),
        Rule("text", "warning", "many symbols", F.length(F.regexp_replace("text", "[^#*$%&|]", "")) * 10 > F.col("n_chars")),
        Rule("text", "info", "holds an address", F.col("text").contains("@")),
    ]


@query(r"""
WITH v AS (SELECT unnest([
  CASE WHEN text IS NULL OR trim(text) = '' THEN {'field': 'text', 'severity': 'error', 'message': 'empty text'} END,
  CASE WHEN n_chars <> length(text) THEN {'field': 'n_chars', 'severity': 'error', 'message': 'n_chars differs from the text'} END,
  CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN {'field': 'lang', 'severity': 'error', 'message': 'unknown language'} END,
  CASE WHEN n_chars < 100 THEN {'field': 'text', 'severity': 'warning', 'message': 'very short'} END,
  CASE WHEN length(regexp_replace(text, '[^#*$%&|]', '', 'g')) * 10 > n_chars THEN {'field': 'text', 'severity': 'warning', 'message': 'many symbols'} END,
  CASE WHEN contains(text, '@') THEN {'field': 'text', 'severity': 'info', 'message': 'holds an address'} END]) AS v FROM documents)
SELECT v.field AS field, v.severity AS severity, v.message AS message, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY ALL
""")
def dq_rules(spark: SparkSession, sf: str) -> DataFrame:
    return checking.tally(checking.checked(table(spark, sf, "documents"), _document_rules(), ["doc_id"]))


@query(r"""
SELECT doc_id, CASE WHEN text IS NULL OR trim(text) = '' OR n_chars <> length(text) OR lang NOT IN ('en', 'fr', 'de') THEN 'error' WHEN n_chars < 100 OR length(regexp_replace(text, '[^#*$%&|]', '', 'g')) * 10 > n_chars THEN 'warning' ELSE 'pass' END AS status
FROM documents
""")
def dq_status(spark: SparkSession, sf: str) -> DataFrame:
    return checking.checked(table(spark, sf, "documents"), _document_rules(), ["doc_id"]).select("doc_id", "status")


@query("SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL HAVING count(*) > 1")
def dq_repeated_roles(spark: SparkSession, sf: str) -> DataFrame:
    return checking.duplicates_within(table(spark, sf, "conversations"), ["conv_id"], "role")


@query("""
WITH n AS (SELECT l_orderkey, count(*) AS counted FROM lineitem GROUP BY 1)
SELECT o_orderkey, 4::BIGINT AS stated, coalesce(counted, 0) AS counted, coalesce(counted, 0) = 4 AS agrees FROM orders LEFT JOIN n ON l_orderkey = o_orderkey
""")
def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "orders").select("o_orderkey", F.lit(4).cast("long").alias("stated"))
    return checking.reconciled(parents, table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "stated")
