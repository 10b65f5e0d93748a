"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, hard_negatives, html_text, line_dedup, mixing, ngram_join, packing, pii, quality_rules, spelling, substring_dedup, toxicity, url_filter
from textloom.tables import table

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def url_rules(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in RULES])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_rules(spark), ["page_id"])


#: Of the query; a real corpus takes its key from outside.
PII_KEY = b"query"


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    safe = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return safe.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_join(table(spark, sf_dir, "documents"), size=3, per_cent=90, orders=3)
    return joined.select("doc_id", "n_shingles", "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, only=["doc_id"]).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(line_dedup.batches_of(table(spark, sf_dir, "documents")))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_pii_surrogates, op3_ngram_jaccard_join, op4_mixing, op5_html_extraction, op6_quality_rules, op7_substring_dedup, op8_exact_dedup, op9_packing, op10_toxicity, op11_line_dedup, op12_spelling_variants, op13_hard_negatives)}
