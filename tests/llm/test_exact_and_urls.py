import hashlib

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, mixing, quality_rules, url_filter
from textloom.llm.oracle import SQL
from textloom.llm.queries import QUERIES, url_rules


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    same(QUERIES[name](spark, DATA), duck.sql(SQL[name]))


ROWS = [(1, "Ab"), (2, "aB"), (3, ""), (4, None), (5, "x" * 70_000), (6, "É"), (7, "é"), (7, "é"), (8, "x" * 70_000)]


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_groups_with_collisions(spark, bits):
    d = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("keep_id", F.lit("clash")).withColumn("key", F.lit(0))
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(d, capacity=1, key_bits=bits).collect()}
    assert got == {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 8, 2, False), (8, 8, 2, True), (6, 6, 1, True), (7, 7, 2, True)}
    assert exact_dedup.exact_groups(d).where("doc_id = 2").first()["text_sha256"] == hashlib.sha256(b"ab").hexdigest()
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(d).collect()) == [2, 4, 6, 7, 7, 8]


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(300).select(F.xxhash64("id").alias("key"))
    cells = exact_dedup.directory(keys, 20)
    depth = cells.agg(F.max("global_depth")).first()[0]
    held = keys.withColumn("cell", exact_dedup.prefix(F.col("key"), depth)).join(cells, "cell").groupBy("bucket").count()
    assert held.agg(F.max("count"), F.sum("count")).first()[0] <= 20


def test_shallow_buckets_stand_in_several_cells(spark):
    keys = spark.createDataFrame([((5 << 58) + (i << 52),) for i in range(40)] + [(0,), (-1,)], "key long")  # 40 keys share six bits
    cells = exact_dedup.directory(keys, 8)
    held = cells.groupBy("bucket", "local_depth", "global_depth").count().collect()
    assert all(r["count"] == 1 << (r["global_depth"] - r["local_depth"]) for r in held)
    assert max(r["local_depth"] for r in held) > min(r["local_depth"] for r in held)


def test_lookups_go_through_the_directory(spark, monkeypatch):
    d = spark.createDataFrame([(i, f"text {i % 7}") for i in range(70)], "doc_id long, text string")
    whole = exact_dedup.directory
    assert exact_dedup.exact_groups(d, capacity=2).where("kept").count() == 7
    last = lambda cells: cells.agg(F.max("bucket")).first()[0]
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, capacity: (c := whole(keys, capacity)).where(F.col("bucket") != last(c)))
    assert exact_dedup.exact_groups(d, capacity=2).where("kept").count() < 7


def test_copies_are_dropped_by_row(spark):
    d = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "A", "z"), (None, "b", "n"), (None, None, "m")], "doc_id long, text string, kept_id string")
    out = exact_dedup.drop_copies(d)
    assert out.columns == d.columns
    assert sorted(r["kept_id"] for r in out.collect()) == ["m", "y", "z"]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert exact_dedup.exact_groups(d).count() == 0
    assert mixing.mix(d).count() == 0
    assert quality_rules.judge(d).count() == 0
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_rules(spark), ["page_id"]).count() == 0


URLS = [(1, "http://a.COM/en/x?q"), (2, "http://www.example.com/en/77"), (3, "http://example.com/en"), (4, None), (5, "no scheme"), (6, "://net/de/1"), (7, "http://x.net/de/8#y"), (8, "http://b.example.net/de/81"), (8, "http://b.example.net/de/81"), (9, "http://telecom/en/"), (10, "http://example.com:80/en/")]


@pytest.mark.parametrize("broadcast", [100, 0])
def test_urls(spark, broadcast):
    d = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = sorted((r["page_id"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(d, url_rules(spark), ["page_id"], broadcast_rules=broadcast, salts=3).collect())
    assert got == [(1, "com/en/", "block"), (2, "example.com/en/7", "allow"), (3, None, "allow"), (4, None, "allow"), (5, None, "allow"), (6, "net/de/", "allow"), (7, "net/de/", "allow"), (8, "example.net/de/8", "block"), (8, "example.net/de/8", "block"), (9, None, "allow"), (10, None, "allow")]


def test_very_long_urls(spark):
    rows = [(1, "http://" + "a." * 60_000 + "com/en/" + "x/" * 60_000), (None, "http://" + "." * 1000 + "net/de/"), (2, "http://com./en/"), (3, "http://.com/en/")]
    got = {r["page_id"]: r["rule"] for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), url_rules(spark), ["page_id"]).collect()}
    assert got == {1: "com/en/", None: "net/de/", 2: None, 3: "com/en/"}


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 7), "abc"[i % 3] if i % 10 else None, 1) for i in range(400)] + [(400, None, "a", 1), (401, "w w", "tiny", 1), (401, "w w", "tiny", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    by = {r["source"]: r for r in mixing.mix(d, bins=8).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("n"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()}
    for r in by.values():
        assert abs(r["taken"] - r["target"]) <= 1
        assert r["over"] <= 0
        assert r["target"] <= 3 * r["n"]
    assert sum(r["target"] for r in by.values()) == pytest.approx(sum(r["n"] for r in by.values()))
    assert by["tiny"]["target"] == 12
    again = {(r[0], r[1]) for r in mixing.mix(d, bins=64).select("doc_id", "taken").collect()}
    assert again == {(r[0], r[1]) for r in mixing.mix(d.repartition(3), bins=8).select("doc_id", "taken").collect()}


def test_mixed_documents_keep_columns(spark):
    d = spark.createDataFrame([(1, "a b", "s", 9), (2, None, "t", 9), (3, "c", "t", 9)], "doc_id long, text string, source string, size int")
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns
    assert {r["doc_id"] for r in out.collect()} >= {2}


def test_quality_on_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, " \n\t ", "en", "s"), (4, "a b c " * 100, "en", "s"), (4, "a b c " * 100, "en", "s"), (5, "x\nx\ny\n\n \n", "en", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_words", F.lit(-1))
    got = {r["doc_id"]: (r["n_words"], r["n_dup_lines"], r["n_repeat_words"], r["kept"]) for r in quality_rules.judge(d).collect()}
    assert got == {1: (0, 0, 0, False), 2: (0, 0, 0, False), 3: (0, 0, 0, False), 4: (300, 0, 300, False), 5: (3, 1, 0, False)}


def test_fences_come_from_the_spread_of_a_group(spark):
    """Of two sources with the same odd document, the one whose documents differ little drops it."""
    words = lambda i, spread: " ".join("w" * (5 + (i + j) % 3 * spread) + chr(97 + j % 26) + chr(97 + i % 26) + chr(97 + j // 26) for j in range(60))
    rows = [(i, words(i, 0) + " x" * (i % 5), "en", "narrow") for i in range(60)] + [(100 + i, words(i, i % 9), "en", "wide") for i in range(60)]
    odd = " ".join("v" * 14 + chr(97 + j % 26) + chr(97 + j // 26) for j in range(60))
    rows += [(60, odd, "en", "narrow"), (160, odd, "en", "wide")]
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[60]["kept"] and got[160]["kept"]
    assert got[60]["hi_chars_per_word"] < got[160]["hi_chars_per_word"]
    assert sum(r["kept"] for r in got.values()) == len(rows) - 1


def test_equal_documents_do_not_close_the_fence(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(60)), "en", "s") for i in range(100)] + [(100 + i, " ".join(f"word{j}" for j in range(55 - i % 3, 115)), "en", "s") for i in range(20)]
    assert quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).where("kept").count() == 120
