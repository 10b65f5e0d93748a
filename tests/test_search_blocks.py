"""Search over blocks of postings against scoring everything; what is written for a search."""

import json
import math
import random

from pyspark.sql import functions as F

from textloom.operators import search


def rows(seed, n):
    r = random.Random(seed)
    common, rare = ["the", "of", "and"], [f"w{i}" for i in range(60)]
    return [(i, " ".join(r.choice(common) if r.random() < 0.5 else rare[min(int(r.expovariate(0.08)), 59)] for _ in range(r.randint(0, 30)))) for i in range(n)]


def test_pruned_answers_are_those_of_scoring_all(spark):
    docs = spark.createDataFrame([(*x,) for x in rows(1, 600)] + [(1000, "w1 w1"), (1001, "w1 w1"), (1002, None)], "id long, text string")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != "")
    index = search.postings(docs, "id", words)
    asked = spark.createDataFrame([(1, "w1"), (2, "the w50 w3"), (3, "w59 w58 of"), (4, "none"), (5, ""), (6, "w2 w2 w7 and the of")], "q long, text string")
    want = {(r["q"], r["id"], r["score"], r["place"]) for r in search.ranked(index, "id", asked, "q", words).collect()}
    blocks = search.block_postings(index, "id", per_block=8)
    found, seen = search.pruned_blocks(blocks, asked, "q", words, "id", first=3)
    assert {(r["q"], r["id"], r["score"], r["place"]) for r in found.collect()} == want
    counts = {r["scored"]: r["n"] for r in seen.groupBy("scored").agg(F.count("*").alias("n")).collect()}
    assert counts[False] > 100
    assert max(r["n"] for r in blocks.select(F.size("docs").alias("n")).collect()) < 40


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], "id long, text string")
    words = F.split("text", " ")
    found, seen = search.pruned_blocks(search.block_postings(search.postings(none, "id", words), "id"), none, "id", words, "doc")
    assert found.count() == seen.count() == 0


def test_search_files(spark, tmp_path):
    docs = spark.createDataFrame([("a", "/1", "T", "x"), ("a", "/2", "", "y"), ("b", "/3", "U", "")], "book string, path string, title string, text string")
    meta = search.write_search(docs, str(tmp_path))
    assert {r["book"]: (r["n_texts"], r["n_titles"]) for r in meta.collect()} == {"a": (2, 1), "b": (0, 1)}
    lines = lambda d: sorted((json.loads(x) for p in (tmp_path / d).rglob("part-*.json") for x in p.read_text().splitlines()), key=str)
    assert lines("titles") == [{"book": "a", "path": "/1", "title": "T"}, {"book": "b", "path": "/3", "title": "U"}] and len(lines("books/book=a")) == 2 and len(lines("meta")) == 2


def test_pairs_of_blocks_and_terms_are_never_made(spark, monkeypatch):
    made, stage = [], search.stage
    monkeypatch.setattr(search, "stage", lambda df, name: made.append((name, stage(df, name))) or made[-1][1])
    docs = spark.createDataFrame(rows(2, 300), "id long, text string")
    words = F.filter(F.split("text", " "), lambda w: w != "")
    index = search.postings(docs, "id", words, rows=300, blocks=30)
    laid = index.groupBy("term", "block").agg(F.count("*").alias("n"))
    assert laid.count() and laid._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
    asked = spark.createDataFrame([(1, "w1 the"), (2, "the w50 w3")], "q long, text string")
    want = {tuple(r) for r in search.ranked(search.postings(docs, "id", words), "id", asked, "q", words).select("q", "id", "score", "place").collect()}
    made.clear()
    blocks = search.block_postings(index, "id", asked=asked.select(F.explode(words).alias("term")))
    found, _ = search.pruned_blocks(blocks, asked, "q", words, "id", first=2)
    assert {tuple(r) for r in found.select("q", "id", "score", "place").collect()} == want
    assert all(set(df.columns) == {"_q", "block"} for name, df in made if name == "search_pairs")
    assert [df.count() <= 10 for name, df in made if name == "search_scored"] == [True, True]
    assert {r["term"] for r in blocks.select("term").distinct().collect()} <= {"w1", "the", "w50", "w3"}


def test_postings_of_many_terms_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(search, "MOST_PHRASES", 10)
    docs = spark.createDataFrame([(i, f"start{i} start{i % 7} other{i % 3} sta") for i in range(40)] + [(99, "start1 start123")], "id long, t string")
    words, asked = F.split("t", " "), spark.createDataFrame([(1, "start start1 sta"), (2, "start1"), (3, "other")], "q long, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search.ranked(search.postings(docs, "id", words), "id", asked, "q", words, top=50, prefix=5)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        got = {(r["q"], r["id"]): r["score"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    have = {r["id"]: r["t"].split() for r in docs.collect()}
    mean, bm = sum(map(len, have.values())) / len(have), {}
    for q, fits in ((1, lambda w: w.startswith("start") or w == "sta"), (2, lambda w: w == "start1"), (3, lambda w: w.startswith("other"))):
        for i, ws in have.items():
            for w in {w for w in ws if fits(w)}:
                df, n = sum(w in x for x in have.values()), ws.count(w)
                bm[q, i] = bm.get((q, i), 0) + math.log(1 + (len(have) - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
    assert got.keys() == bm.keys() and all(abs(got[k] - bm[k]) < 2e-6 for k in bm)
