"""What is made on the way stays small where tables are large."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.functions import arabic
from textloom.functions.text import tokens
from textloom.operators import chapters, counting, linking, matching, search


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_a_title_make_no_pairs(spark, monkeypatch):
    made, stage = {}, linking.stage
    monkeypatch.setattr(linking, "stage", lambda df, name: made.setdefault(name, stage(df, name)))
    rows = [(i, "ab"[i % 2], "one and the same title") for i in range(60)] + [(100 + i, "c", f"other{i} words{i} the") for i in range(20)]
    found = linking.related(spark.createDataFrame(rows, "id long, g string, t string"), "id", "g", tokens(F.col("t"))).collect()
    assert made["tfidf_pairs"].count() == 0
    assert {(r["id"], r["other"], r["place"]) for r in found if r["id"] < 2} == {(i, 2 * k + 1 - i, k + 1) for i in (0, 1) for k in range(5)}
    assert len(found) == 300 and {r["similarity"] for r in found} == {1.0}


def test_few_keywords_need_no_runs_of_letters(spark):
    texts = spark.createDataFrame([(1, "the cat and the dog"), (2, "una"), (3, None), (4, "")], "id long, t string")
    words = spark.createDataFrame([("the ", "en"), ("and ", "en"), ("un", "es"), ("na", "fr")], "k string, topic string")
    votes = matching.voted(texts, "id", F.col("t"), words, "k", "topic")
    assert {tuple(r) for r in votes.collect()} == {(1, "en", 2, 1), (2, "es", 1, 1), (2, "fr", 1, 2)}
    assert "regexp_extract_all" not in plan(votes)


def test_few_and_many_phrases_agree(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"xab{i} cd{i % 7} e") for i in range(50)], "id long, t string")
    phrases = spark.createDataFrame([(i, p) for i, p in enumerate(["ab1", "cd3 e", "", "e", "zz", "b4", " "])], "pid long, p string")
    one = {tuple(r) for r in matching.contained(texts, "id", F.col("t"), phrases, "pid", "p").collect()}
    monkeypatch.setattr(matching, "FEW_PHRASES", 0)
    assert one == {tuple(r) for r in matching.contained(texts, "id", F.col("t"), phrases, "pid", "p").collect()} and one


def test_postings_travel_no_more_for_what_is_counted_by_document(spark):
    docs = spark.createDataFrame([(i, f"the word{i % 3} the") for i in range(30)], "id long, t string")
    index = search.postings(docs, "id", tokens(F.col("t")))
    by_document = index.groupBy("id").agg(F.sum("n").alias("n"))
    assert {r["n"] for r in by_document.collect()} == {3}
    assert by_document._jdf.queryExecution().sparkPlan().toString().count("REPARTITION_BY_COL") == 1
    assert by_document._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
    asked = docs.where("id < 4").select("id", "t")
    plain = lambda rows: {(r["q"], r["id"], r["score"]) for r in rows.collect()}
    asked = asked.withColumnRenamed("id", "q")
    given = search.lengths(docs, "id", tokens(F.col("t")))
    assert plain(search.ranked(index, "id", asked, "q", tokens(F.col("t")))) == plain(search.ranked(index, "id", asked, "q", tokens(F.col("t")), docs=given))


def test_tasks_of_chapters_dont_grow_with_the_table(spark):
    links = spark.createDataFrame([(i % 2, i, i % 5) for i in range(40)], "c int, i int, m int")
    clusters = links.selectExpr("i", "i % 3 as k").distinct()
    few, many = (chapters.corroboration(links, "c", "i", "m", clusters, "k", rows=rows) for rows in (40, 9_000_000))
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()} == {(c, m, 4, 3) for c in (0, 1) for m in range(5)}
    assert "RepartitionByExpression [c" in plan(many) and ", 9" in plan(many)
    of = chapters.shared_members(links, "i", "m", clusters, "k", rows=9_000_000)
    assert "RepartitionByExpression [k" in plan(of) and ", 9" in plan(of)


def test_names_are_folded_in_one_pass(spark):
    x = spark.createDataFrame([("  \u0640\u0623\u0628\u064e \t\u0649\u060c  \u0629\u061f\u00a0",), (" a  b ",), ("\u200b",), (None,)], "t string")
    folded = x.select(arabic.normalize(F.col("t")).alias("n"))
    assert [r["n"] for r in folded.collect()] == ["\u0627\u0628 \u064a, \u0647?", "a b", "", None]
    assert plan(folded).count("translate(") == 1


def test_words_are_counted_by_text_in_place(spark):
    rows = spark.createDataFrame([(1, "a b a"), (1, "a"), (2, "a c"), (None, "c"), (3, None)], "id long, t string")
    counts = counting.surface_counts(rows, "id", tokens(F.col("t")))
    assert {tuple(r) for r in counts.collect()} == {("a", 4, 2, 1), ("b", 1, 1, 1), ("c", 2, 1, 2)}
    assert "RepartitionByExpression [id" in plan(counts)


def brute_related(rows, threshold=0.3, top=5):
    words = {i: Counter(t.split()) for i, g, t in rows if t}
    df = Counter(w for c in words.values() for w in c)
    v = {i: {w: n / c.total() * (math.log(len(rows) / (df[w] + 1)) + 1) for w, n in c.items()} for i, c in words.items()}
    norm = {i: math.sqrt(sum(x * x for x in u.values())) for i, u in v.items()}
    group, out = {i: g for i, g, _ in rows}, set()
    for i in v:
        near = [(-round(sum(x * v[j].get(w, 0) for w, x in v[i].items()) / norm[i] / norm[j], 6), j) for j in v if None not in (group[i], group[j]) and group[i] != group[j]]
        out |= {(i, j, -s, k + 1) for k, (s, j) in enumerate(sorted(x for x in near if -x[0] >= threshold)[:top])}
    return out


@pytest.mark.parametrize("terms, pairs", [(1_500_000, 1 << 20), (120, 1 << 20), (60, 3)])
def test_pairs_of_titles_stay_in_their_task(spark, monkeypatch, terms, pairs):
    monkeypatch.setattr(linking, "TERMS", terms, raising=False)
    monkeypatch.setattr(linking, "PAIRS", pairs, raising=False)
    made, stage = {}, linking.stage
    monkeypatch.setattr(linking, "stage", lambda df, name: made.setdefault(name, stage(df, name)))
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", None]), " ".join(r.choice(["the", "of"]) if r.random() < 0.4 else f"w{min(int(r.expovariate(0.2)), 30)}" for _ in range(r.randint(0, 6)))) for i in range(150)]
    rows += [(200 + i, g, f"one and the same x{i % 7}") for i, g in enumerate("aaaaaaaaaaaabbbbbbbcd" * 2)] + [(300, "a", None)]
    found = linking.related(spark.createDataFrame(rows, "id long, g string, t string"), "id", "g", F.filter(F.split(F.coalesce("t", F.lit("")), " "), lambda w: w != ""))
    assert {tuple(x) for x in found.select("id", "other", "similarity", "place").collect()} == brute_related(rows)
    by_class = [x["n"] for x in made["tfidf_pairs"].groupBy(made["tfidf_pairs"].columns[0]).agg(F.count("*").alias("n")).collect()]
    assert max(by_class) <= 10 * (made["title_blocks"].count() if "title_blocks" in made else 1)
