"""Several encodings in one column; groups merged and ids redirected."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import merging_groups as groups
from textloom.operators import variants


def parsed(spark, *values):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], "i long, j string").select("i", F.try_parse_json("j").alias("v"))


def of(spark, make, *values):
    return [r["x"] for r in parsed(spark, *values).select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_grades_of_two_encodings(spark):
    rows = parsed(spark, {"a": "صحيح", "b": "", "c": None, "d": 5, "e": "DAIF"}, ["A b: <span> Hasan </span> - x", "A b: <span>majhul</span>", "no", 7, ": <span>x</span>", "x: <span></span>"], "text", "{bad", None, [], {})
    got = {(r["i"], r["scholar"]): r["grade"] for r in variants.graded(rows, "v", "i").collect()}
    assert got == {(0, "a"): "sahih", (0, "d"): "other", (0, "e"): "da'if", (1, "A b"): "majhul"}


def test_surfaces_of_either_version(spark):
    got = of(spark, variants.surfaces, {"chunks": [{"arabic_text": " «كلمة» , b. "}, "odd", {"arabic_text": None}], "word_analysis": [{"word": "no"}]}, {"chunks": [{"arabic_text": " "}], "word_analysis": [{"word": "a."}, 5, {"word": "!"}, {"word": 3}]}, {"chunks": "x"}, [1], None)
    assert got == [["كلمة", "b"], ["a"], [], [], []]


def test_tagged_words_by_priority(spark):
    got = of(spark, variants.tagged_words, {"word_tags": [["a", "V"], ["b"], "c", ["d", "N", 1]], "chunks": [{"arabic_text": "x"}]}, {"word_tags": [], "word_analysis": [{"word": "a", "pos": "V"}, {"word": "b"}]}, {"chunks": [{"arabic_text": "x  y"}, {}]}, {})
    assert [[tuple(p) for p in x] for x in got] == [[("a", "V"), ("d", "N")], [("a", "V")], [("x", "N"), ("y", "N")], []]


def test_response_fields_have_their_types(spark):
    whole, bare, odd = of(spark, variants.response_fields, {"has_chain": True, "tags": ["t"], "content_type": "c", "topics": ["p", 2], "chunks": [{"arabic_text": "a", "word_start": 1, "translations": {"en": "e"}}], "translations": {"en": {"summary": "s", "key_terms": {"k": "v"}}, "ur": 1}, "related_quran": [{"ref": "1:1"}]}, {}, {"has_chain": "no?", "tags": "x", "chunks": {}, "translations": {"en": "x"}})
    assert (whole["has_chain"], whole["tags"], whole["content_type"], whole["topics"]) == (True, ["t"], "c", ["p", "2"]) and whole["chunks"][0].asDict() == {"chunk_type": "", "arabic_text": "a", "translations": {"en": "e"}}
    assert whole["en"].asDict() == {"summary": "s", "seo_question": "", "key_terms": {"k": "v"}} and len(whole["related_quran"]) == 1
    for x in (bare, odd):
        assert (x["has_chain"], x["tags"], x["content_type"], x["topics"], x["chunks"], x["en"].asDict(), x["related_quran"]) == (False, [], "", [], [], {"summary": "", "seo_question": "", "key_terms": {}}, [])


def test_paths_of_responses(spark):
    d = parsed(spark, {"verse_path": "/books/x:1"}, {"verse_path": ""}, {}, {"verse_path": 3}).withColumn("f", F.element_at(F.array(*map(F.lit, ["d/a.json", "d/al-kafi_1_2_3.json", "book.json", "b_1.x.json"])), (F.col("i") + 1).cast("int")))
    assert [r["p"] for r in d.select("i", variants.response_path(F.col("v"), F.col("f")).alias("p")).orderBy("i").collect()] == ["/books/x:1", "/books/al-kafi:1:2:3", "/books/book", "/books/b:1.x"]


def test_shapes(spark):
    rows = parsed(spark, {"k": 1}, {"k": "x"}, {"k": 2}, [1]).withColumn("g", F.when(F.col("i") < 3, "a"))
    got = {(r["g"], r["shape"]): (r["n"], r["whole"]) for r in variants.shapes(rows, "v", "g").collect()}
    assert got == {("a", "OBJECT<k: BIGINT>"): (2, "OBJECT<k: VARIANT>"), ("a", "OBJECT<k: STRING>"): (1, "OBJECT<k: VARIANT>"), (None, "ARRAY<BIGINT>"): (1, "ARRAY<BIGINT>")}


@pytest.mark.parametrize("seed", range(3))
def test_redirects_end(spark, seed):
    r = random.Random(seed)
    links = {i: i + 1 for i in range(0, 70)} | {i: r.randrange(200) for i in range(100, 160)} | {200: 201, 201: 202, 202: 200, 203: 201}
    rows = [*links.items(), (1, None), (None, 5), (300, 300), (10, 99)]

    def end(i):
        seen = set()
        while i in links and links[i] != i:
            if i in seen:
                return None
            seen.add(i)
            i = links[i]
        return i

    got = {x["a"]: x["final"] for x in groups.followed(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    assert got == {i: end(i) for i, to in links.items() if to != i}
    assert groups.followed(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


ENTRIES = [(1, "k", "one", ["x", "one", "y"], None, " ", [11]), (2, "k", " two ", ["y", "z", ""], "r2", "en2", [12, 11]), (3, "k", "three", None, "r3", None, None), (4, None, "four", ["x"], None, "", []), (5, "m", "one", [], "r5", None, [2])]


def entries(spark):
    return spark.createDataFrame(ENTRIES, "id long, k string, name string, variants array<string>, role string, en string, old array<long>")


def test_groups_are_merged(spark):
    d = entries(spark)
    members = groups.merged_into(d, F.col("k"), "id", [F.size(F.coalesce("variants", F.array().cast("array<string>"))), F.lit(0)])
    assert {r["id"]: r["winner"] for r in members.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}  # 1 and 2 have three variants each
    f = {r["winner"]: (r["n_members"], r["role"], r["en"]) for r in groups.merged_fields(d, members, "id", ["role", "en"]).collect()}
    assert f == {1: (3, "r2", "en2"), 4: (1, None, None), 5: (1, "r5", None)}
    rows = groups.merged_variants(d, members, "id", "name", "variants").where("winner = 1").collect()
    assert [r["variant"] for r in sorted(rows, key=lambda r: (r["from_id"] != 1, r["from_id"], r["pos"]))] == ["x", "one", "y", "two", "z", "three"]
    assert {r["id"]: r["final"] for r in groups.all_redirects(d, members, "id", "old").collect()} == {2: 1, 3: 1, 11: 1, 12: 1}


def test_keys_of_variants(spark):
    d = spark.createDataFrame([(1, "أَحْمَد ( عليه السلام )", ["احمد", ""]), (2, "الشيخ", None)], "id long, name string, variants array<string>")
    got = {tuple(r) for r in groups.variant_keys(d, "id", "name", "variants", ["الشيخ"]).collect()}
    assert ("canonical", "احمد", 1) in got and ("normalized", "احمد", 1) in got and ("exact", "احمد", 1) in got and ("exact", "الشيخ", 2) in got and not any(k[0] == "canonical" and k[2] == 2 for k in got)
