"""Answers mended by rule."""

from pyspark.sql import functions as F

from textloom.operators import answers

SCHEMA = "i int, narrators array<struct<name_en:string,identity_confidence:string,ambiguity_note:string,word_ranges:array<struct<word_start:int,word_end:int>>>>, chunks array<struct<word_start:int,word_end:int>>, topics array<string>"


def test_faults_with_one_cure(spark):
    rows = [
        (0, [("A", "likely", "", [(1, 1), (2, 3)]), (None, "ambiguous", None, None), ("B", "definite", None, [(4, 4)]), None], [(0, 4), (4, 9)], ["x", "bad", "y", "worse"]), (1, None, None, None), (2, [], [(0, 10)], ["bad"]), (3, [("C", "likely", "known", [(None, None)])], [(0, 9), (0, 10)], []),
    ]
    got = {r["i"]: r for r in answers.mended(spark.createDataFrame(rows, SCHEMA), F.lit(10), "narrators", "chunks", "topics", ["x", "y"]).collect()}
    assert got[0]["fixes"] == ["auto-filled ambiguity_note for A", "auto-filled ambiguity_note for ?", "corrected last chunk word_end from 9 to 10", "corrected narrator A word_end from 1 to 2", "corrected narrator B word_end from 4 to 5", "removed invalid topics: bad, worse"]
    people = got[0]["narrators"]
    assert [p and p["ambiguity_note"] for p in people] == [answers.NOTE, answers.NOTE, None, None] and [tuple(w) for w in people[0]["word_ranges"]] == [(1, 2), (2, 3)] and people[1]["word_ranges"] is None
    assert [tuple(c) for c in got[0]["chunks"]] == [(0, 4), (4, 10)] and got[0]["topics"] == ["x", "y"]
    assert got[1]["fixes"] == [] and got[1]["narrators"] is None and got[1]["chunks"] is None and got[1]["topics"] is None
    assert got[2]["fixes"] == ["removed all invalid topics: bad"] and got[2]["topics"] is None
    assert got[3]["fixes"] == [] and got[3]["topics"] == [] and [tuple(c) for c in got[3]["chunks"]] == [(0, 9), (0, 10)]


def test_words_are_marked(spark):
    d = spark.createDataFrame([(0, ["(قال،", "قال", "وقال", "x\nقال", "…"], ["قال وقال"]), (1, None, None), (2, [], [])], "i int, w array<string>, t array<string>")
    got = {r["i"]: r for r in answers.marked(d, "w", "t", {"قال": "قَالَ", "x": "x"}).collect()}
    assert got[0]["w"] == ["(قَالَ،", "قَالَ", "وقال", "x\nقال", "…"] and got[0]["n_fixed"] == 2 and got[0]["t"] == ["قَالَ وقَالَ"] and got[0]["text"] == " ".join(got[0]["w"])
    assert got[1]["w"] is None and got[1]["n_fixed"] == 0 and got[2]["text"] is None
