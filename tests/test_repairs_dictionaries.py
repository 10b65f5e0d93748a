"""Stray quotes in JSON; corrections and phrases by automata, against plain loops."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import json_repair
from textloom.operators import dictionaries

WORD = st.text("abcé漢字 .«»", min_size=1, max_size=6).filter(str.strip)
#: Texts with words in quotes, which begin and end with a letter, so that no quote stands at an edge.
SAID = st.lists(st.tuples(WORD, st.booleans()), min_size=1, max_size=5).map(lambda ws: "x" + " ".join(f'"{w}"' if q else w for w, q in ws) + "y")
TREE = st.recursive(SAID | st.integers() | st.booleans() | st.none(), lambda t: st.lists(t, max_size=4) | st.dictionaries(st.text("abk", min_size=1, max_size=3), t, max_size=4), max_leaves=12)


@settings(max_examples=400, deadline=None)
@given(TREE, st.sampled_from([None, 2]))
def test_damaged_json_is_mended(tree, indent):
    whole = json.dumps({"all": tree, "end": [tree]}, ensure_ascii=False, indent=indent)
    assert json.loads(json_repair.mended(whole.replace('\\"', '"'))) == json.loads(whole)


CASES = {
    '{"a": "he said "no", and left"}': {"a": 'he said "no", and left'}, '{"a": "x "y"", "b": 1}': {"a": 'x "y"', "b": 1}, '["a "b" c", "d"]': ['a "b" c', "d"], '{"a "k" b": 1}': {'a "k" b': 1}, '{"a": "tab\\t \\"ok\\" "bad" x"}': {"a": 'tab\t "ok" "bad" x'},
    '{"a": {"b": "c "d" e"}, "f": ["g "h" i"]}': {"a": {"b": 'c "d" e'}, "f": ['g "h" i']}, '{"a": "see: "b": c"}': {"a": 'see: "b": c'}, '{"a": "(x "y")"}': {"a": '(x "y")'},
}


@pytest.mark.parametrize("broken", CASES)
def test_stray_quotes(broken):
    assert json.loads(json_repair.mended(broken)) == CASES[broken]


def test_what_cannot_be_mended_stays():
    for text in ("", "{", '{"a": ', "no json", '{"a": 1}', "[" * 100_000, '{"a" 1 "b"}'):
        assert json_repair.mended(text) == text


def test_quotes_between_chinese_letters_are_curled(spark):
    text = '{"a": "他说"好"。", "b": "x "y" z"}'
    assert json.loads(json_repair.mended(text, curly=True)) == {"a": "他说“好“。", "b": 'x "y" z'}
    got = spark.createDataFrame([(0, text), (1, None)], "i int, t string").select(json_repair.json_mended(F.col("t")).alias("x")).collect()
    assert json.loads(got[0]["x"])["a"] == '他说"好"。' and got[1]["x"] is None


@pytest.mark.parametrize("most_rows", [3, 1000])
def test_corrections_follow_each_other(spark, most_rows):
    r = random.Random(most_rows)
    word = lambda n: "".join(r.choice("ab") for _ in range(n))
    steps = [(i, word(r.randint(1, 4)) if i else "", r.choice([None, word(r.randint(0, 4))])) for i in range(25)]
    texts = [(i, word(r.randint(0, 60))) for i in range(60)] + [(98, ""), (99, None)]

    def by_loop(t):
        for _, a, b in steps:
            t = t.replace(a, b or "") if t and a else t
        return t

    d = spark.createDataFrame(texts, "i long, t string")
    got = {x["i"]: x["t"] for x in dictionaries.corrected(d, "t", spark.createDataFrame(r.sample(steps, 25), "pos int, before string, after string"), most_rows).collect()}
    assert got == {i: by_loop(t) for i, t in texts}


def test_corrections_of_a_key(spark):
    steps = spark.createDataFrame([("f.x", 2, "b", "c"), ("f.x", 1, "a", "b"), ("g.x", 1, "a", None), ("f.x", 0, "", "z")], "key string, pos int, before string, after string")
    d = spark.createDataFrame([("d/f.x", "ab.a"), ("g.x", "aba"), ("h.x", "ab"), ("f.x", None), (None, "a")], "path string, t string")
    got = dictionaries.corrected_by_key(d, F.element_at(F.split("path", "/"), -1), "t", steps)
    assert got.columns == ["path", "t"] and sorted(map(tuple, got.collect()), key=str) == sorted([("d/f.x", "cc.c"), ("g.x", "b"), ("h.x", "ab"), ("f.x", None), (None, "a")], key=str)


@pytest.mark.parametrize("most_rows", [2, 1000])
def test_phrases(spark, most_rows):
    phrases = [(1, "ab"), (2, "b"), (3, "ab"), (4, "abab"), (5, "َ"), (6, ""), (7, None), (8, "صَلاة")]
    texts = [(1, "xababx"), (2, "b"), (3, ""), (4, None), (5, "الصَّلاة و الصلاة")]
    strip = lambda t: "".join(c for c in t if c not in "ًٌٍَُِّْ")
    got = dictionaries.phrases_found(spark.createDataFrame(texts, "i long, t string"), "i", F.col("t"), spark.createDataFrame(phrases, "p long, x string"), "p", "x", most_rows)
    assert sorted((x["i"], x["p"]) for x in got.collect()) == sorted((i, p) for i, t in texts for p, x in phrases if t and x and strip(x) and strip(x) in strip(t))


def test_key_phrases(spark):
    known = spark.createDataFrame([("ab", "en", "quranic_echo"), ("cd", None, "prophetic_formula"), ("ef", "x", "other")], "phrase_ar string, phrase_en string, category string")
    d = spark.createDataFrame([(1, "abcdef"), (2, "zz")], "i long, t string")
    assert sorted(map(tuple, dictionaries.key_phrases(d, "i", F.col("t"), known).collect())) == [(1, "ab", "en", "quranic_echo"), (1, "cd", "", "prophetic_formula")]
    assert dictionaries.key_phrases(d, "i", F.col("t"), known.limit(0)).count() == 0
