"""Rules on nested documents, each violation with its path."""

import json

from textloom.operators import validating as v


def told(spark, rules, *docs):
    rows = [(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return sorted(tuple(r) for r in v.violations(spark.createDataFrame(rows, "i int, doc string"), "i", "doc", rules).collect())


def test_books_of_any_depth(spark):
    deep = {"path": "/books/a", "titles": {"en": "t"}, "verses": [{"local_index": 1, "text": ["x"], "path": "/books/a:1"}]}
    for _ in range(12):
        deep = {"titles": {"en": "t"}, "chapters": [{"titles": {"en": "t"}}, deep]}
    deepest = ".data" + ".chapters[1]" * 12
    broken = json.loads(json.dumps(deep).replace('"local_index": 1', '"local_index": null').replace("/books/a:1", "x"))
    assert told(spark, v.BOOK_RULES, {"kind": "verse_list", "index": 1, "data": deep}, {"kind": "verse_list", "index": 1, "data": broken}) == [(1, f"{deepest}.verses[0]", "error", "path isn't under /books/: x")]


def test_wrappers_and_texts_that_are_none(spark):
    got = told(spark, v.BOOK_RULES, "{bad", "", None, [1], "3", {"kind": "nope", "data": None}, {"data": {"titles": {"en": "x"}}, "index": 0, "kind": "chapter_list"})
    assert got == sorted([(0, "", "error", "invalid JSON"), (1, "", "error", "invalid JSON"), (2, "", "error", "invalid JSON"), (3, "", "error", "no object but array"), (4, "", "error", "no object but bigint"), (5, "", "error", "missing index"), (5, "", "error", "unknown kind: nope")])


def test_verses(spark):
    verses = [
        {"part_type": "Heading"}, {"local_index": 1, "text": ["a"], "narrator_chain": {"parts": [{"kind": "narrator", "path": "/people/x"}, {"kind": "plain", "path": "y"}, {"kind": "narrator", "path": "/people/narrators/1"}]}},
        {"local_index": 1, "text": [], "relations": {"a": "/books/1", "b": ["/books/1", "c", "d"], "e": ["/books/2"]}}, {"local_index": 2, "text": ["b"]}, {"local_index": 2, "text": ["c"], "part_type": "Odd"}, {"part_type": "Heading", "local_index": 1, "path": "z"},
    ]
    doc = {"kind": "verse_list", "index": 1, "data": {"titles": {"en": "t"}, "verse_count": 6, "verses": verses, "nav": {"prev": "/books/1", "next": "2", "up": ""}}}
    assert told(spark, v.BOOK_RULES, doc) == sorted([
        (0, ".data", "warning", "verse_count is 6, but there are 4"), (0, ".data", "error", "verses: local_index more than once: 1, 2"), (0, ".data.nav", "error", "next isn't under /books/: 2"), (0, ".data.verses[2]", "warning", "no text"),
        (0, ".data.verses[2]", "error", "relations: a is no array; b isn't under /books/: c"), (0, ".data.verses[1].narrator_chain.parts[0]", "error", "path isn't under /people/narrators/: /people/x"),
    ])


def test_people(spark):
    of = lambda **data: {"kind": "person_content", "index": 1, "data": data}
    got = told(spark, v.PERSON_RULES, of(index=1, titles={"en": "x"}, path="/people/narrators/1", verse_paths=["/books/1"]), of(titles={}, path="x", verse_paths=["/books/1", "y", "z"]), {"kind": "person_list", "data": {}})
    assert got == sorted([(1, "", "error", "missing index"), (1, "", "error", "path isn't under /people/narrators/: x"), (1, "", "error", "verse_paths isn't under /books/: y")])


def test_own_rules(spark):
    rules = [v.required(r".*\.words\[\*\]", "slug"), v.one_of("", "kind", "word"), v.all_prefixed("", "refs", "r")]
    got = told(spark, rules, {"kind": "word", "refs": ["r1"], "pages": [{"words": [{"slug": 1}, {}]}, {"words": [[{}]]}]}, {"kind": "x", "refs": ["s", 5]})
    assert got == [(0, ".pages[0].words[1]", "error", "missing slug"), (1, "", "error", "refs isn't under r: s"), (1, "", "error", "unknown kind: x")]
