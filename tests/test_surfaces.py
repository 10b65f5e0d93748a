"""Pages of word forms on small tables."""

from pyspark.sql import functions as F

from textloom.operators import surfaces


def test_glosses_agree_with_the_part_of_speech(spark):
    senses = [("Adjective", " a "), ("verb", "v"), (None, "n")]
    rows = [("verb", senses), ("adj.act", senses), ("noun", senses), ("prep", senses), ("odd", senses), (None, senses), ("noun", []), ("noun", None)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, pos string, s array<struct<pos:string,gloss:string>>")
    assert [r["g"] for r in d.select("i", surfaces.aligned_gloss(F.col("pos"), F.col("s")).alias("g")).orderBy("i").collect()] == ["v", "a", "a", "", "", "", "", ""]


def test_pages_and_items(spark):
    said = spark.createDataFrame([("w", p) for p in (9, 3, 3, 5, 7, 1, 2)] + [("x", 1), ("y", 1)], "s string, p long")
    a = spark.createDataFrame([("w", "lm", "k.#.b", "verb", "0", "wa"), ("w", "lz", "k.#.b", "verb", "0", "na"), ("x", "l", "FOREIGN", "foreign", None, None), ("y", None, "a.b", None, "al", "")], "s string, lemma string, root string, pos string, prc0 string, prc1 string")
    pages = surfaces.surface_pages(said, "s", "p", a)
    rows = {r["s"]: r for r in pages.collect()}
    assert (rows["w"]["n"], rows["w"]["n_paths"], rows["w"]["paths"]) == (7, 6, [1, 2, 3, 5, 7])
    assert rows["w"]["morphology"].asDict() == {"lemma_slug": "lm", "root": "k.#.b", "root_slug": "k-_-b", "pos": "V", "pos_camel": "verb", "clitics": {"prc1": "wa"}} and (rows["w"]["lemma_link"], rows["w"]["root_link"]) == ("/words/lemmas/lm", "/words/roots/k-_-b")
    assert rows["x"]["morphology"] is None and rows["x"]["lemma_link"] is None and rows["y"]["morphology"]["clitics"] == {"prc0": "al"} and rows["y"]["root_link"] == "/words/roots/a-b"
    lemmas = spark.createDataFrame([("lm", {"en": "t"}, [("verb", "said")])], "lemma string, translations map<string,string>, senses array<struct<pos:string,gloss:string>>")
    contexts = spark.createDataFrame([("x", ["a x b"])], "s string, contexts array<string>")
    items = {r["s"]: (r["lemma_translations"], r["en_gloss"], r["contexts"]) for r in surfaces.surface_items(pages, "s", lemmas, contexts).collect()}
    assert items == {"w": ({"en": "t"}, "said", None), "x": (None, "", ["a x b"]), "y": (None, "", None)}
