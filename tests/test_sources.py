import json

from pyspark.sql import functions as F

from textloom.sources import readers, writers


def test_documents_and_verses(spark, tmp_path):
    book = {"index": "b", "kind": "complete_book", "data": {"path": "/books/b", "chapters": [{"path": "/books/b:1", "verses": [{"path": "/books/b:1:1", "text": ["x"], "part_type": "Hadith"}, {"path": "/books/b:1:2", "text": ["y"]}]}]}}
    (tmp_path / "a.json").write_text(json.dumps(book))
    (tmp_path / "bad.json").write_text("{oops")
    read = readers.documents(spark, str(tmp_path), readers.BOOK)
    assert sum(r["_bad"] is not None for r in read.collect()) == 1
    assert [r["path"] for r in readers.verses(read.where("_bad is null")).orderBy("verse_pos").collect()] == ["/books/b:1:1", "/books/b:1:2"]


def test_last_response_wins(spark, tmp_path):
    for name, model in (("a", "old"), ("b", "new")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"verse_path": "/books/b:1", "ai_attribution": {"model": model}, "result": {"tags": [1]}}))
    (tmp_path / "c.json").write_text(json.dumps({"result": {}}))
    assert [r[0] for r in readers.responses(spark, str(tmp_path)).select("ai_attribution.model").collect()] == ["new"]


def test_lines_jsonl_features(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# c\nfirst\n\nsecond\n")
    assert [tuple(r) for r in readers.numbered_lines(spark, str(tmp_path / "t.txt")).orderBy("n").collect()] == [(1, "first"), (2, "second")]
    (tmp_path / "w.jsonl").write_text('{"word": "a", "pos": "n"}\n{bad\n{"word": "a", "pos": "v"}\n')
    assert readers.grouped_jsonl(spark, str(tmp_path / "w.jsonl"), "word", "word string, pos string").select(F.size("entries")).first()[0] == 2
    (tmp_path / "q.tsv").write_text("# x\n(1:2:3:4)\tbi\tP\tPREFIX|LEM:x:y\n")
    row = readers.feature_table(spark, str(tmp_path / "q.tsv")).first()
    assert (row["verse"], row["features"]) == (2, {"PREFIX": "1", "LEM": "x:y"})


def test_html_sections_and_xml(spark, tmp_path):
    pages = spark.createDataFrame([(1, "<h2>One</h2><p>a <b>b</b></p><p>c</p><h2>Two</h2>")], "id int, html string")
    got = readers.sections(readers.html_elements(pages, "id", "html"), "id", "kind = 'heading'")
    assert [tuple(r) for r in got.orderBy("section").collect()] == [(1, 1, "One", "a b c"), (1, 2, "Two", "")]
    (tmp_path / "s.xml").write_text('<r><sura index="1" ayas="7"/><sura index="2" ayas="9"/></r>')
    assert readers.xml_rows(spark, str(tmp_path / "s.xml"), "sura", "_index int, _ayas int").agg(F.sum("_ayas")).first()[0] == 16


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("en", 1, None), ("fr", 2, "x")], "lang string, n int, t string")
    writers.write_documents(d, str(tmp_path / "docs"), ["lang"])
    assert '"t"' not in next((tmp_path / "docs" / "lang=en").glob("*.json")).read_text()
    writers.write_per_language(d, str(tmp_path / "langs"))
    writers.write_per_language(d.where("lang = 'fr'").withColumn("n", F.lit(5)), str(tmp_path / "langs"))
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "langs")).collect()) == [1, 5]
    assert writers.manifest(d, "lang", "n").first()[0] == '{"en":1,"fr":2}'
