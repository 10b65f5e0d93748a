from pyspark.sql import functions as F

from textloom.functions import arabic, nested, repairs, text, wiki
from textloom.operators import chapters, documents, lexicon, nesting, resolving

WIKI = "{{Infobox {{x}}\n| Birth = [[250 AH|250/864]]\n|Teachers= Ali, [[Hasan]]; '''Zayd'''<br/>Omar\n| Status = unknown\n}}\n[[Category:A]]\n\n== Life ==\n\nHe was a '''trustworthy''' narrator of [[Kufa|the city]], who taught many of those who came.<ref>x</ref>"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_wikitext(spark):
    w = F.lit(WIKI)
    r = one(spark, wiki.infobox_field(w, "Born", "birth"), wiki.listed_names(w, "Teachers"), wiki.reliability(w), wiki.summary(w), wiki.without_templates(F.lit("a{{b{{c}}d}}e}f")))
    assert r[0] == "250/864" and r[1] == ["Ali", "Hasan", "Zayd", "Omar"] and r[2] == "Thiqah (Trustworthy)"
    assert r[3] == "He was a trustworthy narrator of the city, who taught many of those who came." and r[4] == "ae}f"


def test_wikitext_odd_cases(spark):
    w = F.lit("{{Infobox| Grade = '''[[Hasan|good]]''' | Teachers = * [[A|B]]; C، D <BR/> - E\n}} see [[open and [[File:x.png|a]] [[k]]")
    r = one(spark, wiki.infobox_field(w, "grade"), wiki.listed_names(w, "Teachers"), wiki.without_markup(w), wiki.with_links(w, False, ("file",)), wiki.without_notes(F.lit('a<ref name="x"/>b<ref>c<b>d</b></ref>e <i>f</i> 1 < 2')), wiki.without_markup(F.lit(None).cast("string")))
    assert r[0] == "good" and r[1] == ["B", "C", "D", "E"] and r[2].endswith("see [[open and a k") and r[3].endswith("see [[open and  [[k]]") and r[4] == "abe f 1 < 2" and r[5] is None
    told = [one(spark, wiki.reliability(F.lit(x)))[0] for x in ("He is thiqah.", "a Da'if man", "Hasan of Kufa", "Hasan as a narrator", "nothing", "majhul\nthiqa", "{{x\n|Status=Known\n}} majhul")]
    assert told == ["Thiqah (Trustworthy)", "Da'if (Weak)", None, "Hasan (Good)", None, "Thiqah (Trustworthy)", "Known"]


def test_markdown(spark):
    of = lambda x: one(spark, wiki.markdown(F.lit(x)))[0]
    assert of("# T\n\n**b** and *i* [x](http://y)\n\n- one\n- two\n\n```arabic\nنص\n```") == '<h1>T</h1>\n<p><strong>b</strong> and <em>i</em> <a href="http://y">x</a></p>\n<ul>\n<li>one</li>\n<li>two</li>\n</ul>\n<div class="tafsir-arabic" lang="ar" dir="rtl">نص</div>'
    assert of("a * b * c `x *y* **z**` d * e") == "<p>a * b * c <code>x *y* **z**</code> d * e</p>"
    assert of("<script>1</script> & [x](javascript:1) `open") == "<p>&lt;script&gt;1&lt;/script&gt; &amp; [x](javascript:1) `open</p>"
    assert of("1. *a*\n2. b\n\n```py\nx\n\n<y>\n```\nend") == "<ol>\n<li><em>a</em></li>\n<li>b</li>\n</ol>\n<pre>x\n\n&lt;y&gt;</pre>\n<p>end</p>"


def test_repairs(spark):
    s = lambda *xs: F.array(*map(F.lit, xs))
    r = one(
        spark, repairs.first_match(F.lit("invalid topic: x"), [(["word"], "words"), (["topic"], "topics")], "validation"), repairs.mapped_values(s("a", "z", "m", "a"), ["a", "b"], {"m": "b"}), repairs.mapped_values(s("z"), ["a"], {}, default="a"),
        repairs.replaced_words(s("(wrd).", "ok", "..."), {"wrd": "word"}, "().,"), repairs.length_flag(F.lit("a b c d"), F.lit("x")), repairs.length_flag(F.lit("a"), F.lit("x y z")),
        repairs.type_flag(F.lit("matn"), F.lit("وروى علي"), s("x")), repairs.type_flag(F.lit("isnad"), F.lit("علي"), s("زيد")), repairs.verified(F.lit("abc"), F.lit("abd")), repairs.custom_id(F.lit("b:1:2__ur")),
        repairs.translation_flags(F.lit("word word"), F.lit("نص"), F.lit(True), F.lit(False)), repairs.contains_any(F.lit(None).cast("string"), ["a"]),
        repairs.shape(s("matn"), F.lit(""), s("x"), F.lit(False), F.lit(3)), repairs.quotes_escaped(F.lit('{"a": "b"c"}')),
    )
    assert r[0] == "topics" and r[1] == (["a", "b"], 2) and r[2] == (["a"], 2) and r[3] == ["(word).", "ok", "..."]
    assert r[4] == "short" and r[5] is None and r[6] == "opens_like_chain" and r[7] == "no_narrator" and r[8] == (False, "at 2") and tuple(r[9]) == ("/books/b:1:2", "ur")
    assert r[10].echo and r[10].length and not r[11] and r[12] == "short_matn_only" and r[13] == '{"a": "b\\"c"}'
    df = spark.createDataFrame([((1, "x", "y"),)], "r struct<id:int,a:string,b:string>")
    assert tuple(df.select(repairs.without_verified(F.col("r"), {"a": repairs.verified(F.col("r.a"), F.lit("x")), "b": repairs.verified(F.col("r.b"), F.lit("z"))}).alias("r")).first()[0]) == (1, None, "y")


def test_words_of_a_lexicon(spark):
    r = one(
        spark, lexicon.role_key(F.lit("p"), F.lit("3"), F.lit("m"), F.lit("s"), F.lit("verb")), lexicon.role_key(F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit("adj.act")), lexicon.pos_name(F.lit("noun_prop")), lexicon.pos_name(F.lit(None).cast("string")), lexicon.root_slug(F.lit("q.#.l")), lexicon.root_slug(F.lit("FOREIGN")),
        lexicon.rendered_slots(F.create_map(F.lit("prc1"), F.lit("bi"), F.lit("prc2"), F.lit("zz"), F.lit("enc0"), F.lit("hu")), ["prc2", "prc1"], ["enc0"], {"bi": ("bi-", "with"), "hu": ("-hu", "his")}), lexicon.pos_without_suffix(F.lit("verb.act")),
    )
    assert r[:6] == ("past_3ms", "active_participle", "N", "N", "q-_-l", None) and r[6] == 'proclitics: zz "unknown clitic" + bi- "with"; enclitics: -hu "his"' and r[7] == "verb"
    senses = spark.createDataFrame([([("verb", [("say", ["a", "b", "c"]), (" ", [])]), ("noun", [("word", [])])],)], "e array<struct<pos:string,senses:array<struct<gloss:string,examples:array<string>>>>>")
    assert [tuple(x) for x in senses.select(lexicon.merged_senses(F.col("e"))).first()[0]] == [("verb", "say", ["a", "b"]), ("noun", "word", [])]
    assert one(spark, lexicon.distinct_in_order(F.array(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("a"), F.lit("c")))))[0] == ["b", "a", "c"]


def test_documents_taken_apart(spark):
    df = spark.createDataFrame([({"en": ("s", None), "ur": ("t", "k")}, [["w", "N", "x", "a", "b"], ["short"]], {"en.a": "A", "en.t": "T"})], "m map<string,struct<summary:string,key:string>>, w array<array<string>>, t map<string,string>")
    r = df.select(documents.lean_maps(F.col("m"), ["summary", "key"]), documents.slotted_words(F.col("w"), ["en", "ur"]), documents.default_text(F.col("t"), F.lit("en.z"), "en.", "en.t")).first()
    assert r[0].summary == {"en": "s", "ur": "t"} and r[0].key == {"ur": "k"} and [tuple(x) for x in r[1]] == [("w", "N", {"en": "a", "ur": "b"})] and r[2] == "A"
    chunks = spark.createDataFrame([([("a",), ("b",)], ["x"])], "c array<struct<ar:string>>, t array<string>")
    assert [tuple(x) for x in chunks.select(documents.aligned_texts(F.col("c"), F.col("t"), "en")).first()[0]] == [("a", "x"), ("b", None)]


def test_first_seen(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 9), ("c", 1), (None, 0)], "n string, at int")
    assert {r["n"]: r["id"] for r in chapters.first_seen_ids(df, "n", [F.col("at")]).collect()} == {"c": 1, "b": 2, "a": 3}


def test_nested_values(spark):
    s = lambda *xs: F.array(*map(F.lit, xs))
    m = lambda **kw: F.create_map(*[F.lit(x) for pair in kw.items() for x in pair])
    span = lambda a, b: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"))
    chunk = lambda k, t: F.struct(F.lit(k).alias("kind"), F.lit(t).alias("text"))
    r = one(
        spark, nested.kept_over(m(a="old", b=""), m(a="new", b="new", c="new")), nested.joined_slice(s("a", "b", "c"), F.lit(1), F.lit(3), F.lit("en")), nested.joined_slice(s("a", "b"), F.lit(0), F.lit(2), F.lit("zh")),
        nested.joined_kind(F.array(chunk("x", "a"), chunk("y", "b"), chunk("x", "c")), "x"), nested.contiguous(F.array(span(3, 4), span(7, 9))), nested.violations(nested.rule(F.lit(True), "f", "error", "m"), nested.rule(F.lit(False), "g", "error", "n")),
    )
    assert r[0] == {"a": "old", "b": "new", "c": "new"} and r[1:4] == ("b c", "ab", "a c") and [tuple(x) for x in r[4]] == [(0, 4), (4, 9)] and [tuple(x) for x in r[5]] == [("f", "error", "m")]


def test_arabic_keys(spark):
    a = lambda f, *xs: [f(F.lit(x)) for x in xs]
    r = one(spark, *a(arabic.normalize_key, " قَالَۖ "), *a(arabic.strip_wide_marks, "قَالَۭ"), *a(arabic.normalize_without_category_mn, "إِلَى"), *a(arabic.count_arabic, "ab قال 1"), arabic.diacritics_status(F.lit("قال"), F.lit("قَال")), arabic.diacritics_status(F.lit("قَال"), F.lit("قُال")), arabic.diacritics_status(F.lit("x"), F.lit("")), arabic.diacritics_status(F.lit("x"), F.lit("x")), text.slug(F.lit(" Ab c.d! ")), text.safe_filename(F.lit('a/b:"c"')))
    assert "َ" not in r[0] + r[1] + r[2] and r[0] == "قال" and r[2] == "الي" and r[3] == 3 and r[4:] == ("added", "corrected", "missing", "validated", "ab-c-d", "a_b__c_")


def test_tables_of_chapters(spark):
    rows = spark.createDataFrame([("c", 2, "Hadith", "p2", "x"), ("c", 1, "Heading", "p1", "x"), ("d", 1, "Hadith", "p3", "y")], "chapter string, i int, kind string, path string, part string")
    assert {r.chapter: [tuple(x) for x in r.refs] for r in nesting.shells(rows, "chapter", "i", "kind", "path").collect()}["c"] == [(1, "Heading", None), (2, "Hadith", "p2")]
    assert {r.chapter: r.has_i for r in nesting.optional_levels(rows, "chapter", ["i"]).collect()} == {"c": True, "d": False}
    titles = nesting.outer_titles(spark.createDataFrame([("a", "A")], "path string, title string"), spark.createDataFrame([("b", "B")], "path string, title string"), "path")
    assert sorted(map(tuple, titles.collect())) == [("a", "A", None), ("b", None, "B")]
    assert nesting.unpivot_map(spark.createDataFrame([(1, {"en": "x"})], "k int, m map<string,string>"), ["k"], "m").collect() == [(1, "en", "x")]
    entries = spark.createDataFrame([("k", 1, 5), ("k", 2, 7)], "key string, id int, n int")
    assert resolving.winners(entries, "key", "id", [F.col("n")]).collect() == [("k", 2)]
    assert one(spark, resolving.remap(F.array(F.lit(1), F.lit(9)), F.create_map(F.lit(9), F.lit(2))))[0] == [1, 2]


def test_logs_and_references(spark, tmp_path):
    from textloom.operators import linking
    from textloom.sources import readers, writers

    rows = spark.createDataFrame([("s1", 1), ("s2", 2)], "session string, n int")
    writers.append_log(rows, f"{tmp_path}/log")
    writers.append_log(rows, f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 4
    assert writers.request_lines(rows.where("n = 1"), "n", ["session"]).first()[0] == '{"custom_id":"1","body":{"session":"s1"}}'
    (tmp_path / "events.jsonl").write_text('{"session": "s1"}\n{"session": "s2"}\nnot json\n')
    assert readers.event_log(spark, f"{tmp_path}/events.jsonl", "s1").count() == 1
    texts = spark.createDataFrame([(1, [(2, 3), (9, 9)])], "id int, r array<struct<chapter:int,verse:int>>")
    verses = spark.createDataFrame([(2, 3, "v")], "chapter int, verse int, path string")
    found, missed = linking.resolved_references(texts, F.col("r"), verses, "id")
    assert [r.path for r in found.collect()] == ["v"] and [(r.chapter, r.verse) for r in missed.collect()] == [(9, 9)]
