import pytest
from pyspark.sql import functions as F

from textloom.functions import arabic, nested, paths, text


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(("raw", "folded"), [("قَالَ", "قال"), ("رحمـــة", "رحمه"), ("أإآٱ", "اااا"), ("موسى", "موسي"), ("مؤمن", "مومن"), ("شيئ", "شيي"), ("کتابی", "كتابي"), ("ما،  هذا؟", "ما, هذا?"), ("  a​b ", "a b"), ("", "")])
def test_normalize(spark, raw, folded):
    assert one(spark, arabic.normalize(F.col("c")), c=raw) == folded


def test_variants_differ(spark):
    assert one(spark, arabic.normalize_with_marks(F.col("c")), c="قَالَ") == "قَالَ"
    assert one(spark, arabic.shingle_tokens(F.col("c")), c="إِنَّ اللَّهَ, x 12 رحمة") == ["ان", "الله", "رحمه"]
    assert one(spark, arabic.arabic_fraction(F.col("c")), c="اب cd") == 0.5
    assert one(spark, arabic.marked_word_rate(F.col("c")), c="قَال ذهب") == 0.5
    assert one(spark, arabic.buckwalter_to_arabic(F.col("c")), c="ktb") == "كتب"
    assert one(spark, arabic.nfc(F.col("c")), c="é") == "é"


@pytest.mark.parametrize(("a", "b", "tier"), [("قَالَ", "قَالَ", 1), ("قَالَ", "قال", 2), ("قال", "كان", 3), ("", "", 1)])
def test_tiers(spark, a, b, tier):
    assert one(spark, text.compare(F.col("a"), F.col("b")), a=a, b=b)["tier"] == tier


def test_similarity(spark):
    assert one(spark, text.similarity(F.col("a"), F.col("b")), a="kitten", b="sitting") == pytest.approx(1 - 3 / 7)
    assert one(spark, text.similarity_of_like_lengths(F.col("a"), F.col("b")), a="ab", b="abcdefgh") == 0.0
    assert one(spark, text.similarity(F.col("a"), F.col("b")), a="ab", b="abcdefgh") == 0.25
    assert one(spark, text.similarity(F.col("a"), F.col("b")), a="", b="x") == 0.0


def test_shingles_of_short_texts(spark):
    words = text.tokens(F.col("c"))
    assert one(spark, text.shingles(words), c="a b") == []
    assert one(spark, text.shingles(words), c="a b c a b c") == ["a b c", "b c a", "c a b"]
    assert one(spark, text.word_count(F.col("c")), c=" \t ") == 0


def test_text_helpers(spark):
    assert one(spark, text.strip_tags(F.col("c")), c="<b>a</b> [12] b ") == "a  b"
    assert one(spark, text.json_payload(F.col("c")), c='ok ```json\n{"a": [1,],}\n``` bye') == '{"a": [1]}'
    assert one(spark, text.json_payload(F.col("c")), c="none") is None
    assert one(spark, text.references(F.col("c"), r"\[([0-9]+):([0-9]+)\]"), c="see [2:5] and [2:5], [10:1]") == [(2, 5), (10, 1)]
    linked = text.linked_references(F.col("c"), r"\[([0-9]+):([0-9]+)\]", "/q:")
    assert one(spark, linked, c="[2:5]") == '<a href="/q:2#h5">[2:5]</a>'
    assert one(spark, text.grade_class(F.col("c"), [("good", ["sahih"]), ("weak", ["da'if", "daif"])]), c="Daif hadith") == "weak"
    assert one(spark, text.paragraphs_to_html(F.col("c")), c="a\nb\n\n\nc") == "<p>a<br>b</p><p>c</p>"
    assert tuple(one(spark, text.leading_number(F.col("c")), c=" 12 - abc")) == (12, "abc")


def test_paths(spark):
    p = "/books/al-x:1:10"
    assert one(spark, paths.file_of(F.col("c")), c=p) == "/books/al-x/1/10.json"
    assert one(spark, paths.path_of(paths.id_of(F.col("c"))), c=p) == p
    assert one(spark, paths.parent_of(F.col("c")), c="/books/al-x") is None
    assert one(spark, paths.steps_of(F.col("c")), c=p) == [1, 10]
    assert one(spark, paths.slug_of(F.col("c")), c=p) == "al-x"


def test_nested(spark):
    a = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    assert one(spark, nested.jaccard(a(), a())) == 1.0
    assert one(spark, nested.jaccard(a("a", "b"), a("b", "c"))) == pytest.approx(1 / 3)
    assert one(spark, nested.recall(a("a", "b"), a("b"))) == 0.5
    assert one(spark, nested.combinations(a("1", "2", "3"))) == ["1-2-3", "1-2", "2-3"]
    assert one(spark, nested.combinations(a("1", "2"))) == ["1-2"]
    m = F.create_map(F.lit("en"), F.lit("x"), F.lit("fr"), F.lit(None).cast("string"))
    assert one(spark, nested.without_nulls(m)) == {"en": "x"}
    assert one(spark, nested.filled(m, ["en", "de", "fr"])) == {"en": "x", "de": "", "fr": ""}
    assert one(spark, nested.overlaid(m, F.create_map(F.lit("en"), F.lit("y")))) == {"en": "y", "fr": None}
    assert [tuple(x) for x in one(spark, nested.chunk_offsets(a("a b", "c", "")))] == [(0, 2), (2, 3), (3, 3)]
