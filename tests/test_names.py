from pyspark.sql import functions as F

from textloom.functions import names


def of(spark, make, *values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", make(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_keys(spark):
    assert of(spark, names.canonical_key, "أَبُو جَعْفَرٍ ( عليه السلام ) : أَنَّهُ", "وَرَوَى اِبْنُ بُكَيْرٍ", "روى", None) == ["ابو جعفر", "ابن بكير", "روي", ""]
    assert of(spark, names.matching_key, "علي (عليه السلام) بن أحمد") == ["علي بن احمد"]
    assert of(spark, names.name_cases_folded, "ابي ( جعفر ) لابي") == ["ابو جعفر ابو"]


def test_signs_of_a_chain(spark):
    assert of(spark, names.is_chain, "علي بن محمد", "قصة طويلة", "x" * 130 + " بن ", None) == [True, False, False, False]
    assert of(spark, names.without_preamble, "70 - مَا أَخْبَرَنِي بِهِ الشيخ", "ما رواه علي", "علي") == ["الشيخ", "علي", "علي"]


CHAIN = "عَلِيُّ بْنُ إِبْرَاهِيمَ عَنْ أَبِيهِ قَالَ: حَدَّثَنِي حَمَّادُ بْنُ عِيسَى قَالَ كَانَ"


def test_chains_are_cut_and_split(spark):
    chain, rest = of(spark, lambda c: names.chain_and_rest(c), CHAIN)[0]
    assert chain.endswith("عِيسَى قَالَ") and rest == " كَانَ"
    assert of(spark, names.chain_names, chain) == [["عَلِيُّ بْنُ إِبْرَاهِيمَ", "أَبِيهِ", "حَمَّادُ بْنُ عِيسَى"]]
    bare = "علي بن ابراهيم عن ابيه قال كان"
    got = of(spark, lambda c: names.chain_and_rest(c, bare=True), bare, "لا شيء")
    assert got[0].chain == "علي بن ابراهيم عن ابيه قال" and got[1].chain is None and got[1].rest == "لا شيء"


def test_parts_of_a_chain(spark):
    df = spark.createDataFrame([("a from b, c", [("a", 1), ("x", 2), ("b", None)]), ("a b", [("a", 1)])], "chain string, names array<struct<text:string,id:int>>")
    made = df.select("chain", names.chain_parts(F.col("chain"), F.col("names")).alias("m"), names.parts_if_all(F.col("chain"), F.col("names")).alias("all")).collect()
    assert [tuple(p) for p in made[0].m.parts] == [("narrator", "a", "/people/narrators/1"), ("plain", " from ", None), ("plain", "b", None), ("plain", ", c", None)]
    assert made[0].m.missed == 1 and made[0]["all"] is None and len(made[1]["all"]) == 2
    assert df.select(names.chain_text(names.chain_parts(F.col("chain"), F.col("names"))["parts"])).first()[0] == "a from b, c"


def test_transliteration(spark):
    assert of(spark, names.transliterated, "مُحَمَّدُ بْنُ يَعْقُوبَ", "الشمس ( عليه السلام )", "الكاظم", "  القمر  abc (1) ", "خفّاف ــــــت", "", None) == ["Muhammad ibn Ya'qub", "Ash-shms (a)", "Al-Kazim", "Al-qmr abc (1)", "Khfff t", "", None]
