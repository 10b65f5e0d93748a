"""Chains from texts to linked names."""

from pyspark.sql import functions as F

from textloom.operators import linked_chains as chains

REGISTRY = [
    (1, "عَلِيُّ بْنُ يَزِيدَ", None, None, None, 5), (2, "علي بن يزيد", ["ابن يزيد"], None, "after صالح بن سعيد", 9), (3, "صالح بن سعيد", None, ["one"], None, 1), (4, "كَرِيم", ["الشيخ"], None, None, 2), (5, "كريم", None, ["two"], "before سعد in a chain", 3), (6, "كرِيم", None, None, None, 1),
]


def registry(spark):
    return spark.createDataFrame(REGISTRY, "id long, name string, variants array<string>, books array<string>, context string, rank long")


def test_names_are_found_by_stage_book_and_context(spark):
    chain = [
        (1, "one", ["علي بن يزيد", "كَريم", "nobody"]),  # as written; normalised, first by rank of two, as the third is for another book
        (2, "two", ["صالح بن سعيد", "عَلي بن يزيد"]),  # for another book only; normalised, no context before it that counts
        (3, None, ["صالح بن سعيد", "عَلي بن يزيد", "الشيخ"]),  # any book; the context names who is before; too little, but as written
        (4, "two", ["سَعْد", "كَريم", "روى علي بن يزيد ( عليه السلام )"]),  # by context; by its canonical key
        (5, "one", []),
    ]
    d = spark.createDataFrame(chain, "i long, book string, names array<string>")
    got = {(r["i"], r["pos"]): r["entry"] for r in chains.resolved_names(d, "i", registry(spark)).collect()}
    assert got == {(1, 0): 2, (1, 1): 6, (1, 2): None, (2, 0): None, (2, 1): 2, (3, 0): 3, (3, 1): 2, (3, 2): 4, (4, 0): None, (4, 1): 5, (4, 2): 1}


def test_texts_to_parts(spark):
    d = spark.createDataFrame([(1, "حَدَّثَنَا علي بن يزيد عَنْ كريم قَالَ كان"), (2, "no chain here"), (3, None)], "i long, t string")
    rows = {r["i"]: r for r in chains.linked_chains(d, "i", F.col("t"), F.lit(None).cast("string"), registry(spark)).collect()}
    assert [(p["kind"], p["path"]) for p in rows[1]["parts"] if p["path"]] == [("narrator", "/people/narrators/2"), ("narrator", "/people/narrators/5")]
    assert "".join(p["text"] for p in rows[1]["parts"]) == rows[1]["chain"] and rows[1]["rest"] == " كان"
    assert rows[2]["parts"] is None and rows[2]["chain"] is None and rows[2]["rest"] == "no chain here" and rows[2]["ids"] == []
