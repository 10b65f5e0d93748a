"""Queries of nested documents: rules at any depth, changes carried on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import changes, validating
from textloom.plans.registry import query
from textloom.tables import table


def nested_books(turns: DataFrame) -> DataFrame:
    """(conv_id, doc): conversations as books, turns as verses, chapters in chapters by the id; with faults that follow from ids and turns."""
    t, c = F.col("turn"), F.col("conv_id")
    path = F.concat(F.when(t % 5 == 4, "books/").otherwise("/books/"), c.cast("string"), F.lit(":"), t.cast("string"))
    related = F.when(t % 3 == 1, F.create_map(F.lit("at"), F.array(F.lit("/books/x"), F.when(c % 4 == 1, "x").otherwise("/books/y"))))
    verse = F.struct(
        F.when(t % 7 != 6, F.floor(t / F.when(c % 6 == 0, 2).otherwise(1))).alias("local_index"), F.when(F.col("role") == "system", "Heading").otherwise("Verse").alias("part_type"), path.alias("path"),
        F.when(F.length("text") > 100, F.array(F.left("text", F.lit(5)))).otherwise(F.array().cast("array<string>")).alias("text"), related.alias("relations"),
    )
    g = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.to_json(verse).alias("v")))).alias("vs"), F.count_if(F.col("role") != "system").alias("n"))
    count = (F.col("n") + F.when(c % 5 == 0, 1).otherwise(0)).cast("string")
    inner = F.concat(F.lit('{"path": "/books/c", "part_type": "Chapter", "titles": {"en": "t"}, "verse_count": '), count, F.lit(', "verses": ['), F.array_join(F.transform("vs", lambda x: x["v"]), ", "), F.lit("]}"))
    middle = F.when(c % 3 == 0, inner).otherwise(F.concat(F.lit('{"part_type": "Part", "titles": {}, "chapters": ['), inner, F.lit("]}")))
    outer = F.when(c % 3 < 2, middle).otherwise(F.concat(F.lit('{"path": "/books/o", "titles": {"en": "o"}, "chapters": [{"titles": {"en": "p"}}, '), middle, F.lit("]}")))
    doc = F.concat(F.lit('{"kind": "verse_list", "index": "i", "data": '), outer, F.lit("}"))
    return g.select("conv_id", F.when(c % 11 == 10, F.lit('{"kind": ')).when(c % 11 == 9, F.concat(F.lit("["), doc, F.lit("]"))).otherwise(doc).alias("doc"))


@query(r"""
WITH t AS (SELECT conv_id, turn, role, text, CASE conv_id % 3 WHEN 0 THEN '.data' WHEN 1 THEN '.data.chapters[0]' ELSE '.data.chapters[1].chapters[0]' END AS chapter,
    turn // (CASE WHEN conv_id % 6 = 0 THEN 2 ELSE 1 END) AS li, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE conv_id % 11 < 9),
v AS (SELECT *, chapter || '.verses[' || i || ']' AS path FROM t WHERE role <> 'system'),
twice AS (SELECT conv_id, chapter, li FROM v WHERE turn % 7 <> 6 GROUP BY ALL HAVING count(*) > 1)
SELECT conv_id, path, 'error' AS severity, 'missing local_index' AS message FROM v WHERE turn % 7 = 6
UNION ALL SELECT conv_id, path, 'error', 'path isn''t under /books/: books/' || conv_id || ':' || turn FROM v WHERE turn % 5 = 4
UNION ALL SELECT conv_id, path, 'warning', 'no text' FROM v WHERE length(text) <= 100 OR text IS NULL
UNION ALL SELECT conv_id, path, 'error', 'relations: at isn''t under /books/: x' FROM v WHERE turn % 3 = 1 AND conv_id % 4 = 1
UNION ALL SELECT conv_id, chapter, 'warning', 'verse_count is ' || (count(*) FILTER (role <> 'system') + 1) || ', but there are ' || count(*) FILTER (role <> 'system') FROM t WHERE conv_id % 5 = 0 GROUP BY conv_id, chapter
UNION ALL SELECT conv_id, chapter, 'error', 'verses: local_index more than once: ' || string_agg(li::VARCHAR, ', ' ORDER BY li::VARCHAR) FROM twice GROUP BY conv_id, chapter
UNION ALL SELECT DISTINCT conv_id, CASE conv_id % 3 WHEN 1 THEN '.data' ELSE '.data.chapters[1]' END, unnest(['error', 'warning']), unnest(['unknown part_type: Part', 'no titles']) FROM t WHERE conv_id % 3 > 0
UNION ALL SELECT DISTINCT conv_id, '', 'error', CASE conv_id % 11 WHEN 10 THEN 'invalid JSON' ELSE 'no object but array' END FROM conversations WHERE conv_id % 11 >= 9
""")
def nested_violations(spark: SparkSession, sf: str) -> DataFrame:
    return validating.violations(nested_books(table(spark, sf, "conversations")), "conv_id", "doc", validating.BOOK_RULES + validating.PERSON_RULES)


@query("""
SELECT doc_id, 'deleted' AS change FROM documents WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id, 'updated' FROM documents WHERE doc_id % 10 <> 0 AND doc_id % 7 = 3 AND text <> upper(text)
UNION ALL SELECT doc_id + 1000000000, 'inserted' FROM documents WHERE doc_id % 13 = 0
""")
def changed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against a state of them with some left out, some in capitals, and some under a new id."""
    d = table(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 7 == 3, F.upper("text")).otherwise(F.col("text"))
    new = d.where("doc_id % 10 <> 0").withColumn("text", text).unionByName(d.where("doc_id % 13 = 0").withColumn("doc_id", F.col("doc_id") + 1_000_000_000))
    return changes.changed(d, new, ["doc_id"], ["text", "lang", "source"])


@query("""
WITH u AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN '! ' || text ELSE text END AS text, turn % 3 = 1 OR turn % 3 = 2 AND role = 'user' AS patched, CASE WHEN turn % 3 = 2 AND role = 'user' THEN 'asked' ELSE role END AS role FROM conversations)
SELECT conv_id, turn, md5(text) AS text, role, sum(patched::INT) OVER (PARTITION BY conv_id) AS n_list, patched::INT AS n_row FROM u
""")
def patched_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Updates of turns carried to the lists of their conversations and to the turns' own rows, which then say the same."""
    c = table(spark, sf, "conversations").withColumn("path", F.concat_ws(":", "conv_id", "turn"))
    asked = (F.col("turn") % 3 == 2) & (F.col("role") == "user")
    ups = c.where((F.col("turn") % 3 == 1) | asked).select("path", F.when(F.col("turn") % 3 == 1, F.concat(F.lit("! "), "text")).alias("text"), F.when(asked, "asked").alias("role"))
    lists = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "path", "role", "text"))).alias("turns"))
    inside = changes.patched_lists(lists, "conv_id", "turns", "path", ups, ["text", "role"]).select("conv_id", F.col("n_patched").alias("n_list"), F.explode("turns").alias("x")).select("conv_id", "n_list", "x.*")
    rows = changes.patched_rows(c, "path", ups, ["text", "role"]).select("path", F.col("text").alias("own"), F.col("role").alias("own_role"), F.col("n_patched").alias("n_row"))
    met = inside.join(rows, "path").where(F.col("text").eqNullSafe(F.col("own")) & (F.col("role") == F.col("own_role")))
    return met.select("conv_id", "turn", F.md5("text").alias("text"), "role", F.col("n_list").cast("long").alias("n_list"), "n_row")
