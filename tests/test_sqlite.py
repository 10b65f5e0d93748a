"""SQLite files as tables of Spark, and the edition that is built from two of them."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from textloom.operators import editions
from textloom.sources import sqlite


@pytest.fixture(scope="module")
def db(tmp_path_factory):
    path = tmp_path_factory.mktemp("db") / "a #1%.db"
    c = sqlite3.connect(path)
    c.execute('CREATE TABLE content (content_id INTEGER, "content en" TEXT COLLATE NOCASE, score REAL, raw BLOB, day DATE)')
    rows = [(i, None if i % 7 == 0 else "  " if i % 11 == 0 else f"Text {i}", i / 4, bytes([i]), f"2020-01-{i % 28 + 1:02}") for i in range(200)]
    rows += [("odd", 5, "x", "t", 7), (None, b"\x00", None, None, None), (2**62, "TEXT 3", 1e300, b"", 1.5)]
    c.executemany("INSERT INTO content VALUES (?, ?, ?, ?, ?)", rows)
    c.execute("CREATE TABLE mapping (part INTEGER, place INTEGER, content_id INTEGER, PRIMARY KEY (part, place, content_id)) WITHOUT ROWID")
    c.executemany("INSERT INTO mapping VALUES (?, ?, ?)", [(p, i, (i * 7 // 3) % 200) for p in (1, 2) for i in range(1, 150)] + [(1, 5, 199), (3, 1, 0)])
    c.execute("CREATE TABLE empty (x INTEGER)")
    c.execute("CREATE TABLE strict (x INT, t TEXT) STRICT")
    c.executemany("INSERT INTO strict VALUES (?, ?)", [(i, str(i)) for i in range(100)])
    c.commit()
    c.close()
    return str(path)


@pytest.fixture(scope="module")
def read(spark, db):
    sqlite.register(spark)
    return lambda table, **o: spark.read.format("sqlite").options(path=db, table=table, **o).load()


def test_types_and_odd_values(read):
    d = read("content")
    assert d.dtypes == [("content_id", "bigint"), ("content en", "string"), ("score", "double"), ("raw", "binary"), ("day", "string")]
    rows = {r["content_id"]: r for r in d.collect()}
    assert d.count() == 203 and rows[3]["content en"] == "Text 3" and rows[3]["score"] == 0.75 and rows[3]["raw"] == b"\x03" and rows[2**62]["day"] == "1.5"
    odd = [tuple(r) for r in d.where("content_id IS NULL").collect()]
    assert sorted(odd, key=str) == sorted([(None, "5", None, None, "7"), (None, None, None, None, None)], key=str)
    assert read("empty").count() == 0 and read("content", columns="day, score").columns == ["day", "score"]


def test_partitions_are_ranges_of_rowids(read):
    d = read("content", partitions=4)
    held = [r["n"] for r in d.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(held) == 4 and max(held) <= 51 and read("mapping").rdd.getNumPartitions() == 1


def test_filters_are_pushed_and_checked(spark, read, db):
    d = read("content")
    for condition, n in (("content_id BETWEEN 10 AND 19", 10), ("`content en` = 'Text 3'", 1), ("content_id IN (1, 2, 500)", 2), ("score > 49.5", 2), ("day = '7'", 1), ("content_id >= 198 AND `content en` IS NOT NULL", 3)):
        assert d.where(condition).count() == n, condition
    reader = sqlite.SqliteSource({"path": db, "table": "content"}).reader(d.schema)
    asked = [sqlite.GreaterThan(("content_id",), 197), sqlite.EqualTo(("day",), "7"), sqlite.In(("content en",), ("Text 199", "x"))]
    assert list(reader.pushFilters(asked)) == asked and reader.where == ['"content_id" > ? COLLATE BINARY', '"content en" COLLATE BINARY IN (?, ?)']
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 1
    left = lambda d: " Filter (" in d._jdf.queryExecution().executedPlan().toString()
    strict = read("strict").where("x > 90 AND t IN ('95', '99', '7')")
    assert left(d.where("content_id > 197")) and not left(strict) and sorted(r["x"] for r in strict.collect()) == [95, 99]
    assert left(read("strict").where("x % 2 = 1 AND x > 90")) and read("strict").where("x % 2 = 1 AND x > 90").count() == 5


def test_missing_tables_and_columns_are_told(read):
    for options in ({"table": "none"}, {"table": "content", "columns": "x"}):
        with pytest.raises(Exception, match="no (table|column)"):
            read(**options).count()


def edition_by_loop(db, column):
    c = sqlite3.connect(db)
    out, blocks = {}, {}
    for part, place, cid, text in c.execute(f'SELECT part, place, m.content_id, "{column}" FROM mapping m JOIN content c ON m.content_id = c.content_id ORDER BY part, place, m.content_id'):
        if text is None or not text.strip():
            continue
        of = blocks.setdefault(part, {})
        of.setdefault(cid, len(of))
        out.setdefault((part, place), of[cid])
    return out


@pytest.mark.parametrize("width", [10, 1000])
def test_edition(read, db, width):
    places, blocks = editions.edition_blocks(read("mapping"), read("content", columns="content_id,content en"), "part", "place", "content_id", "content en", width)
    want = edition_by_loop(db, "content en")
    assert {(r["part"], r["place"]): r["block"] for r in places.collect()} == want
    assert {(r["part"], r["block"]) for r in blocks.collect()} == {(p, b) for (p, _), b in want.items()}
