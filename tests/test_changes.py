"""Changes between states, and their way into copies and partitions."""

import os
import random

from pyspark.sql import functions as F

from textloom.operators import changes


def test_changes(spark):
    schema = "k long, j string, a string, b int"
    old = [(1, "x", "a", 1), (2, "x", None, 1), (3, "x", "", None), (4, "x", "a", 1), (None, "n", "a", 1), (6, "r", "a", 1), (6, "r", "b", 1), (7, "r", "a", 1), (7, "r", "a", 1), (8, None, "a", 1)]
    new = [(1, "x", "a", 1), (2, "x", "", 1), (3, "x", None, None), (5, "x", "a", 1), (None, "n", "a", 2), (6, "r", "b", 1), (6, "r", "a", 1), (7, "r", "a", 1), (8, None, "a", 1)]
    r = random.Random(1)
    got = changes.changed(spark.createDataFrame(r.sample(old, len(old)), schema), spark.createDataFrame(r.sample(new, len(new)), schema), ["k", "j"], ["a", "b"])
    assert {(x["k"], x["j"]): x["change"] for x in got.collect()} == {(2, "x"): "updated", (3, "x"): "updated", (4, "x"): "deleted", (5, "x"): "inserted", (None, "n"): "updated", (7, "r"): "updated"}
    empty = spark.createDataFrame([], schema)
    assert changes.changed(empty, empty, ["k"], ["a"]).count() == 0


def test_lists_are_patched(spark):
    lists = spark.createDataFrame([(1, [("p1", "a", 1), ("p2", "b", 2), ("p1", "c", 3), (None, "d", 4)]), (2, [("p9", "z", 1)]), (3, []), (4, None), (None, [("p2", "n", 0)])], "id long, xs array<struct<p:string,t:string,n:int>>")
    ups = spark.createDataFrame([("p1", "A", None), ("p2", None, 7), (None, "N", 0)], "p string, t string, n int")
    got = {r["id"]: (None if r["xs"] is None else [tuple(x) for x in r["xs"]], r["n_patched"]) for r in changes.patched_lists(lists, "id", "xs", "p", ups, ["t", "n"]).collect()}
    assert got[1] == ([("p1", "A", 1), ("p2", "b", 7), ("p1", "A", 3), (None, "d", 4)], 3)
    assert got[2] == ([("p9", "z", 1)], 0) and got[3] == ([], 0) and got[4] == (None, 0)


def test_partitions_are_overwritten_where_something_changed(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(i, f"v{i}", "abc d/"[i % 4 : i % 4 + (3 if i % 4 == 3 else 1)]) for i in range(20)], "k long, v string, part string").write.partitionBy("part").parquet(path)
    files = lambda: {os.path.join(d, x): os.stat(os.path.join(d, x)).st_mtime_ns for d, _, xs in os.walk(tmp_path) for x in xs if "part=a" in d}
    before = files()
    new = spark.createDataFrame([(1, "new", "b"), (100, "more", "b"), (7, "z", "e")], "k long, v string, part string")
    gone = spark.createDataFrame([(5, "b"), *[(i, "c d"[0:1]) for i in range(2, 20, 4)]], "k long, part string")
    assert changes.merge_into_partitions(spark, path, new, gone, ["k"], "part") == ["b", "c", "e"]
    rows = {(r["k"], r["v"], r["part"]) for r in spark.read.parquet(path).collect()}
    want = {(i, f"v{i}", "abc d/"[i % 4 : i % 4 + (3 if i % 4 == 3 else 1)]) for i in range(20) if i % 4 != 2 and i not in (1, 5)} | {(1, "new", "b"), (100, "more", "b"), (7, "z", "e")}
    assert rows == want and files() == before and not (tmp_path / "t" / "part=c").exists()
    assert changes.merge_into_partitions(spark, path, new.limit(0), gone.limit(0), ["k"], "part") == []
    assert changes.merge_into_partitions(spark, path, new.limit(0), spark.read.parquet(path).where(F.col("part") == " d/").select("k", "part"), ["k"], "part") == [" d/"]
    assert {r["part"] for r in spark.read.parquet(path).collect()} == {"a", "b", "e"}
