from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.operators import checking, graph, linking, merging, nesting, ordering, resolving


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_quotations_need_half_of_a_passage(spark):
    texts = spark.createDataFrame([(1, "x a b c d y"), (2, "a b"), (3, None)], "id int, t string")
    passages = spark.createDataFrame([(7, "a b c d e f"), (8, "a b c")], "pid int, p string")
    got = linking.quotations(texts, passages, F.split("t", " "), F.split("p", " "), "id", "pid")
    assert rows(got.select("id", "pid", "n_shared", "n_passage"), "id") == [(1, 7, 2, 4)]


def test_cascade_takes_the_strictest_key(spark):
    names = spark.createDataFrame([(1, "Ali"), (2, "ali "), (3, "zed"), (4, None)], "n int, name string")
    people = spark.createDataFrame([(10, "ali"), (11, "Ali"), (12, "ALI")], "p int, person string")
    fold = lambda c: F.lower(F.trim(c))
    got = resolving.cascade(names, "n", people, [("exact", F.col("name"), F.col("person")), ("folded", fold(F.col("name")), fold(F.col("person")))], "p", [F.col("p")])
    assert rows(got, "n") == [(1, 11, "exact"), (2, 10, "folded"), (3, None, "none"), (4, None, "none")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=6, unique=True))
def test_fuzzy_finds_what_comparing_all_finds(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "a string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    want = {(a, b) for a in names for b in names if round(1 - distance(a, b) / max(len(a), len(b)), 6) >= 0.7}
    got = resolving.fuzzy(df, df.withColumnRenamed("a", "b"), "a", "b", threshold=0.7, top=50)
    assert {(r["a"], r["b"]) for r in got.collect()} == want


def test_clusters_and_edges(spark):
    members = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "c"), (5, None)], "i int, k string")
    assert rows(graph.clusters(members, "i", "k"), "i") == [(1, 1), (2, 1), (3, 1), (4, 4)]
    chain = spark.createDataFrame([(1, 1, "x"), (1, 2, None), (1, 3, "y"), (1, 4, "x"), (1, 5, "x")], "c int, o int, n string")
    assert rows(graph.neighbour_edges(chain, ["c"], [F.col("o")], "n"), "a") == [("x", "y", 2)]


def test_numbering_gaps_and_runs(spark):
    d = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, True)], "b string, o int, c boolean")
    got = ordering.running_number(d, ["b"], [F.col("o")], F.col("c"), [F.col("b")])
    assert rows(got.select("b", "o", "index"), "b", "o") == [("a", 1, 1), ("a", 2, None), ("a", 3, 2), ("b", 1, 3)]
    n = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("b", 9)], "b string, n int")
    assert rows(ordering.sequence_gaps(n, ["b"], "n"), "b") == [("a", 2, 5, 2)]
    v = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, 3, None), (1, 4, None), (1, 5, "x")], "k int, o int, v string")
    assert rows(ordering.runs(v, ["k"], [F.col("o")], "v"), "run") == [(1, 1, "x", 2, 1), (1, 2, None, 2, 3), (1, 3, "x", 1, 5)]


def test_merging(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(merging.upsert(old, new, ["k"]), "k") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(merging.insert_missing(old, new, ["k"]), "k") == [(1, "a"), (2, "b"), (3, "d")]
    prices = spark.createDataFrame([("", 1.0), ("m", 2.0), ("m-x", 3.0)], "prefix string, price double")
    models = spark.createDataFrame([("m-xl",), ("m-y",), ("z",)], "model string")
    assert rows(merging.priced(models, "model", prices, "prefix").select("model", "price"), "model") == [("m-xl", 3.0), ("m-y", 2.0), ("z", 1.0)]


def test_nesting_round_trip(spark):
    flat = spark.createDataFrame([("b", 2, 5), ("b", 1, 3), ("b", 1, 2)], "book string, chapter int, verse int")
    back = nesting.flatten(nesting.nest(flat)).select("book", "chapter", "verse")
    assert rows(back, "chapter", "verse") == sorted(map(tuple, flat.collect()))
    nodes = spark.createDataFrame([("a", None), ("a:1", "a"), ("a:2", "a")], "path string, parent string")
    assert rows(nesting.leaves(nodes, "path", "parent").select("path"), "path") == [("a:1",), ("a:2",)]


def test_rules(spark):
    d = spark.createDataFrame([(1, ""), (2, "ok"), (3, None)], "id int, t string")
    rules = [checking.Rule("t", "error", "empty", F.col("t") == ""), checking.Rule("t", "warning", "missing", F.col("t").isNull())]
    done = checking.checked(d, rules, ["id"])
    assert rows(done.select("id", "status"), "id") == [(1, "error"), (2, "pass"), (3, "warning")]
    assert rows(checking.tally(done), "message") == [("t", "error", "empty", 1), ("t", "warning", "missing", 1)]
