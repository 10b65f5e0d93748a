"""Outlines and passages, by ranges of any width, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import ordering, pages, volumes


def made(seed, n):
    r = random.Random(seed)
    return [(r.choice(["a", "a", "b", None]), i * r.choice([1, 1, 1]) + (i // 50) * 1000, r.choice([1, 2, 2, 3, 3, None, None, None]), f"t{i}" if r.random() > 0.1 else None, r.random() < 0.3, r.random() < 0.2) for i in range(n)]


def outline_by_loop(rows, levels):
    out, state = {}, {}
    for volume, at, level, title, _, _ in sorted(rows, key=lambda r: r[1]):
        s = state.setdefault(volume, {"titles": [None] * levels, "numbers": [None] * levels, "counts": [0] * levels})
        if level:
            k = level - 1
            s["counts"][k] += 1
            s["titles"][k], s["numbers"][k] = title, s["counts"][k]
            for m in range(level, levels):
                s["titles"][m] = s["numbers"][m] = None
                s["counts"][m] = 0
        out[volume, at] = (*s["titles"], *s["numbers"])
    return out


@pytest.mark.parametrize("width", [1, 7, 100_000])
def test_outline(spark, width):
    rows = made(width, 300)
    d = spark.createDataFrame([r[:4] for r in rows if r[0]], "v string, at long, level int, title string").withColumn("_part_", F.lit(0))
    got = volumes.outlined(d, ["v"], "at", "level", "title", 3, width)
    assert {(r["v"], r["at"]): tuple(r[f"{x}_{k}"] for x in ("title", "number") for k in (1, 2, 3)) for r in got.collect()} == outline_by_loop([r for r in rows if r[0]], 3)


@pytest.mark.parametrize("width", [3, 1000])
def test_passages(spark, width):
    rows = [r for r in made(width, 200) if r[0]]
    d = spark.createDataFrame([(v, at, s, e) for v, at, _, _, s, e in rows], "v string, at long, s boolean, e boolean")
    want, now, closed = {}, {}, {}
    for v, at, _, _, s, e in sorted(rows, key=lambda r: r[1]):
        now[v] = now.get(v, 0) + s + closed.get(v, 0)
        want[v, at], closed[v] = now[v], e
    assert {(r["v"], r["at"]): r["passage"] for r in volumes.passages(d, ["v"], "at", F.col("s"), F.col("e"), width).collect()} == want


def test_no_window_holds_a_whole_volume(spark):
    d = spark.range(100).select(F.lit("v").alias("v"), F.col("id").alias("at"), F.lit(None).cast("int").alias("level"), F.lit("t").alias("t"))
    plan = volumes.outlined(d, ["v"], "at", "level", "t", 2, 10)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in line for line in windows)


BOOK = """<body><p class="libAr">before</p><h1 class="Heading1Center">The Book of One</h1><p class="Heading2Center">Chapter 1</p>
<p class="libAr">ar 1</p><p class="libNormal">en 1</p><p class="libNormal">en 1b</p><p class="libAr">ar 2</p><p class="Heading2Center">Chapter 2</p><p class="libAr">ar 3</p><p class="libNormal">en 3</p>
<h1 class="Heading1Center">The Book of Two</h1><p class="libNormal">loose</p></body>"""


def test_volume_of_classes(spark):
    e = pages.segments(spark.createDataFrame([("v", BOOK)], "v string, html string"), "html", "body", "v").withColumn("kind", F.col("of")["class"])
    level = F.when(F.col("kind") == "Heading1Center", 1).when(F.col("kind") == "Heading2Center", 2)
    o = volumes.outlined(e.withColumn("level", level), ["v"], "pos", "level", "text", 2, 4)
    p = volumes.passages(o, ["v"], "pos", (F.col("kind") == "libAr") | F.col("level").isNotNull(), width=4).where("level IS NULL")
    g = p.groupBy("title_1", "number_2", "passage").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text"))).alias("x")).orderBy("passage")
    assert [(r["title_1"], r["number_2"], [(y["kind"], y["text"]) for y in r["x"]]) for r in g.collect()] == [
        (None, None, [("libAr", "before")]), ("The Book of One", 1, [("libAr", "ar 1"), ("libNormal", "en 1"), ("libNormal", "en 1b")]), ("The Book of One", 1, [("libAr", "ar 2")]),
        ("The Book of One", 2, [("libAr", "ar 3"), ("libNormal", "en 3")]), ("The Book of Two", None, [("libNormal", "loose")]),
    ]


def test_lines_are_told_apart(spark):
    of = lambda f, xs: [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t string").select("i", f(F.col("t")).alias("x")).orderBy("i").select("x").collect()]
    assert of(volumes.is_no_content, ["ص: 12", "ص: x", "[ صفحه 3 ]", "[صفحه]", "******** 1", "-روایت-1", " \n", None, "نص"]) == [True, False, True, False, True, True, True, True, False]
    assert of(volumes.is_chapter_heading, ["1 - x", "12– y", "x 1 -", "باب الصلاة", "5", "نص"]) == [True, True, False, True, False, False]
    assert of(volumes.is_introduction, ["مقدمة المؤلف", "نص"]) == [True, False]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_places_and_blocks_of_any_group(spark, n):
    r = random.Random(n)
    rows = list({(r.choice(["hot", "hot", "hot", "b", None]), r.randrange(10_000), r.choice(["x", None])) for _ in range(n)})
    d = spark.createDataFrame(rows, "k string, i long, t string").repartition(7)
    groups = {}
    for k, i, t in rows:
        groups.setdefault(k, []).append((i, t))
    order = lambda xs: sorted(xs, key=lambda x: (x[0], x[1] is not None, x[1] or ""))
    want = {(k, *x): at for k, xs in groups.items() for at, x in enumerate(order(xs), 1)}
    assert {(x["k"], x["i"], x["t"]): x["n"] for x in ordering.numbered(d, ["k"], ["i", "t"]).collect()} == want
    got = {(x["k"], x["block"]): (x["n"], [tuple(y) for y in x["items"]]) for x in ordering.blocked_lists(d, ["k"], ["i", "t"], 30).collect()}
    assert got == {(k, b): (len(part), part) for k, xs in groups.items() for b in range(-(-len(xs) // 30)) for part in [order(xs)[30 * b : 30 * b + 30]]}
