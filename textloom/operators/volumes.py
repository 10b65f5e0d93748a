"""Volumes as runs of elements: headings of several levels over texts, and the pieces of which a passage is made.

Everything is a running sum or a running maximum over the order of a volume.
Such a run is worked out by ranges of places: windows inside a range, the
ranges' totals added up before them, so no task holds more of a volume than a
range, whatever the volume's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What marks headings, introductions and lines that are no content.
CHAPTER_WORDS = ["بَابُ", "بَابِ", "باب", "أَبْوَابُ", "أبواب"]
INTRODUCTIONS = ["اشارة", "مقدّمة", "مقدمة", "فهرس", "مقدّمه"]
FOOTNOTES, MARGIN, PAGE, PAGE_IN_BRACKETS = "********", "-روایت-", "ص:", "صفحه"


def is_chapter_heading(c: Column) -> Column:
    """A word for chapter, or a number and a dash at its beginning."""
    number = F.regexp_extract(F.trim(c), "^([0-9]+)", 1)
    dashed = (number != "") & F.left(F.ltrim(F.substr(F.trim(c), F.length(number) + 1)), F.lit(1)).isin("-", "–")
    return F.greatest(dashed, *[F.contains(c, F.lit(w)) for w in CHAPTER_WORDS])


def is_introduction(c: Column) -> Column:
    return F.greatest(*[F.contains(c, F.lit(w)) for w in INTRODUCTIONS])


def is_no_content(c: Column) -> Column:
    """Blank, a line of footnotes, a page number (ص: 12 or [ صفحه 12 ]) or a note in the margin."""
    t = F.trim(F.coalesce(c, F.lit("")), F.lit(" \t\r\n"))
    digits = lambda x: F.trim(x).rlike("^[0-9]+$")
    bracketed = F.trim(F.regexp_replace(t, r"^\[|\]$", ""))
    page = t.startswith(PAGE) & digits(F.replace(t, F.lit(PAGE), F.lit(""))) | t.startswith("[") & t.endswith("]") & bracketed.startswith(PAGE_IN_BRACKETS) & digits(F.replace(bracketed, F.lit(PAGE_IN_BRACKETS), F.lit("")))
    return (t == "") | t.startswith(FOOTNOTES) | t.startswith(MARGIN) | page


def running(df: DataFrame, by: list[str], at: str, width: int, sums: dict[str, Column] | None = None, latest: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with running sums and the latest value that isn't null, in the order of ``at``, both with the row itself.

    ``at`` is a whole number, one row each; a range holds ``width`` of them.
    """
    sums, latest = sums or {}, latest or {}
    order, part = [*by, "_part"], F.floor(F.col(at) / F.lit(width))
    df = df.withColumn("_part", part).withColumns({f"_{k}": F.coalesce(v, F.lit(0)).cast("long") for k, v in sums.items()} | {f"_{k}": F.when(v.isNotNull(), F.struct(F.col(at).alias("at"), v.alias("value"))) for k, v in latest.items()})
    totals = df.groupBy(*order).agg(*[F.sum(f"_{k}").alias(f"_t_{k}") for k in sums], *[F.max(f"_{k}").alias(f"_t_{k}") for k in latest])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*order, *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_c_{k}") for k in sums], *[F.max(f"_t_{k}").over(before).alias(f"_c_{k}") for k in latest])
    inside = Window.partitionBy(*order).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({f"_{k}": F.sum(f"_{k}").over(inside) for k in sums} | {f"_{k}": F.max(f"_{k}").over(inside) for k in latest}).join(carried, order)
    df = df.withColumns({k: F.col(f"_{k}") + F.col(f"_c_{k}") for k in sums} | {k: F.coalesce(f"_{k}", f"_c_{k}")["value"] for k in latest})
    return df.drop("_part", *[f"{x}{k}" for k in (*sums, *latest) for x in ("_", "_c_")])


def outlined(elements: DataFrame, by: list[str], at: str, level: str, title: str, levels: int, width: int = 50_000) -> DataFrame:
    """Each element with ``title_1`` to ``title_n`` of the headings that it stands under, and ``number_1`` to ``number_n``, their places among those of their own parent.

    ``level`` is 1 to ``levels`` for headings and null for other elements. A
    heading closes those of its own and lower levels: a title is null until one
    follows. Headings of a level that come before any of the level above are
    counted from the volume's beginning.
    """
    depth = range(1, levels + 1)
    counted = running(elements, by, at, width, {f"_n{k}": (F.col(level) == k).cast("long") for k in depth})
    head = lambda k: F.struct(F.col(at).alias("at"), F.col(title).alias("title"), *[F.col(f"_n{m}").alias(f"n{m}") for m in depth])
    seen = running(counted, by, at, width, latest={f"_h{k}": F.when(F.col(level) == k, head(k)) for k in depth})
    out: dict[str, Column] = {}
    for k in depth:
        above = F.greatest(F.lit(-1), *[F.col(f"_h{m}")["at"] for m in range(1, k)]) if k > 1 else F.lit(-1)
        parent = F.coalesce(*[F.when(F.col(f"_h{m}")["at"] == above, F.col(f"_h{m}")[f"n{k}"]) for m in range(1, k)], F.lit(0)) if k > 1 else F.lit(0)
        open_ = F.col(f"_h{k}")["at"] > above
        out |= {f"title_{k}": F.when(open_, F.col(f"_h{k}")["title"]), f"number_{k}": F.when(open_, F.col(f"_h{k}")[f"n{k}"] - parent)}
    return seen.withColumns(out).drop(*[f"_n{k}" for k in depth], *[f"_h{k}" for k in depth])


def passages(elements: DataFrame, by: list[str], at: str, starts: Column, ends: Column | None = None, width: int = 50_000) -> DataFrame:
    """Each element with the ``passage`` of its volume that it belongs to, from 1: one begins at ``starts`` and behind ``ends``. What comes before the first has 0."""
    mark = {"_s": starts.cast("long")}
    if ends is not None:
        mark["_e"] = ends.cast("long")
    run = running(elements, by, at, width, mark)
    closed = F.col("_e") - F.coalesce(ends.cast("long"), F.lit(0)) if ends is not None else F.lit(0)
    return run.withColumn("passage", F.col("_s") + closed).drop(*mark)
