"""Quality rules with thresholds that adapt to language and source.

Four ratios describe a document: characters a word, symbols a word, the share
of its lines that repeat an earlier line, and the share of its words in
repeated three-word windows. For each ratio a quantile sketch is kept by
(language, source): counts in logarithmic buckets, so any quantile is right to
within ``ACCURACY`` of its value. Sketches merge by adding counts; the same
buckets summed over sources give a language's sketch, and over everything the
corpus's, and a group with under ``least`` values uses the next larger
sketch that has enough.

A fence is what the sketch of a group says, and nothing else: on the scale of
its buckets, the upper quartile plus ``REACH`` times the spread, for characters
a word also the lower quartile minus it. The spread is the distance of the
quartiles; where these are equal, as among copies, it is that of the next wider
pair of quantiles that differ. Documents that have none of what a ratio counts
(no symbol, no repeated line) are no part of its sketch, so rare things are
measured against those that have them. Every document is joined with the
fences of its group.

Everything is DataFrame operations. Counts leave each task summed, so a source
with a third of all rows is as cheap as any.

Defined results: a null text has no words and fails the base rules; null
language or source is a group of its own; repeated rows are judged alike; an
empty table gives an empty result; columns other than id, text, language and
source are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.words import SPACES, words
from textloom.tables import stage

SYMBOLS = "#*$%&|<>"
#: Relative error of a quantile, and the ratio from which on there is one.
ACCURACY, TINY = 0.002, 0.001
STEP = log((1 + ACCURACY) / (1 - ACCURACY))
#: The ratios, and whether they have a lower fence too.
RATIOS = {"chars_per_word": True, "symbols_per_word": False, "dup_line_share": False, "repeat_share": False}
#: Fences lie so many spreads from the quartiles; pairs of quantiles, whose distance is a spread.
REACH, PAIRS = 3, [(0.25, 0.75), (0.1, 0.9), (0.05, 0.95), (0.0, 1.0)]


def bucket_of(value: Column) -> Column:
    """The bucket of a ratio; null where it is under ``TINY``."""
    return F.when(value >= TINY, F.ceil(F.log(value) / STEP)).cast("int")


def window_hashes(w: Column) -> Column:
    """A hash for each three-word window of ``w``, a materialised column."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(hashes)


def repeated_starts(placed: Column) -> Column:
    """Places of the windows that occur twice or more, in order. ``placed``: (hash, place) of all windows, sorted, so equal windows are neighbours."""
    pairs = F.zip_with(placed, F.slice(placed, 2, F.size(placed)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.select(
        "id", "lang", "source",
        words(F.col("text")).alias("w"),
        lines.alias("lines"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    d = d.withColumns({
        "n_words": F.size("w").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": window_hashes(F.col("w")),
    }).drop("w", "lines")
    # Most texts repeat no window and need no sorting.
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("placed", F.when(repeats, placed)).drop("hashes")
    d = d.withColumn("starts", F.coalesce(repeated_starts(F.col("placed")), F.array().cast("array<int>"))).drop("placed")
    steps = F.zip_with("starts", F.slice("starts", 2, F.size("starts")), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    n_repeat = F.aggregate(steps, F.lit(0), lambda total, x: total + x).cast("long")
    return d.withColumn("n_repeat_words", n_repeat).drop("starts")


def fences(measures: DataFrame, least: int) -> DataFrame:
    """(lang, source, lo_<ratio>, hi_<ratio> ...) for every language and source: the first and last bucket inside the fences."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), bucket_of(F.col(k)).alias("bucket")) for k in RATIOS]))
    long = measures.where(~F.col("base_failed")).select("lang", "source", each.alias("x")).select("lang", "source", "x.*")
    sketch = stage(long.groupBy("lang", "source", "ratio", "bucket").agg(F.count("*").alias("n")), "quality_sketch")

    def ends(by: list[str]) -> DataFrame:
        s = sketch.where("bucket is not null").groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
        order = Window.partitionBy(*by, "ratio").orderBy("bucket")
        s = s.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy(*by, "ratio"))})
        # The element of rank 1 + floor(p * (total - 1)).
        at = lambda p: F.min(F.when(F.col("upto") > F.floor(F.lit(p) * (F.col("total") - 1)), F.col("bucket")))
        q = s.groupBy(*by, "ratio").agg(F.first("total").alias("total"), *[at(p).alias(f"q{i}{k}") for k, pair in enumerate(PAIRS) for i, p in enumerate(pair)])
        spread = F.coalesce(*[F.nullif(F.col(f"q1{k}") - F.col(f"q0{k}"), F.lit(0)) for k in range(len(PAIRS))], F.lit(0))
        return q.select(*by, "ratio", "total", (F.col("q00") - REACH * spread).alias("lo"), (F.col("q10") + REACH * spread).alias("hi"))

    names = {"g": ["lang", "source"], "l": ["lang"], "c": []}
    levels = {k: ends(by).select(*[F.col(c).alias(f"{k}_{c}") for c in by], F.col("ratio").alias(f"{k}_ratio"), F.struct("total", "lo", "hi").alias(k)) for k, by in names.items()}
    asked = sketch.select("lang", "source", "ratio").distinct()
    same = {k: [F.col(c).eqNullSafe(F.col(f"{k}_{c}")) for c in by] + [F.col("ratio") == F.col(f"{k}_ratio")] for k, by in names.items()}
    f = asked.join(levels["g"], same["g"], "left").join(levels["l"], same["l"], "left").join(levels["c"], same["c"], "left")
    best = F.when(F.col("g.total") >= least, F.col("g")).when(F.col("l.total") >= least, F.col("l")).otherwise(F.col("c"))
    f = f.select("lang", "source", "ratio", best["lo"].alias("lo"), best["hi"].alias("hi"))
    pick = lambda c, k: F.max(F.when(F.col("ratio") == k, F.col(c)))
    return f.groupBy("lang", "source").agg(*[pick("hi", k).alias(f"hi_{k}") for k in RATIOS], *[pick("lo", k).alias(f"lo_{k}") for k, both in RATIOS.items() if both])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 50) -> DataFrame:
    """Counts, base_failed, kept, the ratios and their fences, for every document."""
    m = measured(docs, id_col, text_col, lang_col, source_col)
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    m = m.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
    })
    m = stage(m, "quality_measures")
    f = fences(m, least).withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    met = m.join(f, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    fine = F.lit(True)
    for k, both in RATIOS.items():
        fine = fine & F.coalesce(bucket_of(F.col(k)) <= F.col(f"hi_{k}"), F.lit(True))
        fine = fine & F.coalesce(bucket_of(F.col(k)) >= F.col(f"lo_{k}"), F.lit(True)) if both else fine
    kept = ~F.col("base_failed") & fine
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    edges = [F.exp(F.col(f"hi_{k}") * STEP).alias(f"hi_{k}") for k in RATIOS] + [F.exp((F.col(f"lo_{k}") - 1) * STEP).alias(f"lo_{k}") for k, both in RATIOS.items() if both]
    return met.select(F.col("id").alias(id_col), *counts, kept.alias("kept"), *RATIOS, *edges)
