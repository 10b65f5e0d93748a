"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of the token budget. A source whose target exceeds
its size is read in complete epochs first; the fraction that is left is drawn
without replacement by exponential keys: a document's key is -ln(u) / weight
with u from a keyed hash of its id, and the documents with the smallest keys
are taken until their prefix sum reaches the budget.

The prefix sum never puts a source into one task. Keys are mapped to (0, 1)
and cut into bins; sizes are summed by (source, bin) before any shuffle, the
prefix sums run over the bins, and only the one bin of each source in which
the budget ends is sorted by document.

Everything is DataFrame operations; the same rows and seed give the same mix.

Defined results: a null text has size 0 and is taken 0 times; a null source is
a source, ranked last; documents that tie in key are ordered by id, then size;
repeated rows are documents of their own; an empty table gives an empty mix;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.words import fresh, n_words
from textloom.tables import stage

BINS = 4096


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1), 52 bits of an MD5 of seed and id."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def quality_weight(text: Column) -> Column:
    """From 0.25 to 1: the share of characters other than spaces that are neither digits nor markup signs."""
    dense = F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")
    clean = F.translate(dense, "0123456789#*$%&|<>{}[]=_~^", "")
    return F.lit(0.25) + F.lit(0.75) * F.coalesce(F.length(clean) / F.nullif(F.length(dense), F.lit(0)), F.lit(0.0))


def source_targets(sizes: DataFrame, weights: Sequence[float], most_epochs: float) -> DataFrame:
    """Target of every source. ``sizes``: (source, source_size), one row a source.

    Sources are ranked by code point, null last, and take the weights in turn.
    They share the sum of all sizes; no target exceeds most_epochs times its
    source's size, and the excess is shared anew by weight. That is the level L
    with target = min(cap, weight * L): sources in order of cap / weight, each
    is capped if the level that the sources before it leave exceeds that ratio.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most_epochs)) * F.col("source_size"))
    before = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    s = s.withColumns({
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        "total": F.sum("source_size").over(whole),
    })
    s = s.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
    s = s.withColumn("capped", F.col("cap") / F.col("weight") < F.col("level"))
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("ratio"), F.col("source").isNull(), "source", "level"))).over(whole)
    s = s.withColumn("free", level["level"])
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("free")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most_epochs: float = 3.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bins: int = BINS) -> DataFrame:
    """(id, size, source, source_size, target, epochs, extra, taken, mark) for every document; mark tells the texts of one id apart.

    ``epochs`` counts complete epochs. ``taken`` is the number of words that
    the mix takes of the document, repeats counted: epochs times its size,
    plus its size if the fraction takes it. The document in which the budget
    ends is taken in part, so each source's words meet its target to a word.
    """
    text = F.col(text_col)
    key = -F.log(uniform(F.col(id_col), seed)) / quality_weight(text)
    drawn = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"), key.alias("key"), F.xxhash64(text).alias("mark"))
    place = F.least(F.floor((1 - F.exp(-F.col("key"))) * bins), F.lit(bins - 1)).cast("int")
    drawn = stage(drawn.withColumn("bin", place), "mix_keys")

    held = stage(drawn.groupBy("source", "bin").agg(F.sum("size").alias("held")), "mix_bins")
    sources = stage(source_targets(held.groupBy("source").agg(F.sum("held").alias("source_size")), weights, most_epochs), "mix_sources")
    sources = sources.withColumn("epochs", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long"))
    sources = sources.withColumn("rest", F.greatest(F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"), F.lit(0)))
    # What the bins before a bin hold, against what the fraction may take.
    upto = Window.partitionBy("source").orderBy("bin")
    bin_ = held.withColumn("held_before", F.sum("held").over(upto) - F.col("held"))
    named = sources.withColumnRenamed("source", "s")
    bin_ = bin_.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    bin_ = bin_.select(F.col("source").alias("s"), F.col("bin").alias("b"), "source_size", "target", "epochs", "rest", "held", "held_before")
    rows = drawn.join(bin_, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))).drop("s", "b")

    ends_here = (F.col("held_before") < F.col("rest")) & (F.col("held_before") + F.col("held") > F.col("rest"))
    sure = F.when(F.col("held_before") + F.col("held") <= F.col("rest"), F.col("size")).otherwise(F.lit(0))
    inside = Window.partitionBy("source", "bin").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("held_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    out = rows.where(~ends_here).withColumn("extra", sure).unionByName(rows.where(ends_here).withColumn("extra", cut))
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).cast("long")
    return out.select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", "epochs", "extra", taken.alias("taken"), "mark")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each epoch of each document, and one if the fraction takes it.

    Documents stay whole here: that in which a budget ends is taken if half of it fits. A document of size 0 comes once.
    """
    taken = mix(docs, id_col=id_col, text_col=text_col, **params)
    whole = F.col("epochs").cast("int") + (F.col("extra") * 2 >= F.col("size")).cast("int")
    mixed_id, mixed_mark, n, copy = fresh(docs, "mixed_id", "mixed_mark", "n_copies", "copy")
    times = taken.groupBy(F.col(id_col).alias(mixed_id), F.col("mark").alias(mixed_mark)).agg(F.max(F.when(F.col("size") == 0, F.lit(1)).otherwise(whole)).alias(n))
    times = times.where(F.col(n) > 0)
    met = docs.join(times, docs[id_col].eqNullSafe(times[mixed_id]) & (F.xxhash64(docs[text_col]) == times[mixed_mark]))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
