"""Order-dependent operators: numbering, navigation, gaps, runs, context windows, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.tables import stage


def siblings(rows: DataFrame, parent: list[str], order: list[Column], path: str) -> DataFrame:
    """With ``local_index`` from 1 and the paths ``prev`` and ``next`` among siblings."""
    w = Window.partitionBy(*parent).orderBy(*order)
    return rows.withColumns({"local_index": F.row_number().over(w).cast("long"), "prev": F.lag(path).over(w), "next": F.lead(path).over(w)})


def running_number(rows: DataFrame, block: list[str], order: list[Column], counted: Column, blocks_in_order: list[Column], name: str = "index") -> DataFrame:
    """A number over the whole of ordered blocks that counts the rows that count.

    Blocks are counted first and their prefix sums joined back, so no task
    sees more than a block; only the block counts are ordered in one place.
    """
    per_block = rows.groupBy(*block).agg(F.count_if(counted).alias("_in_block"))
    before = F.sum("_in_block").over(Window.orderBy(*blocks_in_order)) - F.col("_in_block")
    per_block = per_block.withColumn("_before", before).drop("_in_block")
    inside = F.count_if(counted).over(Window.partitionBy(*block).orderBy(*order))
    return rows.join(per_block, block).withColumn(name, F.when(counted, F.col("_before") + inside)).drop("_before")


def next_keys(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """(by, key, next) of distinct (by, key): the next larger key of the same group.

    A group may be most of the table, so keys are dealt by range and each range
    is ordered by itself; only the least key of every range is looked at across
    ranges.
    """
    dealt = stage(rows.select(*by, key).where(F.col(key).isNotNull()).distinct().repartitionByRange(*by, key).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = dealt.withColumn("_next", F.lead(key).over(Window.partitionBy(*by, "_range").orderBy(key)))
    firsts = dealt.groupBy(*by, "_range").agg(F.min(key).alias("_first"))
    firsts = firsts.withColumn("_first", F.lead("_first").over(Window.partitionBy(*by).orderBy("_range")))
    names = {c: f"_f{i}" for i, c in enumerate([*by, "_range"])}
    firsts = firsts.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(f)) for c, f in names.items()]
    return inside.join(firsts, same, "left").select(*by, key, F.coalesce("_next", "_first").alias("next"))


def sequence_gaps(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, after, before, missing): where consecutive numbers aren't consecutive."""
    out = next_keys(rows, by, number).where(F.col("next") > F.col(number) + 1)
    return out.select(*by, F.col(number).alias("after"), F.col("next").alias("before"), (F.col("next") - F.col(number) - 1).alias("missing"))


def runs(rows: DataFrame, by: list[str], order: list[Column], value: str) -> DataFrame:
    """(by, run, value, n, first): consecutive rows of one value, numbered from 1."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = rows.withColumn("_new", (~F.lag(value).over(w).eqNullSafe(F.col(value)) | (F.row_number().over(w) == 1)).cast("int"))
    numbered = changed.withColumns({"run": F.sum("_new").over(w), "_at": F.row_number().over(w)})
    return numbered.groupBy(*by, "run", value).agg(F.count("*").alias("n"), F.min("_at").cast("long").alias("first"))


#: Wanted words up to this number are sent to all tasks.
MOST_WANTED = 200_000


def context_windows(rows: DataFrame, id_col: str, words: Column, wanted: DataFrame, radius: int = 10, most: int = 3) -> DataFrame:
    """(word, id, position, context, place): up to ``most`` places of each wanted word, with the words around it.

    Only (word, id, position) is ranked; the few places that win meet their
    texts again.
    """
    named = wanted.select("word").distinct()
    named = F.broadcast(named) if named.limit(MOST_WANTED + 1).count() <= MOST_WANTED else named
    hits = rows.select(id_col, F.posexplode(words).alias("position", "word")).join(named, "word")
    place = F.row_number().over(Window.partitionBy("word").orderBy(id_col, "position"))
    first = hits.withColumn("place", place.cast("long")).where(F.col("place") <= most)
    start = F.greatest(F.col("position") - radius, F.lit(0))
    context = F.array_join(F.slice("w", start + 1, F.col("position") - start + 1 + radius), " ")
    met = first.join(rows.select(id_col, words.alias("w")), id_col)
    return met.select("word", id_col, F.col("position").cast("long").alias("position"), context.alias("context"), "place")


def stratified_sample(rows: DataFrame, strata: list[str], id_col: str, each: int, seed: str = "sample") -> DataFrame:
    """``each`` rows of every stratum, in the order of a hash; the same rows every time."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(order, id_col))
    return rows.withColumn("place", place.cast("long")).where(F.col("place") <= each)


def round_robin(rows: DataFrame, stratum: str, group: str, id_col: str, quota: int) -> DataFrame:
    """Up to ``quota`` rows of each stratum, dealt over its groups in turn.

    No more than ``quota`` rows of a group can win, so both rankings are limited
    in each task before their rows are shuffled.
    """
    inner = F.row_number().over(Window.partitionBy(stratum, group).orderBy(F.md5(F.col(id_col).cast("string")), id_col))
    turn = rows.withColumn("_turn", inner).where(F.col("_turn") <= quota)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_turn", group, id_col))
    return turn.withColumn("place", place.cast("long")).where(F.col("place") <= quota).drop("_turn")


def range_slice(rows: DataFrame, order: list[Column], start: int, end: int) -> DataFrame:
    """Rows ``start`` to ``end``, from 1 and inclusive, of the whole order."""
    return rows.orderBy(*order).offset(start - 1).limit(end - start + 1)


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    """``rows`` with their places from 1 within ``by``, in the order of ``order``, which should tell all rows apart.

    The rows are dealt into ranges of (by, order), so a group of any size is
    many ranges; a place is that within the range and the sizes of the ranges
    before. The ranges are written once, as they must not change in between.
    """
    dealt = stage(rows.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "numbered_rows")
    sizes = dealt.groupBy(*by, "_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    same = [F.col("_range") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    met = dealt.withColumn("_inside", inside).join(sizes, same)
    return met.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_of", "_before", "_inside", *[f"_by_{c}" for c in by])


def blocked_lists(rows: DataFrame, keys: list[str], items: list[str], size: int = 1000) -> DataFrame:
    """(keys, block, n, items): the items of each key in order, in blocks of ``size`` from 0; an item is a struct if it has several columns.

    A key of any size is as many rows as it needs, and no list is longer than
    a block.
    """
    item = F.struct(*items) if len(items) > 1 else F.col(items[0])
    placed = numbered(rows.select(*keys, *items), keys, items, "_n").withColumn("block", F.floor((F.col("_n") - 1) / F.lit(size)).cast("long"))
    lists = placed.groupBy(*keys, "block").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("_n", item.alias("x")))).alias("_xs"))
    return lists.select(*keys, "block", "n", F.transform("_xs", lambda x: x["x"]).alias("items"))
