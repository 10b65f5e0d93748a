"""Upserts, lookups with outcomes, positional merges, incremental work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and the old ones that no new row replaces."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and the new ones whose key is new."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def zip_positions(left: DataFrame, right: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """(by, position, left, right): two ordered lists side by side, each as long as it is."""
    w = Window.partitionBy(*by).orderBy(order)
    number = lambda d, name: d.select(*by, F.row_number().over(w).cast("long").alias("position"), F.col(value).alias(name))
    return number(left, "left").join(number(right, "right"), [*by, "position"], "full")


def outcomes(proposed: DataFrame, existing: DataFrame, key: str, valid: Column, has: str) -> DataFrame:
    """(outcome, n) of writing proposed values: updated, skipped_existing, skipped_invalid or missing_page."""
    met = proposed.join(existing.select(key, F.col(has).alias("_has"), F.lit(True).alias("_page")), key, "left")
    outcome = F.when(F.col("_page").isNull(), "missing_page").when(~F.coalesce(valid, F.lit(False)), "skipped_invalid").when(F.col("_has").isNotNull(), "skipped_existing").otherwise("updated")
    return met.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def broken_links(rows: DataFrame, key: str, target: DataFrame, target_key: str, by: list[str]) -> DataFrame:
    """(by, checked, broken, without): foreign keys that hold, that don't, and that are null."""
    there = target.select(F.col(target_key).alias(key), F.lit(True).alias("_there")).distinct()
    met = rows.join(there, key, "left")
    has = F.col(key).isNotNull()
    return met.groupBy(*by).agg(F.count_if(has).alias("checked"), F.count_if(has & F.col("_there").isNull()).alias("broken"), F.count_if(~has).alias("without"))


def remaining(all_items: DataFrame, done: DataFrame, quarantined: DataFrame | None, key: str) -> DataFrame:
    """What is neither done nor quarantined."""
    left = all_items.join(done.select(key), key, "left_anti")
    return left if quarantined is None else left.join(quarantined.select(key), key, "left_anti")


def staleness(current: DataFrame, cached: DataFrame, key: str, layers: list[str]) -> DataFrame:
    """(key, recompute): the first layer whose fingerprint has changed, 'all' if nothing is cached, 'none' if all holds."""
    c = cached.select(key, *[F.col(x).alias(f"_{x}") for x in layers], F.lit(True).alias("_cached"))
    met = current.join(c, key, "left")
    out = F.when(F.col("_cached").isNull(), F.lit("all"))
    for x in layers:
        out = out.when(~F.col(x).eqNullSafe(F.col(f"_{x}")), F.lit(x))
    return met.select(key, out.otherwise("none").alias("recompute"))


def dead_letters(failures: DataFrame, key: str, limit: int = 3) -> DataFrame:
    """(key, n_failures, last_error) of items that failed ``limit`` times or more."""
    f = failures.groupBy(key).agg(F.count("*").alias("n_failures"), F.max_by("error", F.struct("at", "error")).alias("last_error"))
    return f.where(F.col("n_failures") >= limit)


def priced(rows: DataFrame, model: str, prices: DataFrame, prefix: str) -> DataFrame:
    """Rows with the price row of the longest prefix of their model; a small price table is joined by prefix lengths, not all with all."""
    p = prices.withColumn("_n", F.length(prefix))
    models = rows.select(model).distinct()
    # A row for each length of a prefix that the price table has.
    asked = models.join(F.broadcast(p.select("_n").distinct()), F.length(model) >= F.col("_n"))
    asked = asked.withColumn(prefix, F.substring(model, 1, F.col("_n")))
    best = asked.join(p, [prefix, "_n"]).groupBy(model).agg(F.max_by(F.struct(*prices.columns), "_n").alias("_price"))
    return rows.join(best, model, "left").select(*rows.columns, "_price.*")
