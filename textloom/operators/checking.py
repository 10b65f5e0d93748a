"""Data-quality rules: rules are data, violations are arrays of structs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    field: str
    severity: str
    message: str
    #: True where a row breaks the rule; null counts as not broken.
    broken: Column


def checked(rows: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """(keep, violations, status): the broken rules of each row; 'error', 'warning' or 'pass'."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(r.field).alias("field"), F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message"))) for r in rules]))
    out = rows.select(*keep, found.alias("violations"))
    has = lambda s: F.exists("violations", lambda v: v["severity"] == s)
    return out.withColumn("status", F.when(has("error"), "error").when(has("warning"), "warning").otherwise("pass"))


def tally(done: DataFrame) -> DataFrame:
    """(field, severity, message, n) over all violations."""
    return done.select(F.explode("violations").alias("v")).groupBy("v.field", "v.severity", "v.message").agg(F.count("*").alias("n"))


def duplicates_within(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """(by, key, n) of keys that come more than once."""
    return rows.groupBy(*by, key).agg(F.count("*").alias("n")).where("n > 1")


def reconciled(parents: DataFrame, children: DataFrame, key: str, stated: str) -> DataFrame:
    """(key, stated, counted, agrees): totals that parents state against their children."""
    n = children.groupBy(key).agg(F.count("*").alias("counted"))
    met = parents.select(key, F.col(stated).alias("stated")).join(n, key, "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return met.withColumn("agrees", F.col("stated").eqNullSafe(F.col("counted")))
