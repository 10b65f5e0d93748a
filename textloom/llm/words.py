"""Word and case conventions shared by the operators, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """The words of a text in order; an empty array for null or blank."""
    inner = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def n_words(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
