"""Functions on arrays, maps and structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_nulls(m: Column) -> Column:
    """A map without null values."""
    return F.map_filter(m, lambda _, v: v.isNotNull())


def filled(m: Column, keys: list[str], default: str = "") -> Column:
    """A map that has all of ``keys``; those missing or null get the default."""
    rest = F.map_filter(m, lambda k, v: ~k.isin(*keys))
    have = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(default))) for k in keys]))
    return F.map_concat(have, rest)


def overlaid(old: Column, new: Column) -> Column:
    """Both maps; where both have a key, the new value."""
    keep = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.coalesce(F.map_concat(keep, new), old, new)


def kept_over(old: Column, new: Column) -> Column:
    """Both maps; old values win unless null or empty."""
    return overlaid(new, F.map_filter(old, lambda _, v: v.isNotNull() & (v != "")))


def chunk_offsets(texts: Column) -> Column:
    """For an array of texts: struct(start, end) of each in words counted over all."""
    sizes = F.transform(texts, lambda t: F.size(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")))
    total = lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x)
    return F.transform(texts, lambda t, i: F.struct(total(i).alias("start"), total(i + 1).alias("end")))


def joined_slice(words: Column, start: Column, end: Column, lang: Column) -> Column:
    """Words from start up to end; Chinese words aren't parted by spaces."""
    part = F.slice(words, start + 1, end - start)
    return F.when(lang == "zh", F.array_join(part, "")).otherwise(F.array_join(part, " "))


def joined_kind(chunks: Column, kind: str, text: str = "text") -> Column:
    return F.array_join(F.transform(F.filter(chunks, lambda c: c["kind"] == kind), lambda c: c[text]), " ")


def contiguous(spans: Column) -> Column:
    """Spans (start, end) in which each starts where the one before ends, the first at 0."""
    return F.transform(spans, lambda s, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"]).alias("start"), s["end"].alias("end")))


def jaccard(a: Column, b: Column) -> Column:
    """Shared elements over all; two empty sets are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def recall(wanted: Column, found: Column) -> Column:
    return F.coalesce(F.size(F.array_intersect(wanted, found)) / F.nullif(F.size(F.array_distinct(wanted)), F.lit(0)), F.lit(1.0))


def pairs_in_order(items: Column) -> Column:
    """Consecutive pairs of an array; none for fewer than two."""
    made = F.transform(F.sequence(F.lit(1), F.size(items) - 1), lambda i: F.slice(items, i, 2))
    return F.when(F.size(items) >= 2, made).otherwise(F.array().cast("array<array<string>>"))


def combinations(items: Column) -> Column:
    """The whole chain and its consecutive pairs, as keys joined by dashes."""
    whole = F.array_join(items, "-")
    pairs = F.transform(pairs_in_order(items), lambda p: F.array_join(p, "-"))
    return F.array_distinct(F.concat(F.array(whole), pairs))


def violations(*rules: Column) -> Column:
    """The non-null ones of rules that are struct(field, severity, message) where broken, else null."""
    return F.array_compact(F.array(*rules))


def rule(broken: Column, field: str, severity: str, message: str) -> Column:
    return F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(severity).alias("severity"), F.lit(message).alias("message")))
