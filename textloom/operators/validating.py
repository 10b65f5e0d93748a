"""Rules for nested documents of any depth; every violation has its path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.variants import items, kind, said

#: What a rule says of an object: messages, null where nothing is wrong.
Check = Callable[[Column], list[Column]]


@dataclass(frozen=True)
class Rule:
    """For the objects whose place fits ``where``, a regular expression on the path with [*] for every index, from its beginning."""

    where: str
    severity: str
    check: Check


def _when(bad: Column, *message: Column | str) -> Column:
    return F.when(bad, F.concat(*[m if isinstance(m, Column) else F.lit(m) for m in message]))


def _at(v: Column, field: str) -> Column:
    return F.try_variant_get(v, f"$.{field}", "variant")


def empty(x: Column) -> Column:
    """Missing, null, false, 0 or without anything in it."""
    return x.isNull() | F.is_variant_null(x) | F.to_json(x).isin('""', "[]", "{}", "false", "0")


def required(where: str, *fields: str, severity: str = "error") -> Rule:
    return Rule(where, severity, lambda v: [_when(_at(v, f).isNull(), f"missing {f}") for f in fields])


def filled(where: str, *fields: str, severity: str = "warning") -> Rule:
    return Rule(where, severity, lambda v: [_when(empty(_at(v, f)), f"no {f}") for f in fields])


def prefixed(where: str, field: str, prefix: str, severity: str = "error") -> Rule:
    """A text that is there begins so."""
    return Rule(where, severity, lambda v: [_when((said(v, f"$.{field}") != "") & ~said(v, f"$.{field}").startswith(prefix), f"{field} isn't under {prefix}: ", said(v, f"$.{field}"))])


def one_of(where: str, field: str, *values: str, severity: str = "error") -> Rule:
    return Rule(where, severity, lambda v: [_when((said(v, f"$.{field}") != "") & ~said(v, f"$.{field}").isin(*values), f"unknown {field}: ", said(v, f"$.{field}"))])


def all_prefixed(where: str, field: str, prefix: str, severity: str = "error") -> Rule:
    """Every text of an array begins so; the first that doesn't is told."""
    bad = lambda v: F.filter(F.transform(items(v, f"$.{field}"), lambda x: x.cast("string")), lambda t: ~t.startswith(prefix))
    return Rule(where, severity, lambda v: [_when(F.size(bad(v)) > 0, f"{field} isn't under {prefix}: ", F.try_element_at(bad(v), F.lit(1)))])


def arrays_of(where: str, field: str, prefix: str, severity: str = "error") -> Rule:
    """Each value of an object is an array of texts that begin so."""

    def check(v: Column) -> list[Column]:
        each = F.map_entries(F.coalesce(F.try_variant_get(v, f"$.{field}", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
        told = F.transform(each, lambda e: F.when(kind(e["value"]) != "ARRAY", F.concat(e["key"], F.lit(" is no array"))).otherwise(F.concat(e["key"], F.lit(" isn't under "), F.lit(f"{prefix}: "), F.try_element_at(F.filter(F.transform(items(e["value"], "$"), lambda x: x.cast("string")), lambda t: ~t.startswith(prefix)), F.lit(1)))))
        bad = F.filter(told, lambda t: t.isNotNull())
        return [_when(F.size(bad) > 0, f"{field}: ", F.array_join(F.array_sort(bad), "; "))]

    return Rule(where, severity, check)


def counted(where: str, field: str, array: str, but: tuple[str, str], severity: str = "warning") -> Rule:
    """A number is that of the elements of an array, without those whose field ``but[0]`` is ``but[1]``."""

    def check(v: Column) -> list[Column]:
        n = F.size(F.filter(items(v, f"$.{array}"), lambda x: ~said(x, f"$.{but[0]}").eqNullSafe(F.lit(but[1]))))
        told = F.try_variant_get(v, f"$.{field}", "long")
        return [_when((F.size(items(v, f"$.{array}")) > 0) & (told != n), f"{field} is ", told.cast("string"), F.lit(", but there are "), n.cast("string"))]

    return Rule(where, severity, check)


def unique(where: str, array: str, field: str, but: tuple[str, str], severity: str = "error") -> Rule:
    """A field has no value twice among the elements of an array, without those whose field ``but[0]`` is ``but[1]``."""

    def check(v: Column) -> list[Column]:
        values = F.filter(F.transform(F.filter(items(v, f"$.{array}"), lambda x: ~said(x, f"$.{but[0]}").eqNullSafe(F.lit(but[1]))), lambda x: F.try_variant_get(x, f"$.{field}", "string")), lambda x: x.isNotNull())
        first = F.struct(F.lit(None).cast("string").alias("last"), F.array().cast("array<string>").alias("twice"))
        step = lambda a, x: F.struct(x.alias("last"), F.when((x == a["last"]) & ~F.array_contains(a["twice"], x), F.array_append(a["twice"], x)).otherwise(a["twice"]).alias("twice"))
        twice = F.aggregate(F.array_sort(values), first, step, lambda a: a["twice"])
        return [_when(F.size(twice) > 0, f"{array}: {field} more than once: ", F.array_join(twice, ", "))]

    return Rule(where, severity, check)


def nodes(docs: DataFrame, key: str, v: str) -> DataFrame:
    """(key, path, place, v): the objects and arrays of each document, itself included, at any depth; ``place`` is the path with [*] for every index.

    A recursive query whose rounds are the levels of the documents; texts and
    numbers aren't rows, as the rules of their objects see to them.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    inner = "schema_of_variant(e.value) LIKE 'OBJECT%' OR schema_of_variant(e.value) LIKE 'ARRAY%'"
    return spark.sql(
        f"""WITH RECURSIVE t(k, path, place, v) AS (
          SELECT k, '', '', v FROM {{docs}} WHERE v IS NOT NULL
          UNION ALL SELECT t.k, concat(t.path, coalesce(concat('.', e.key), concat('[', e.pos, ']'))), concat(t.place, coalesce(concat('.', e.key), '[*]')), e.value FROM t, LATERAL variant_explode(t.v) e WHERE {inner})
        SELECT k, path, place, v FROM t""", docs=docs.select(F.col(key).alias("k"), F.col(v).alias("v")),
    ).withColumnRenamed("k", key)


def violations(docs: DataFrame, key: str, text: str, rules: list[Rule]) -> DataFrame:
    """(key, path, severity, message) of JSON documents; what isn't JSON, or no object, has that as its only one."""
    parsed = docs.select(key, F.try_parse_json(text).alias("v"))
    whole = F.when(F.col("v").isNull(), "invalid JSON").when(kind(F.col("v")) != "OBJECT", F.concat(F.lit("no object but "), F.lower(kind(F.col("v")))))
    wrong = parsed.select(key, F.lit("").alias("path"), F.lit("error").alias("severity"), whole.alias("message")).where("message IS NOT NULL")
    n = nodes(parsed.where(kind(F.col("v")) == "OBJECT"), key, "v").where(kind(F.col("v")) == "OBJECT")
    told = [F.when(F.col("place").rlike(f"^(?:{r.where})$"), F.struct(F.lit(r.severity).alias("severity"), m.alias("message"))) for r in rules for m in r.check(F.col("v"))]
    found = n.select(key, "path", F.explode(F.filter(F.array(*told), lambda x: x["message"].isNotNull())).alias("x"))
    return found.select(key, "path", "x.severity", "x.message").unionByName(wrong)


# Kinds of documents and parts, and where paths lie.
KINDS = ["chapter_list", "verse_list", "verse_content", "verse_detail", "person_content", "person_list"]
PARTS = ["Verse", "Volume", "Book", "Chapter", "Hadith", "Heading", "Section"]
BOOKS, PEOPLE = "/books/", "/people/narrators/"

_CHAPTER, _VERSE = r"\.data(?:\.chapters\[\*\])*", r"\.data(?:\.chapters\[\*\])*\.verses\[\*\]"
HEADING = ("part_type", "Heading")


def _unless_heading(rule: Rule) -> Rule:
    return Rule(rule.where, rule.severity, lambda v: [F.when(~said(v, f"$.{HEADING[0]}").eqNullSafe(F.lit(HEADING[1])), m) for m in rule.check(v)])


def _of_kind(rule: Rule, value: str) -> Rule:
    """The rule for the ``data`` of documents of a kind."""

    def check(v: Column) -> list[Column]:
        return [F.when(said(v, "$.kind") == value, m) for m in rule.check(_at(v, "data"))]

    return Rule("", rule.severity, check)


#: Of books: chapters in chapters at any depth, their verses, and of people.
BOOK_RULES = [
    required("", "kind", "index", "data"), one_of("", "kind", *KINDS), prefixed(_CHAPTER, "path", BOOKS), filled(_CHAPTER, "titles"), one_of(_CHAPTER, "part_type", *PARTS), counted(_CHAPTER, "verse_count", "verses", HEADING), unique(_CHAPTER, "verses", "local_index", HEADING),
    *[prefixed(rf"{_CHAPTER}\.nav", way, BOOKS) for way in ("prev", "next", "up")], *[_unless_heading(r) for r in (required(_VERSE, "local_index"), prefixed(_VERSE, "path", BOOKS), filled(_VERSE, "text"), arrays_of(_VERSE, "relations", BOOKS))],
    Rule(rf"{_VERSE}\.narrator_chain\.parts\[\*\]", "error", lambda v: [F.when(said(v, "$.kind") == "narrator", m) for m in prefixed("", "path", PEOPLE).check(v)]),
]
PERSON_RULES = [_of_kind(r, "person_content") for r in (required("", "index", "titles", "path"), prefixed("", "path", PEOPLE), all_prefixed("", "verse_paths", BOOKS))]
