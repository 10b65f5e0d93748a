"""Codecs between logical paths (``/books/a:1:2``), ids (``a_1_2``) and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def index_of(path: Column) -> Column:
    """Without the leading ``/books/``."""
    return F.substr(path, F.lit(8))


def file_of(path: Column) -> Column:
    return F.concat(F.replace(path, F.lit(":"), F.lit("/")), F.lit(".json"))


def id_of(path: Column) -> Column:
    return F.replace(F.replace(path, F.lit("/books/"), F.lit("")), F.lit(":"), F.lit("_"))


def path_of(id_: Column) -> Column:
    return F.concat(F.lit("/books/"), F.replace(id_, F.lit("_"), F.lit(":")))


def slug_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^/books/([^:]+)", 1)


def parent_of(path: Column) -> Column:
    """Without the last step; null for a book."""
    return F.when(path.contains(":"), F.regexp_replace(path, r":[^:]*$", ""))


def steps_of(path: Column) -> Column:
    """The numbers after the book, as an array that sorts in tree order."""
    return F.transform(F.slice(F.split(path, ":"), 2, F.size(F.split(path, ":"))), lambda x: x.try_cast("int"))
