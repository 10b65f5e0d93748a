"""Editions: texts that several places share, each stored once as a numbered block."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.volumes import running


def edition_places(mapping: DataFrame, content: DataFrame, part: str, place: str, content_id: str, text: str, width: int = 50_000) -> DataFrame:
    """(part, place, block, content_id, text, first) of the places whose text isn't blank.

    Blocks are numbered from 0 in each part, in the order in which the places
    first name them; a place that names several has the first of them by id,
    and each of its blocks has its number. ``first`` marks the place that
    stands for a block. Numbers are running counts by ranges of places, so no
    task holds a part.
    """
    said = content.select(content_id, F.col(text).alias("text")).where(F.trim(F.coalesce("text", F.lit("")), F.lit(" \t\r\n\x0b\f")) != "")
    rows = mapping.select(part, place, content_id).join(said, content_id)
    by = [part, "at"]
    firsts = rows.groupBy(part, content_id).agg(F.min(place).alias("at"))
    counts = running(firsts.groupBy(*by).agg(F.count("*").alias("n")), [part], "at", width, {"upto": F.col("n")})
    # Blocks that begin at the same place are few: those that one place names.
    tied = F.row_number().over(Window.partitionBy(*by).orderBy(content_id))
    blocks = firsts.withColumn("tied", tied).join(counts, by).select(part, content_id, "at", (F.col("upto") - F.col("n") + F.col("tied") - 1).alias("block"))
    chosen = rows.groupBy(part, place).agg(F.min(F.struct(content_id, "text")).alias("x")).select(part, place, f"x.{content_id}", "x.text")
    return chosen.join(blocks, [part, content_id]).select(part, place, "block", content_id, "text", (F.col("at") == F.col(place)).alias("first"))


def edition_blocks(mapping: DataFrame, content: DataFrame, part: str, place: str, content_id: str, text: str, width: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """((part, place, block), (part, block, text)): places with the numbers of their blocks, and each block of each part that a place has."""
    placed = edition_places(mapping, content, part, place, content_id, text, width)
    blocks = placed.groupBy(part, "block").agg(F.min("text").alias("text"))
    return placed.select(part, place, "block"), blocks
