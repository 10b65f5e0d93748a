"""Writers: JSON documents without nulls, one folder a language, manifests, request lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_documents(docs: DataFrame, path: str, by: list[str] = ()) -> None:
    """JSON lines without null fields, one folder for each value of ``by``."""
    docs.write.mode("overwrite").option("ignoreNullFields", True).partitionBy(*by).json(path)


def write_per_language(rows: DataFrame, path: str, lang: str = "lang") -> None:
    """Replaces the folders of the languages that occur and leaves the others as they are."""
    rows.repartition(lang).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(lang).parquet(path)


def manifest(counts: DataFrame, key: str, value: str) -> DataFrame:
    """One row, {key: value} as JSON with sorted keys; for tables of a few thousand keys."""
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return counts.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def request_lines(requests: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Lines of JSON for a batch interface: {"custom_id": ..., "body": {...}}."""
    return requests.select(F.to_json(F.struct(F.col(id_col).cast("string").alias("custom_id"), F.struct(*fields).alias("body"))).alias("value"))


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
