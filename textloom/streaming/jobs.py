"""Incremental jobs: failure counters, event counts in windows, resumable work."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON events as they are added to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).json(path)


def windowed_counts(events: DataFrame, at: str, by: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, by, n) in tumbling windows; state is dropped once the watermark has passed."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def quarantined(events: DataFrame, key: str, limit: int = 3) -> DataFrame:
    """(key, n_failures, last_error) as soon as an item has failed ``limit`` times since it last succeeded.

    ``events`` has the key, ``status`` ('error' or other) and ``error``. The
    state of a key is a counter.
    """

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        out = []
        for b in batches:
            for status, error in zip(b["status"], b["error"], strict=True):
                n = n + 1 if status == "error" else 0
                if n == limit:
                    out.append((k[0], n, error))
        state.update((n,))
        yield pd.DataFrame(out, columns=[key, "n_failures", "last_error"])

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, "status", "error").groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n_failures long, last_error string", "n long", "append", GroupStateTimeout.NoTimeout)


def process_new(source: DataFrame, done_path: str, key: str, work, checkpoint: str):
    """Runs ``work`` on each micro-batch's items that ``done_path`` lacks and appends the results; a restart goes on where it stopped."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        df = df.dropDuplicates([key])
        try:
            df = df.join(spark.read.parquet(done_path).select(key), key, "left_anti")
        except Exception as e:  # nothing has been written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        work(df).write.mode("append").parquet(done_path)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
