"""Removal of lines that many documents share, with levelled sorted runs.

A line's key is the line without spaces at its ends, A-Z lower-cased; keys are
told apart by 128 bits of BLAKE2. The store (``LineRuns``) is a merge tree of
runs: tables of (key, number of documents), dealt and sorted by key into a
fixed number of buckets, so that a batch dealt likewise meets a run bucket by
bucket, and the run isn't shuffled. A new batch of documents is counted by
key, anti-joined with the keys that are settled as common, and added as a run
of its own. ``FAN`` runs of a level are compacted into one of the next; there
keys that have reached the threshold become settled. In the end all runs are
merged once, and the common keys are known; older batches need not be read
again for that.

Lines are then dropped from whole documents: the (document, key) rows that the
batches left meet the common keys, and the texts are shuffled once to meet
what they lose.

Defined results: a null or empty text is one empty line; a blank line has an
empty key, which is never common unless ``shortest`` is 0; a line counts once
a document however often it stands there; rows with equal id and text are two
documents; a text of any length is read whole, and its keys go on in slices; a
document all of whose lines go is an empty text; ties can't arise, as a key is
common or not; an empty table gives an empty result; columns other than id and
text are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.tables import shared_dir, stage

SPACE = b" \t\n\x0b\f\r"
KEY = ["h1", "h2"]
#: Runs of a level that are compacted into one.
FAN = 4
#: Keys that go on at a time.
SLICE = 100_000


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def hashed(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def characters(key: bytes) -> int:
    """Code points of UTF-8."""
    return len(key) if key.isascii() else len(key.decode("utf-8"))


def occurrences(docs: DataFrame, shortest: int = 1) -> DataFrame:
    """(m1, m2, h1, h2) of ``docs`` (text, m1, m2): every key of every row, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            of: list[int] = []
            last = batch.num_rows - 1
            for i, text in enumerate(batch.column(0)):
                own = {key for line in text.as_py().encode().split(b"\n") if (key := key_of(line)) or not shortest}
                keys += [hashed(k) for k in own if len(k) >= shortest and (shortest < 2 or characters(k) >= shortest)]
                of += [i] * (len(keys) - len(of))
                if len(keys) >= SLICE or i == last:
                    for at in range(0, len(keys), SLICE):
                        rows = pa.array(of[at : at + SLICE])
                        h = np.frombuffer(b"".join(keys[at : at + SLICE]), np.int64).reshape(-1, 2)
                        yield pa.RecordBatch.from_arrays([batch.column(1).take(rows), batch.column(2).take(rows), pa.array(h[:, 0]), pa.array(h[:, 1])], ["m1", "m2", *KEY])
                    keys, of = [], []

    return docs.select("text", "m1", "m2").mapInArrow(run, "m1 long, m2 long, h1 long, h2 long")


class LineRuns:
    """Numbers of documents by key, in levels of sorted runs, and the keys that are settled as common."""

    def __init__(self, spark: SparkSession, threshold: int, fan: int = FAN) -> None:
        self.spark, self.threshold, self.fan = spark, threshold, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.common: str | None = None

    def _write(self, run: DataFrame) -> str:
        """A sorted run; its table's files are in the shared folder, one a bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = run.repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{shared_dir(self.spark)}/{name}").saveAsTable(name)
        return name

    def _merged(self, runs: list[str]) -> DataFrame:
        """The runs' numbers added up.

        Read as files, not as tables: Spark 4.1 takes a union of bucketed
        tables as dealt by key, but its tasks see one bucket of one of them.
        """
        files = [f"{shared_dir(self.spark)}/{name}" for name in runs]
        return self.spark.read.schema("h1 long, h2 long, n long").parquet(*files).groupBy(*KEY).agg(F.sum("n").alias("n"))

    def _settled(self, merged: DataFrame) -> DataFrame:
        found = merged.where(F.col("n") >= self.threshold).select(*KEY)
        if not self.common:
            return found
        before = self.spark.read.schema("h1 long, h2 long").parquet(f"{shared_dir(self.spark)}/{self.common}")
        return found.unionByName(before).distinct()

    def add(self, batch: DataFrame) -> None:
        """Count a batch of occurrences; what is settled isn't counted any more."""
        new = batch.groupBy(*KEY).agg(F.count("*").alias("n"))
        if self.common:
            new = new.join(self.spark.table(self.common), KEY, "left_anti")
        self.levels[0].append(self._write(new))
        level = 0
        while len(self.levels[level]) >= self.fan:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        old, settled = self.levels[level], self.common
        merged = self._write(self._merged(old))
        self.common = self._write(self._settled(self._merged([merged])))
        rest = self._write(self.spark.table(merged).where(F.col("n") < self.threshold))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level] = []
        self.levels[level + 1].append(rest)
        self._drop([*old, merged, *([settled] if settled else [])])

    def _drop(self, names: list[str]) -> None:
        """Forget runs that are merged, files too."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(self.spark)}/{name}")
            self.spark.sql(f"DROP TABLE {name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def frequent(self) -> DataFrame:
        """(h1, h2) of all common keys: one last merge of what is left."""
        runs = [name for level in self.levels for name in level]
        found = stage(self._settled(self._merged(runs)), "lines_common")
        self._drop([*runs, *([self.common] if self.common else [])])
        self.levels, self.common = [[]], None
        return found


def without(met: DataFrame) -> DataFrame:
    """(id, n_lines, n_dropped, text) of ``met`` (id, text, gone): texts without the lines whose keys ``gone`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, dropped, texts = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2), strict=True):
                lines = text.as_py().encode().split(b"\n")
                kept = lines
                if gone.is_valid:
                    h = gone.values
                    out = {bytes(x) for x in np.stack([h.field(0).to_numpy(), h.field(1).to_numpy()], 1)}
                    kept = [x for x in lines if hashed(key_of(x)) not in out]
                totals.append(len(lines))
                dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())], ["id", "n_lines", "n_dropped", "text"])

    return met.mapInArrow(run, f"id {met.schema['id'].dataType.simpleString()}, n_lines long, n_dropped long, text string")


def batches_of(docs: DataFrame, most: int = 8) -> list[DataFrame]:
    """A table of files in batches of whole files, as they would have come one after another; ``most`` batches at most, of four files at least."""
    files = sorted(docs.inputFiles())
    step = max(4, -(-len(files) // most))
    read = docs.sparkSession.read.schema(docs.schema)
    return [read.parquet(*files[i : i + step]) for i in range(0, len(files), step)] or [docs]


def drop_common_lines(batches: list[DataFrame], id_col: str = "doc_id", text_col: str = "text", threshold: int = 10, shortest: int = 1, fan: int = FAN) -> DataFrame:
    """(id, n_lines, n_dropped, text) of every document of all batches, without the lines whose keys ``threshold`` documents or more share."""
    store, found, texts = LineRuns(batches[0].sparkSession, threshold, fan), [], []
    for batch in batches:
        text = F.coalesce(F.col(text_col), F.lit(""))
        docs = batch.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(id_col, text).alias("m1"), F.xxhash64(text, F.lit("row")).alias("m2"))
        own = stage(occurrences(docs, shortest), "line_occurrences")
        store.add(own)
        found.append(own)
        texts.append(docs)
    common = store.frequent()
    every, whole = found[0], texts[0]
    for own, docs in zip(found[1:], texts[1:], strict=True):
        every, whole = every.unionByName(own), whole.unionByName(docs)
    gone = every.join(common, KEY).groupBy("m1", "m2").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    # The smaller side is hashed, so that texts needn't be sorted.
    met = whole.repartition("m1", "m2").join(gone.hint("shuffle_hash"), ["m1", "m2"], "left").select("id", "text", "gone")
    return without(met).withColumnRenamed("id", id_col)
