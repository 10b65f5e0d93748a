"""Removal of passages that occur more than once, by seed and extend.

*Seeds.* Runs of ``seed`` words are hashed, and of every ``window`` words in a
row the run with the least hash is chosen (winnowing, Schleimer et al. 2003;
the last one on ties). Equal windows choose equal seeds at equal places, so
each window belongs to one anchor, and a window can only be repeated where its
anchor is. *Join.* Anchors that occur once are dropped; documents meet on the
others. *Extend.* An anchor is extended both ways over all windows that belong
to it. If the extended run occurs elsewhere, all its windows are repeats;
otherwise the match ends inside, and the windows of that anchor are compared
with those of its other extended runs one by one. The union of the repeated windows are the maximal repeats of at
least ``window`` words.

Occurrences are never paired: they are counted by hash and joined with the
counts, so a passage in a third of all documents makes one row for each
occurrence, and copies leave each task summed. The texts are shuffled once, to
meet what is known of them. Windows are told apart by 128 bits of hashes, and
so are rows, by id and text; so an id may be null or repeated.

Defined results: a null or empty text has no words; a text shorter than
``window`` loses none, and one of any length is looked at as a whole; the same
words twice in one document count as two occurrences; rows with equal id and
text are two documents, which repeat each other; an empty table gives an empty
result; columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.hashing import Runs, mixed, signed, word_hashes
from textloom.tables import stage


def last_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` values in a row, the place of the least; the last one on ties."""
    best, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        have += step
    return best


def anchors_of(text: str, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(anchor hash, hash of the extended run, start of the first window, number of windows) of each anchor."""
    words = word_hashes(text)
    if len(words) < window:
        return None
    runs = Runs(words)
    seeds = runs.of_length(seed)
    at = last_least(seeds, window - seed + 1)
    change = np.flatnonzero(np.diff(at, prepend=-1))
    n = np.diff(change, append=len(at))
    anchor = at[change]
    reach = runs(change, change + n + window - 1) ^ mixed(((anchor - change) << 16 | n).astype(np.uint64))
    return seeds[anchor], reach, change, n


def occurrences(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(anchor, reach, m1, m2, start, n) of ``docs`` (text, m1, m2): every anchor of every row."""
    names = ["anchor", "reach", "m1", "m2", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i, text in enumerate(batch.column(0)):
                found = anchors_of(text.as_py(), window, seed)
                if found:
                    rows.append((i, *found))
                    held += len(found[0])
                if rows and (held > 50_000 or i + 1 == batch.num_rows):
                    of = pa.array(np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]))
                    a, b, c, d = (np.concatenate([r[k] for r in rows]) for k in range(1, 5))
                    yield pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b)), batch.column(1).take(of), batch.column(2).take(of), pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32))], names)
                    rows, held = [], 0

    return docs.select("text", "m1", "m2").mapInArrow(run, "anchor long, reach long, m1 long, m2 long, start int, n int")


def windows_of(met: DataFrame, window: int) -> DataFrame:
    """Every window of the anchors named in ``places``, with two independent hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, places) in enumerate(zip(batch.column(1), batch.column(4), strict=True)):
                words = word_hashes(text.as_py())
                starts = np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in places.as_py()])
                h = [Runs(x)(starts, starts + window) for x in (words, mixed(words + np.uint64(1)))]
                of = pa.array(np.full(len(starts), i))
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[0])), pa.array(signed(h[1])), batch.column(2).take(of), batch.column(3).take(of), pa.array(starts.astype(np.int32))], ["w1", "w2", "m1", "m2", "start"])

    return met.mapInArrow(run, "w1 long, w2 long, m1 long, m2 long, start int")


def cut_out(met: DataFrame, window: int) -> DataFrame:
    """The texts without the words that the windows in ``spans`` cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, texts, repeats = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = text.as_py().encode("utf-8").split()
                spans = spans.as_py()
                if spans:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, [s["start"] for s in spans], 1)
                    np.add.at(edge, [s["start"] + s["n"] + window - 1 for s in spans], -1)
                    inside = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    repeats.append([{"start": int(a), "end": int(b)} for a, b in turn])
                    removed.append(int(inside.sum()))
                    kept = compress(words, (~inside).tolist())
                else:
                    repeats.append([])
                    removed.append(0)
                    kept = words
                totals.append(len(words))
                texts.append(b" ".join(kept).decode("utf-8"))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(repeats, span)], ["id", "n_words", "n_removed", "text", "repeats"])

    return met.mapInArrow(run, f"id {met.schema['id'].dataType.simpleString()}, n_words long, n_removed long, text string, repeats array<struct<start: long, end: long>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, seed: int = 12) -> DataFrame:
    """(id, n_words, n_removed, text, repeats) of every document: the text without repeated passages, and where they were."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = ["m1", "m2"]
    docs = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(id_col, text).alias("m1"), F.xxhash64(text, F.lit("row")).alias("m2"))

    found = stage(occurrences(docs, window, seed), "repeat_occurrences")
    twice = found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor")
    # As a written table, it meets the occurrences by an exchange of its own, and Spark may split a hot anchor.
    shared = stage(found.join(stage(twice, "repeat_keys"), "anchor"), "repeat_anchors")
    place = F.struct("start", "n")
    groups = shared.groupBy("anchor", "reach").agg(F.count("*").alias("times"), F.min(F.struct(*row, "start", "n")).alias("first"))
    groups = stage(groups, "repeat_groups")
    whole = shared.join(groups.where("times > 1").select("anchor", "reach"), ["anchor", "reach"]).select(*row, "start", "n")

    # An anchor with an extended run of its own may still share windows with its other occurrences: one for each run stands for all.
    mixed_anchors = groups.groupBy("anchor").agg(F.min("times").alias("least")).where("least = 1").select("anchor")
    partial = groups.join(stage(mixed_anchors, "repeat_mixed"), "anchor").select("first.*").groupBy(*row).agg(F.collect_set(place).alias("places"))
    # Dealt by what both joins need, so the texts are shuffled once.
    texts = docs.repartition(*row)
    asked = stage(windows_of(texts.join(partial, row).select("id", "text", *row, "places"), window), "repeat_windows")
    again = asked.groupBy("w1", "w2").agg(F.count("*").alias("times")).where("times > 1").select("w1", "w2")
    single = asked.join(again, ["w1", "w2"]).select(*row, "start", F.lit(1).alias("n"))
    spans = whole.unionByName(single).groupBy(*row).agg(F.collect_set(place).alias("spans"))
    met = texts.join(spans, row, "left")
    return cut_out(met.select("id", "text", "spans"), window).withColumnRenamed("id", id_col)
