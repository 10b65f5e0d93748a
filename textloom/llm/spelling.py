"""Grouping of spelling variants by two-dimensional range reporting.

*Words.* Maximal runs of letters are counted over whole texts, summed in each
task before they are shuffled. *Near.* Two words are near if one inserted,
deleted or replaced code point parts them. Take a word and the place of the
edit: what stands before it is a prefix, so an interval of the words in
forward order; what follows is a suffix, so an interval of the words in
reverse order. Words in both are the near ones, and a wavelet tree over the
reverse ranks in forward order reports them.

*Shards.* The edit falls into the first or the second half of a word, and the
other half is whole; so a word goes to one shard by each half. A shard holds
words of one length and of one code point less, which share all but a segment
of places. A shard over ``CAPACITY`` code points is parted by halves of its
segment, as often as needed: at one place no more words fit than there are
letters. Each near pair has one shard, in which its edit falls (of equal
letters in a row the first counts as the deleted one), so counts add up.
Neither a task nor the driver ever sees all words.

*Forms.* A word's form is its most frequent near word, if that is ``ratio``
times as frequent; roots follow forms to the last by doubling steps, no more
than the logarithm of the largest count.

Defined results: null and empty texts have no words; a null id counts as an
empty text in what marks a run; very long texts are read in pieces that end
between words; rows with equal id and text are two documents; of near words
equally frequent the first in code-point order is the form; an empty table
gives an empty result; columns other than id and text are ignored, whatever
their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.tables import stage

#: Letters in Latin-1, after A-Z are lower-cased: one byte a code point.
LETTERS = rb"[a-z\xC0-\xFF]"
#: Code points of a text that are read at a time, words counted in a task before they go on, code points of a shard.
PIECE, HELD, CAPACITY = 1 << 20, 300_000, 500_000
SALTS = 64


def pieces(text: str) -> Iterator[bytes]:
    """The text in Latin-1 with A-Z lower-cased and a mark for any other character, in parts that end where a word does."""
    if len(text) <= PIECE:
        yield text.encode("latin-1", "replace").lower()
        return
    gap, at = re.compile(r"[^A-Za-zÀ-ÿ]"), 0
    while at < len(text):
        found = gap.search(text, min(at + PIECE, len(text)))
        end = found.end() if found else len(text)
        yield text[at:end].encode("latin-1", "replace").lower()
        at = end


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, at_least: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of words of at least ``shortest`` code points found ``at_least`` times.

    Let h be the crc32 of ``<id>:<run>``: where ``every`` divides it, the run
    loses its code point h modulo its length (0: nowhere).
    """
    run = re.compile(LETTERS + b"{%d,}" % shortest)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                mark = crc32(f"{doc_id or ''}:".encode())
                for piece in pieces(text.as_py()):
                    for word, n in Counter(run.findall(piece)).items():
                        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), mark)
                        if every and h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shortest:
                                continue
                        held[word] += n
                    if len(held) > HELD:
                        yield out()
        if held:
            yield out()

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


class WaveletTree:
    """Over a permutation, level by level: reports the places of a range whose values lie in another."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels, self.bits = [], max(1, int(len(values) - 1).bit_length())
        for b in reversed(range(self.bits)):
            bit = (values >> b & 1).astype(bool)
            ones = np.concatenate(([0], np.cumsum(bit)))
            self.levels.append((ones, len(values) - int(ones[-1])))
            values = np.concatenate((values[~bit], values[bit]))

    def report(self, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) for all values of [low, high) at places [start, end)."""
        query, node = np.arange(len(start)), np.zeros(len(start), np.int64)
        for b, (ones, zeros) in zip(reversed(range(self.bits)), self.levels, strict=True):
            i, j = ones[start], ones[end]
            start, end = np.concatenate((start - i, zeros + i)), np.concatenate((end - j, zeros + j))
            query, node = np.tile(query, 2), np.concatenate((node << 1, node << 1 | 1))
            keep = (start < end) & (node + 1 << b > low[query]) & (node << b < high[query])
            query, node, start, end = query[keep], node[keep], start[keep], end[keep]
        return query, node


def _shared(rows: np.ndarray) -> np.ndarray:
    """For sorted rows, how many code points each has in common with the one before; -1 for the first."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate(([-1], np.where(differ.any(1), differ.argmax(1), rows.shape[1])))


def _intervals(shared: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows, start and end of those that begin with the same ``depth`` code points."""
    edge = np.flatnonzero(shared < depth)
    of = np.cumsum(shared < depth) - 1
    return edge[of], np.append(edge[1:], len(shared))[of]


def near_of(words: list[str], size: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the words, and (a, b) by places in it, both ways: words of ``size`` code points against those a replaced or deleted one in [lo, hi) away."""
    texts = np.array(words, f"U{size}")
    order = np.argsort(texts, kind="stable")
    chars = texts[order].view(np.uint32).reshape(-1, size)
    short = chars[:, -1] == 0
    turned = chars[:, ::-1].copy()
    turned[short] = np.roll(turned[short], -1, axis=1)
    back = np.argsort(turned.view(f"U{size}").ravel(), kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[back] = np.arange(len(words))
    tree, ahead, behind = WaveletTree(rank), _shared(chars), _shared(turned[back])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in range(lo, hi):
        (start, end), (low, high) = _intervals(ahead, p), _intervals(behind, size - 1 - p)
        low, high = low[rank], high[rank]
        ask = np.flatnonzero(~short & (end - start > 1) & (high - low > 1))
        query, value = tree.report(start[ask], end[ask], low[ask], high[ask])
        query, found = ask[query], back[value]
        fewer = short[found]
        keep = (query != found) & (~fewer | (p == 0) | (chars[query, p - 1] != chars[query, p]))
        query, found, fewer = query[keep], found[keep], fewer[keep]
        a += [query, found[fewer]]
        b += [found, query[fewer]]
    return order, np.concatenate(a), np.concatenate(b)


def _halves(words: DataFrame) -> DataFrame:
    """(word, n, size, lo, hi): each word by either half, among words of its length and as the shorter one."""
    size = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size")
    half = F.expr("explode(array(struct(0 AS lo, size div 2 AS hi), struct(size div 2 AS lo, size AS hi)))").alias("s")
    return words.select("word", "n", size).select("*", half).selectExpr("word", "n", "size", "int(s.lo) AS lo", "int(s.hi) AS hi")


def _keyed(parts: DataFrame) -> DataFrame:
    """With a hash of all that stands outside the segment."""
    rest = "concat(substring(word, 1, lo), substring(word, if(length(word) = size, hi + 1, hi), size))"
    return parts.withColumn("key", F.expr(f"xxhash64(size, lo, hi, {rest})"))


def sharded(words: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(word, n, size, lo, hi, bucket): buckets of whole shards, of about ``capacity`` code points at most."""
    shard = ["size", "lo", "hi", "key"]
    parts = _keyed(_halves(words))
    while True:
        counts = parts.groupBy(*shard).agg((F.count("*") * F.col("size")).alias("held"))
        over = stage(counts.where((F.col("held") > capacity) & (F.col("hi") - F.col("lo") > 1)).select(*shard, F.lit(True).alias("over")), "spelling_over")
        if over.isEmpty():
            break
        met = parts.join(over, shard, "left")
        parted = met.where("over").withColumn("s", F.expr("explode(array(struct(lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 AS lo, hi)))"))
        parted = _keyed(parted.selectExpr("word", "n", "size", "int(s.lo) AS lo", "int(s.hi) AS hi"))
        parts = stage(met.where("over IS NULL").drop("over").unionByName(parted), "spelling_parts")
    # A length may hold a third of all words, so its rows meet its total under many salts.
    totals = parts.groupBy("size", "lo", "hi").agg(F.ceil(F.count("*") * F.col("size") / F.lit(capacity)).alias("buckets"))
    totals = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
    return salted.join(totals, ["size", "lo", "hi", "salt"]).select("word", "n", "size", "lo", "hi", F.pmod("key", "buckets").alias("bucket"))


def near_words(words: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(word, n_near, form, form_n): for words of ``words`` (word, n) that have any, how many near words, and the most frequent one."""

    def report(table: pa.Table) -> pa.Table:
        size, lo, hi = (table[c][0].as_py() for c in ("size", "lo", "hi"))
        order, a, b = near_of(table["word"].to_pylist(), size, lo, hi)
        word, n = table["word"].take(pa.array(order)), table["n"].to_numpy()[order]
        by = np.lexsort((b, -n[b], a))
        of, first, times = np.unique(a[by], return_index=True, return_counts=True)
        best = b[by][first]
        return pa.table({"word": word.take(pa.array(of)), "n_near": pa.array(times, pa.int64()), "less": pa.array(-n[best], pa.int64()), "form": word.take(pa.array(best))})

    found = sharded(words, capacity).groupBy("size", "lo", "hi", "bucket").applyInArrow(report, "word string, n_near long, less long, form string")
    best = F.min(F.struct("less", "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.form", (-F.col("b.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the chain of ``links`` (word, form) ends; each round doubles the steps taken."""
    at = stage(links.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        met = stage(met, "spelling_roots")
        if met.where("moved").isEmpty():
            return met.select("word", "root")
        at = met.select("word", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 5, capacity: int = CAPACITY, **of: int) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word; ``of``: see vocabulary."""
    words = stage(vocabulary(docs, id_col, text_col, **of), "spelling_words")
    known = words.join(near_words(words, capacity), "word", "left")
    known = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n"))), "spelling_forms")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
