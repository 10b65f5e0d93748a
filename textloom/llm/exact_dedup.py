"""Exact deduplication by an extendible-hash index on shared files.

The index has a *directory* and *buckets*. A document's key is a 64-bit hash
of its normalised text; the directory maps the leading bits of a key, its
cell, to a bucket. A bucket with more than ``capacity`` distinct keys is split
by one more bit, as often as needed, and the directory doubles whenever a
bucket needs more bits than it has, so a shallow bucket stands in several
cells. Building and looking up both go from cell to bucket. Every bucket is a
key range of one owner, and the task of the owner writes its ranges, in order,
to the shared folder. Within a key, entries are chained by their bytes: two
texts share an entry only if they are identical, so a hash collision costs a
chain link and never a wrong match.

Everything is DataFrame operations. Copies collapse in the map-side
aggregation before any shuffle, so a text with a third of all rows leaves each
task as one row.

Defined results: a null text counts as empty, however long texts are compared
whole; rows with a null id are documents, and the row that stays of a group
has a null id only if all have; repeated rows (same id and text) are rows of
one group and each is returned; if two rows tie for the largest id, both carry
it and both are kept; other columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import fresh, lower_ascii
from textloom.tables import stage


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def prefix(key: Column, bits: int) -> Column:
    """The leading ``bits`` of an unsigned 64-bit key."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """The directory of an extendible-hash index over ``keys`` (a column ``key`` of distinct keys).

    Returns (cell, bucket, local_depth, global_depth) for every cell that a
    bucket with keys stands in; ``bucket`` is its first cell. It starts with
    one bucket for about ``capacity`` keys each; then the overfull ones, and
    only their keys, are split by a bit until none is left.
    """
    keys = stage(keys.select("key"), "exact_keys")
    depth = max(0, (keys.count() // capacity).bit_length() - 1)
    level = keys.groupBy(prefix(F.col("key"), depth).alias("bits")).agg(F.count("*").alias("n"))
    settled = None
    while True:
        level = stage(level.select("bits", "n", F.lit(depth).alias("depth")), "exact_level")
        settled = level.where(F.col("n") <= capacity) if settled is None else settled.unionByName(level.where(F.col("n") <= capacity))
        full = level.where(F.col("n") > capacity).select(F.col("bits").alias("full"))
        if full.isEmpty():
            break
        again = keys.join(full, prefix(F.col("key"), depth) == F.col("full"), "left_semi")
        depth += 1
        level = again.groupBy(prefix(F.col("key"), depth).alias("bits")).agg(F.count("*").alias("n"))
    times = F.expr(f"shiftleft(1L, {depth} - depth)")  # cells that a bucket stands in
    cells = settled.select((F.col("bits") * times).alias("bucket"), F.col("depth").alias("local_depth"), times.alias("times"))
    cells = cells.withColumn("cell", F.explode(F.expr("sequence(bucket, bucket + times - 1)")))
    return cells.select("cell", "bucket", "local_depth", F.lit(depth).alias("global_depth"))


def key_of(text: Column, key_bits: int) -> Column:
    key = F.xxhash64(text)
    return key if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)


#: A directory of up to so many cells (16 bytes each) is sent to all tasks; a larger one is joined with.
MOST_CELLS = 1_000_000
OWNERS = 1024


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, key_bits: int = 64) -> DataFrame:
    """Groups of equal documents: (id, keep_id, group_size, kept, text_sha256) for every row.

    ``capacity`` is the number of distinct keys that a bucket may hold, by
    default one that makes at most some 100,000 buckets. ``key_bits`` below 64
    shortens the keys, which makes collisions certain; it serves to test the
    chains.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("bytes"))
    rows = rows.select("id", "bytes", F.sha2(F.col("bytes"), 256).alias("sha"), key_of(F.col("bytes"), key_bits).alias("key"))
    digests = stage(rows.select("id", "key", "sha"), "exact_digests")

    cells = stage(directory(digests.select("key").distinct(), capacity or max(512, digests.count() // 100_000)), "exact_directory")
    depth = cells.agg(F.max("global_depth")).first()[0] or 0
    sent = F.broadcast if cells.count() <= MOST_CELLS else lambda x: x
    bucket_of = lambda df: df.withColumn("cell", prefix(F.col("key"), depth)).join(sent(cells.select("cell", "bucket")), "cell").drop("cell")
    # One entry for each distinct text of a key, found by comparing bytes: the chain of the key.
    entries = bucket_of(rows).groupBy("bucket", "key", "sha", "bytes").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    index = entries.select("bucket", "key", "sha", "keep_id", "group_size")
    owner = F.floor(F.col("bucket") * OWNERS / F.lit(2.0**depth))
    index = stage(index.repartition(owner).sortWithinPartitions("bucket", "key", "sha"), "exact_index")

    # Two entries with one key and one digest hold different texts; only then do the bytes have to be joined again.
    clash = index.groupBy("bucket", "key", "sha").agg(F.count("*").alias("n")).where("n > 1")
    if clash.isEmpty():
        found = bucket_of(digests).join(index, ["bucket", "key", "sha"])
    else:
        found = bucket_of(rows).join(entries, ["bucket", "key", "sha", "bytes"])
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None) -> DataFrame:
    """The documents that stay, with all their columns. Rows are told by id and text, so an id may occur with several texts."""
    keep = exact_groups(docs, id_col, text_col, capacity).where("kept")
    kept_id, kept_sha = fresh(docs, "kept_id", "kept_sha")
    keep = keep.select(F.col(id_col).alias(kept_id), F.col("text_sha256").alias(kept_sha)).distinct()
    sha = F.sha2(normalised(docs[text_col]), 256)
    return docs.join(keep, docs[id_col].eqNullSafe(keep[kept_id]) & (sha == keep[kept_sha]), "left_semi")
