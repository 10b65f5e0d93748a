"""Jaccard self-join of shingle sets by prefix filters under several global orders.

If two sets of sizes m and n have a Jaccard similarity of at least t, they
share a token among the first n - ceil(t * n) + 1 of either, in *any* global
order of tokens. Here every pair must pass that filter under several orders at
once. Order i puts first the tokens of slice i of the hash space, the rarest
first; slices are disjoint, so the filters are close to independent, and a
document sends only a fraction of its tokens for an order. Then come other tokens by hash, and last those that a
large share of all documents hold. Tokens that one document holds can't be
shared and end their journey where they are counted; a set whose prefix has no
other token can't be linked and leaves the join. The orders are taken in turn,
so only the first one counts tokens of all sets: most sets are gone after it,
and the later orders look at the sets that are left.

Equal sets are one class and enter the join once. Candidates are verified in
two steps, so that a large group of near copies doesn't make a pair of every
two: first each class is compared with the leaders of its tokens, where the
leader of a token's classes is the one with the least of four hashes, which
the token picks, so that a large group has few of them; then only pairs from
different components are left, and of each token's classes those outside its largest
component are compared with the rest. Both steps intersect the filters of all
orders before any set is fetched, and every pair that passes is verified
exactly.

Small sets (fewer than ``small`` tokens) use the whole hash space as slice of
every order; sets near the limit take part in both regimes, as a pair needs
one that both sides use.

Before a pair is made at all, its sizes and its parity maps must allow a link:
every token flips one of 512 bits, and maps never differ in more bits than the
sets in tokens, so this drops no link. In a group of texts that are alike but
not alike enough, it is what keeps the pairs few; each pair is still looked
at once per shared token of the first order, inside the join.

Defined results: a null, empty or blank text has an empty set, which is linked
with nothing; a text with fewer words than a shingle has one shingle of all of
them; repeated rows and equal sets are one class; rows with a null id are
documents too; a text of any length is cut into shingles piece by piece; an
empty table gives an empty result; columns other than id and text are ignored,
whatever their names. Tokens are 64-bit hashes of shingles, and a class is
named by 64 bits of its set: among ten billion classes, about three pairs may
be expected to share a name by chance, and would then count as equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from textloom.llm.components import components
from textloom.llm.hashing import grouped, many_word_hashes, mixed, signed
from textloom.llm.words import fresh
from textloom.tables import stage

#: A token is common if it makes up this share of the rows of a task or of all; at most its inverse times a document's mean size are.
COMMON_SHARE = 0.002
#: At most so many common tokens are sent to all tasks (8 bytes each); the order of the rest is by hash alone, which is as right.
MOST_COMMON = 500_000


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the distinct hashes of its shingles, sorted. Only a few texts are held at a time."""
    for i in range(0, len(column), 128):
        yield from _shingle_sets([(t or "").encode("utf-8", "surrogatepass") for t in column.slice(i, 128).to_pylist()], size)


def _shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    for start, end in grouped(texts):
        w, ends = many_word_hashes(texts[start:end], lower=True)
        n_runs = max(0, len(w) - size + 1)
        runs = np.full(n_runs, np.uint64(size))
        for j in range(size):
            runs = mixed(runs ^ w[j : j + n_runs])
        at = 0
        for to in ends.tolist():
            n = to - at
            if n >= size:
                yield np.unique(runs[at : to - size + 1])
            elif n:
                one = np.full(1, np.uint64(n))
                for x in w[at:to]:
                    one = mixed(one ^ x)
                yield one
            else:
                yield w[:0]
            at = to


def set_key(tokens: np.ndarray) -> int:
    """One number for a whole set: two sums of differently mixed tokens, folded."""
    a, b = mixed(tokens).sum(dtype=np.uint64), mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(signed(mixed(np.array([a ^ (b << np.uint64(1)) ^ np.uint64(len(tokens))], np.uint64)))[0])


def prefix_size(n: int, per_cent: int) -> int:
    """How many first tokens of a set of ``n`` have to be looked at."""
    return n - -(-per_cent * n // 100) + 1


class Order:
    """Which tokens of a set go first under order ``i``.

    A token's slice follows from its own bits; its last bit tells the regime.
    """

    def __init__(self, i: int, per_cent: int, orders: int, common: np.ndarray, small: int = 128) -> None:
        self.i, self.per_cent, self.common = i, per_cent, common
        self.start, self.end = slice_of(i, per_cent, orders)
        #: Sets of up to ``upto`` tokens are in the small regime, from ``small`` on in the other.
        self.small, self.upto = small, -(-100 * small // per_cent)

    def __call__(self, tokens: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each regime of a set: (regime, prefix size, tokens in the slice, tokens that fill up the prefix)."""
        n = len(tokens)
        p = prefix_size(n, self.per_cent)
        usual = ~np.isin(tokens, self.common, assume_unique=True) if len(self.common) else np.ones(n, bool)
        for small in (1, 0):
            if n > self.upto if small else n < self.small:
                continue
            names = tokens & ~np.uint64(1) | np.uint64(small)
            place = names >> np.uint64(1)
            inside = usual if small else usual & (place >= self.start) & (place < self.end)
            fill = names[:0]
            if (size := int(inside.sum())) < p:  # then by hash, the common ones last
                rest = np.flatnonzero(~inside)
                rank = mixed(names[rest] + np.uint64(self.i))
                fill = names[rest[np.lexsort((rank, ~usual[rest]))][: p - size]]
            yield small, p, names[inside], fill


def slice_of(i: int, per_cent: int, orders: int) -> tuple[int, int]:
    """Where slice ``i`` of the 63-bit hash space starts and ends.

    A set is gone if it alone holds as many tokens of a slice as its prefix
    has. The first slice is half as wide again as a prefix, so a set stays only
    if a third of its tokens there are shared; the others share what is left of
    the space.
    """
    first = 2**63 if orders == 1 else int(2**63 * min(0.5, 1.5 * (1 - per_cent / 100)))
    width = (2**63 - first) // max(1, orders - 1)
    return (0, first) if i == 0 else (first + (i - 1) * width, first + i * width)


def describe(docs: DataFrame, size: int) -> DataFrame:
    """(id, mark, key, n, common) of ``docs`` (id, text, mark): each document's set key and size, and for each task (null, null, token, times, true) of its common tokens."""
    id_type = docs.schema["id"].dataType
    arrow_type = to_arrow_type(id_type)
    names = ["id", "mark", "key", "n", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens_seen, times_seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        new: list[np.ndarray] = []
        held = 0

        def count() -> None:
            """Adds the new sets to the counts, and forgets what is far from common where the counts get many."""
            nonlocal tokens_seen, times_seen, held
            if new:
                found, times = np.unique(np.concatenate(new), return_counts=True)
                both, at = np.unique(np.concatenate((tokens_seen, found)), return_inverse=True)
                sums = np.bincount(at, np.concatenate((times_seen, times)), len(both)).astype(np.int64)
                stay = sums >= (max(2, COMMON_SHARE * len(seen) / 4) if len(both) > 100_000 else 1)
                tokens_seen, times_seen = both[stay], sums[stay]
            new.clear()
            held = 0

        for batch in batches:
            keys, sizes = [], []
            for tokens in shingle_sets(batch.column(1), size):
                key = set_key(tokens) if len(tokens) else None
                keys.append(key)
                sizes.append(len(tokens))
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append(tokens)
                    held += len(tokens)
                    if held > 200_000:
                        count()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array([False] * len(keys))], names)
        count()
        often = times_seen >= max(32, COMMON_SHARE * len(seen))
        n = int(often.sum())
        yield pa.RecordBatch.from_arrays([pa.nulls(n, arrow_type), pa.nulls(n, pa.int64()), pa.array(signed(tokens_seen[often])), pa.array(times_seen[often]), pa.array([True] * n, pa.bool_())], names)

    return docs.select("id", "text", "mark").mapInArrow(run, f"id {id_type.simpleString()}, mark long, key long, n long, common boolean")


#: In ``kind``: 0 for a token of the slice, 1 for one that fills up a prefix; above this regime, prefix size and number of tokens sent.
HEAD = 1 << 60


def sent_tokens(rows: DataFrame, sets_of: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]], i: int, per_cent: int, orders: int, common: np.ndarray) -> DataFrame:
    """(token, key, kind) for each set that ``sets_of`` reads from ``rows``: its tokens in slice ``i``, what fills up its prefix, and a head, which lies at a place of its own."""
    shared = rows.sparkSession.sparkContext.broadcast(common)  # at most MOST_COMMON

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(i, per_cent, orders, shared.value)
        parts: list[tuple[np.ndarray, int, int]] = []
        held = 0

        def made() -> pa.RecordBatch:
            sizes = [len(x[0]) for x in parts]
            key, kind = (np.repeat(np.array([x[k] for x in parts], np.int64), sizes) for k in (1, 2))
            token = signed(np.concatenate([x[0] for x in parts]))
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(token), pa.array(key), pa.array(kind)], ["token", "key", "kind"])

        for key, tokens in sets_of(batches):
            own = np.array([key & (2**64 - 1)], np.uint64)
            for small, p, inside, fill in order(tokens):
                parts += [(mixed(own + np.uint64(small)), key, HEAD | small << 58 | p << 29 | (len(inside) + len(fill))), (inside, key, 0), (fill, key, 1)]
                held += len(inside) + len(fill)
            if held > 50_000:
                yield made()
                held = 0
        if parts:
            yield made()

    return rows.mapInArrow(run, "token long, key long, kind long")


def read_texts(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]]:
    """Each distinct set of a task, from a column of texts."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        seen: set[int] = set()
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), size):
                if len(tokens) and (key := set_key(tokens)) not in seen:
                    seen.add(key)
                    yield key, tokens

    return sets_of


def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Sets from the columns key and tokens."""
    for batch in batches:
        for key, tokens in zip(batch.column(0), batch.column(1), strict=True):
            yield key.as_py(), tokens.values.to_numpy().view(np.uint64)


def prefixes_of(sent: DataFrame, i: int) -> DataFrame:
    """(key, regime, prefix): the prefix tokens under order ``i`` that other sets have sent too; sets without one are gone."""
    # No token of a slice is common, so the rows of one token are few; they may be counted where they meet.
    met = Window.partitionBy("token")
    sent = sent.withColumns({"lo": F.min("key").over(met), "hi": F.max("key").over(met), "times": F.count("*").over(met)})
    head, fill = F.col("kind") >= HEAD, F.col("kind") == 1
    sent = sent.where(head | (F.col("lo") < F.col("hi")))
    regime = F.when(head, F.shiftright("kind", 58)).otherwise(F.col("token")).bitwiseAND(1)
    token = F.struct(F.col("kind").alias("fill"), F.when(fill, 0).otherwise(F.col("times")).alias("times"), F.xxhash64("token", F.lit(i)).alias("rank"), "token")
    held = sent.groupBy("key", regime.alias("regime")).agg(F.max(F.when(head, F.col("kind"))).alias("head"), F.collect_set(F.when(~head, token)).alias("shared"))
    # Tokens that no other set has come first and need not be known.
    p, n = F.shiftright("head", 29).bitwiseAND((1 << 29) - 1), F.col("head").bitwiseAND((1 << 29) - 1)
    left = (p - (n - F.size("shared"))).cast("int")
    held = held.where((left > 0) & (F.size("shared") > 0))
    return held.select("key", "regime", F.slice(F.sort_array("shared"), F.lit(1), left)["token"].alias("prefix"))


#: Bits of a set's parity map, in longs of 64.
MAP_LONGS = 8


def parity_map(tokens: np.ndarray) -> np.ndarray:
    """Each token flips a bit. Two maps differ in at most as many bits as the sets in tokens."""
    flips = np.bincount((mixed(tokens) >> np.uint64(64 - (64 * MAP_LONGS).bit_length() + 1)).astype(np.int64), minlength=64 * MAP_LONGS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def token_sets(docs: DataFrame, size: int) -> DataFrame:
    """(key, n, tokens, map) of ``docs`` (key, text) whose set has that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                made = [(k, x) for k, x in zip(part.column(0).to_pylist(), shingle_sets(part.column(1), size), strict=True) if len(x) and set_key(x) == k]
                if made:
                    offsets = np.concatenate(([0], np.cumsum([len(x) for _, x in made]))).astype(np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(np.concatenate([x for _, x in made]))))
                    maps = pa.array([parity_map(x).tolist() for _, x in made], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.int64()), pa.array([len(x) for _, x in made], pa.int64()), tokens, maps], ["key", "n", "tokens", "map"])

    return docs.select("key", "text").mapInArrow(run, "key long, n long, tokens array<long>, map array<long>")


def differing(a: str, b: str) -> Column:
    """Bits in which two parity maps differ."""
    out = F.lit(0)
    for i in range(MAP_LONGS):
        out = out + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return out


def near(per_cent: int, na: str, nb: str, ma: str, mb: str) -> Column:
    """What every link fulfils: sizes near enough, and maps that differ in no more bits than linked sets in tokens."""
    sizes = F.lit(100) * F.least(na, nb) >= F.lit(per_cent) * F.greatest(na, nb)
    return sizes & (F.lit(100 + per_cent) * differing(ma, mb) <= F.lit(100 - per_cent) * (F.col(na) + F.col(nb)))


def passing(pairs: DataFrame, held: DataFrame, orders: int) -> DataFrame:
    """The pairs (a, b) that share a prefix token under every order of a regime."""
    left = held.select(F.col("key").alias("a"), "regime", F.col("prefixes").alias("pa"))
    right = held.select(F.col("key").alias("b"), "regime", F.col("prefixes").alias("pb"))
    met = pairs.select("a", "b").distinct().join(left, "a").join(right, ["b", "regime"])
    for i in range(orders):
        met = met.where(F.arrays_overlap(F.col("pa")[i], F.col("pb")[i]))
    return met.select("a", "b").distinct()


#: Pairs up to this number are sent to the tasks that hold the sets (16 bytes each); more are shuffled.
MOST_PAIRS = 500_000


def verified(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs that are links, by their whole sets."""
    pairs = stage(pairs.select("a", "b"), "ngram_pairs")
    sent = F.broadcast if pairs.count() <= MOST_PAIRS else lambda x: x
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta")).join(sent(pairs), "a")
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb")).join(sent(pairs.select("b").distinct()), "b", "left_semi")
    met = left.join(right, "b").select("a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("both"), (F.size("ta") + F.size("tb")).cast("long").alias("sum"))
    return met.where(F.lit(100) * F.col("both") >= F.lit(per_cent) * (F.col("sum") - F.col("both"))).select("a", "b")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, per_cent: int = 80, orders: int = 2) -> DataFrame:
    """(id, n_shingles, set_key, component_id, mark) of every document; mark tells the texts of one id apart.

    Documents are linked if 100 * shared >= per_cent * union of their sets of
    ``size``-word shingles. component_id is the least id reachable by links.
    """
    # Marks tell rows with one id apart, where the text of a class is looked up.
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    found = stage(describe(docs, size), "ngram_sets")
    rows = found.where("not common").drop("common")
    often = found.where("common").groupBy("key").agg(F.sum("n").alias("n"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("least")
    classes = stage(rows.where("key is not null").groupBy("key").agg(least, F.max("n").alias("n")).select("key", "n", F.col("least.id").alias("least_id"), F.col("least.mark").alias("mark")), "ngram_classes")
    often = often.where(F.col("n") >= COMMON_SHARE * classes.count()).orderBy(F.desc("n"), "key").limit(MOST_COMMON)
    common = np.array([r[0] for r in often.select("key").collect()], np.int64).view(np.uint64)

    # The first order looks at all sets, each of the others at those that the orders before it have left.
    held = stage(prefixes_of(sent_tokens(docs.select("text"), read_texts(size), 0, per_cent, orders, common), 0), "ngram_prefix")
    ids = stage(held.select("key").distinct().join(classes, "key").select("key", F.col("least_id").alias("asked"), F.col("mark").alias("asked_mark")), "ngram_asked")
    n_left = ids.count()
    sent = F.broadcast if n_left <= MOST_PAIRS else lambda x: x
    texts = docs.join(sent(ids), F.col("id").eqNullSafe(F.col("asked")) & (F.col("mark") == F.col("asked_mark")))
    sets = stage(token_sets(texts, size), "ngram_tokens")
    if sets.count() > n_left:  # equal rows, id and text
        sets = stage(sets.dropDuplicates(["key"]), "ngram_tokens")
    prefixes = held.select("key", "regime", F.array("prefix").alias("prefixes"))
    for i in range(1, orders):
        held = prefixes_of(sent_tokens(sets.select("key", "tokens"), read_sets, i, per_cent, orders, common), i)
        prefixes = stage(prefixes.join(held, ["key", "regime"]).select("key", "regime", F.array_append("prefixes", F.col("prefix")).alias("prefixes")), "ngram_prefixes")
    marks = sets.select("key", "n", "map")

    # First each class against the leaders of its tokens. Pairs come from the first order; the others are held against them.
    by = ["regime", "token"]
    first = prefixes.select("key", "regime", F.explode(F.col("prefixes")[0]).alias("token"))
    leaders = first.groupBy(*by).agg(F.min_by("key", F.xxhash64("key", F.col("token").bitwiseAND(6))).alias("leader"), F.count("*").alias("members")).where("members > 1").drop("members")
    first = stage(first.join(stage(leaders, "ngram_leaders"), by), "ngram_first")
    pairs = first.select(F.col("key").alias("a"), F.col("leader").alias("b")).where("a <> b").distinct()
    of = lambda k: marks.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("map").alias(f"m{k}"))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b").where(near(per_cent, "na", "nb", "ma", "mb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stage(verified(passing(pairs, prefixes, orders), sets, per_cent), "ngram_links")
    grouped = stage(components(links), "ngram_groups").select(F.col("node").alias("key"), "component")

    # Then all other pairs that span two components: of each token's classes, those outside its largest component against the rest.
    member = stage(first.drop("leader").join(grouped, "key", "left").withColumn("component", F.coalesce("component", "key")), "ngram_members")
    parts = member.groupBy(*by, "component").agg(F.count("*").alias("n"))
    major = parts.groupBy(*by).agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.count("*").alias("parts")).where("parts > 1").select(*by, "major")
    spanning = stage(member.join(stage(major, "ngram_major"), by).join(marks, "key"), "ngram_spanning")
    x = spanning.where("component <> major").select(*by, F.col("key").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("map").alias("mx"))
    y = spanning.select(*by, F.col("key").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("map").alias("my"))
    apart = (x["regime"] == y["regime"]) & (x["token"] == y["token"]) & (F.col("cx") != F.col("cy")) & near(per_cent, "nx", "ny", "mx", "my")
    pairs = x.join(y, apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    more = stage(verified(passing(pairs, prefixes, orders), sets, per_cent), "ngram_links")

    joined = components(links.unionByName(more))
    named = classes.join(joined, classes["key"] == joined["node"], "left").select("key", "least_id", F.coalesce("component", "key").alias("component"))
    named = stage(named, "ngram_named")
    least_ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(least_ids, "component").select("key", "component_id")
    out = rows.join(of_class, "key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("key").alias("set_key"), F.coalesce("component_id", "id").alias("component_id"), "mark")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Of each group of linked documents the one with the least id, with all its columns; documents without words stay. Rows of that id whose texts are in the group stay together."""
    joined = ngram_join(docs, id_col, text_col, **params)
    kept_id, kept_mark = fresh(docs, "kept_id", "kept_mark")
    keep = joined.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(kept_id), F.col("mark").alias(kept_mark)).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep[kept_id]) & (F.xxhash64(docs[text_col]) == keep[kept_mark]), "left_semi")
