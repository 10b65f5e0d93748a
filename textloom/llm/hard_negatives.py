"""Hard negatives by block matrix multiplication in two dimensions.

Every anchor is scored against every row, as a stated query set against the
whole table. Anchors and rows are dealt by hash into blocks of bounded size,
and each block is parted by dimensions into panels. As in SUMMA (van de Geijn
and Watts, 1997), an anchor panel goes to all blocks of rows and a row panel
to all blocks of anchors, while the tile of an anchor block and a row block
stays where it is: its task takes the panels by dimensions, multiplies two of
them and adds their int64 products up, and the tile's top k of each anchor is
what is left of it. So scores never travel, what travels is a panel for each
tile it is part of, in as few bytes as its components need, and a task holds
one tile and two panels, whatever the number of rows or dimensions.

First, anchors meet rows of their own label: labels are dealt into families,
and a family is parted into as many blocks as it needs, so a label with a
third of all rows is only more blocks. That gives the positives and with them
a window of scores for each. Then anchors meet all rows, and each window keeps
its best rows of another label.

Components become floor(scale * x), no more than 2**22 in size; larger ones
are taken as that. Sums are exact: a panel of 32 dimensions adds up below
2**53, and tiles are added as int64.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; a shorter vector counts as filled up with zeros; a
null id is last among ties, and a row with it can't be an anchor unless the
condition says so; rows with equal ids are different rows, and only the
anchor's own row is no positive of it; an anchor without a positive, and a
positive without a row in its window, give no row; very long vectors are more
panels; an empty table gives an empty result; other columns are ignored,
whatever their names. Labels that aren't whole numbers are told apart by 64
bits of their hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.tables import stage

#: Rows and anchors of a block, and dimensions of a panel; anchors of a tile that are looked at together.
ROWS, ANCHORS, WIDTH, STRIP = 4096, 1024, 32, 256
LARGEST = 1 << 22
#: Stands for a null id in the tasks, as it is last among ties.
NO_ID = (1 << 63) - 1
#: Less than any score.
LOW = -(1 << 63)
PANEL = "g long, block long, others long, d int, size int, panel binary, meta binary"
SEEN = "row long, slot int, anchor_id long, positive_id long, positive_score long, id long, score long"


def quantised(rows: DataFrame, id_col: str, label_col: str, vector_col: str, anchors: Column, scale: float) -> DataFrame:
    """(row, id, label, q, anchor) of the rows that take part; ``row`` tells equal ids apart."""
    finite = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    label = F.col(label_col).cast("long") if rows.schema[label_col].dataType.typeName() in ("byte", "short", "integer", "long") else F.xxhash64(label_col)
    part = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    part = part.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), whole.alias("q"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    return part.select(F.monotonically_increasing_id().alias("row"), "*")


def panels(rows: DataFrame, dims: int, width: int) -> DataFrame:
    """Panels of the blocks (g, block) of ``rows``, in order of id; the first one brings rows, ids, labels and windows along. ``size``: the bytes of a component."""

    def cut(table: pa.Table) -> pa.Table:
        ids = table["id"].fill_null(NO_ID).to_numpy()
        order = np.argsort(ids, kind="stable")
        q = np.zeros((len(ids), max(1, dims)), np.int32)
        for i, x in enumerate(table["q"].to_pylist()):
            q[i, : len(x)] = x
        q = q[order]
        told = [table["row"].to_numpy(), ids, table["label"].to_numpy()]
        if "window" in table.column_names:  # the positives' ids and scores
            for slots in zip(*table["window"].to_pylist(), strict=True):
                for field in ("id", "score", "some"):
                    told.append(np.array([s[field] if s[field] is not None else NO_ID for s in slots], np.int64))
        meta = np.stack([x[order] for x in told]).tobytes()
        parts = [q[:, s : s + width] for s in range(0, q.shape[1], width)]
        parts = [x.astype(np.min_scalar_type(min(int(x.min()), -1 - int(x.max()), -1))) for x in parts]
        n = len(parts)
        same = lambda name: pa.array([table[name][0].as_py()] * n, pa.int64())
        return pa.table({
            "g": same("g"), "block": same("block"), "others": same("others"), "d": pa.array(range(n), pa.int32()), "size": pa.array([x.itemsize for x in parts], pa.int32()),
            "panel": pa.array([x.tobytes() for x in parts], pa.binary()), "meta": pa.array([meta, *[None] * (n - 1)], pa.binary()),
        })

    return rows.groupBy("g", "block").applyInArrow(cut, PANEL)


def tiles(met: DataFrame, width: int, dims: int, keep: Callable[[np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """Rows of ``SEEN``: the products of the panels of each (g, i, j) added up by d, a strip of anchors after the other reduced by ``keep`` (scores, anchors' meta, rows' meta)."""

    def whole(total: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(total), STRIP):
            yield keep(total[s : s + STRIP], of_a[:, s : s + STRIP], of_b)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, panel, of_a, of_b = None, None, None, None, None
        for batch in batches:
            for r in range(batch.num_rows):
                *key, d, side, size = (batch.column(c)[r].as_py() for c in range(6))
                if key != at:
                    if total is not None:
                        yield from whole(total, of_a, of_b)
                    at, total, panel = key, None, None
                if side and panel is None:
                    continue  # a block without anchors
                w = min(width, max(1, dims) - width * d)
                x = np.frombuffer(batch.column(6)[r].as_py(), f"i{size}").reshape(-1, w).astype(np.float64)
                if d == 0:  # the first panels bring the rows along
                    meta = np.frombuffer(batch.column(7)[r].as_py(), np.int64).reshape(-1, len(x))
                    of_a, of_b = (of_a, meta) if side else (meta, of_b)
                if not side:
                    panel = x
                    continue
                if total is None:
                    total = np.zeros((len(panel), len(x)), np.int64)
                for s in range(0, len(panel), STRIP):
                    total[s : s + STRIP] += (panel[s : s + STRIP] @ x.T).astype(np.int64)
        if total is not None:
            yield from whole(total, of_a, of_b)

    return met.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "d", "side").mapInArrow(add, SEEN)


def _top(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest allowed scores of each row; the first column on ties."""
    left = np.where(allowed, scores, LOW)
    rows, columns, every = [], [], np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        best = left.argmax(1)
        there = every[left[every, best] != LOW]
        if not len(there):
            break
        rows.append(there)
        columns.append(best[there])
        left[there, best[there]] = LOW
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, columns))


def _seen(a: np.ndarray, ids: np.ndarray, score: np.ndarray, slot: int, positive: tuple | None = None) -> pa.RecordBatch:
    """Rows of ``SEEN``; ``a``: columns of the anchors' meta."""
    null = lambda x: pa.array(x, pa.int64(), mask=x == NO_ID)
    none = pa.nulls(len(ids), pa.int64())
    columns = [pa.array(a[0]), pa.array(np.full(len(ids), slot, np.int32)), null(a[1]), null(positive[0]) if positive else none, pa.array(positive[1]) if positive else none, null(ids), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, ["row", "slot", "anchor_id", "positive_id", "positive_score", "id", "score"])


def scored(anchors: DataFrame, rows: DataFrame, dims: int, width: int, keep: Callable) -> DataFrame:
    """Rows of ``SEEN`` for the blocks of ``anchors`` and ``rows``, each (row, id, label, q, g, block, others): ``others`` are the blocks on the other side of g."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    to = lambda df, own, other, side: panels(df, dims, width).select("g", F.col("block").alias(own), every.alias(other), "d", F.lit(side).alias("side"), "size", "panel", "meta")
    met = to(anchors, "i", "j", 0).unionByName(to(rows, "j", "i", 1))
    return tiles(met.select("g", "i", "j", "d", "side", "size", "panel", "meta"), width, dims, keep)


def _first(seen: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group with their rank; Spark limits each task's rows before they are shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return seen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 3,
    least: Fraction = Fraction(50, 100), most: Fraction = Fraction(95, 100), scale: float = 256, n_rows: int = ROWS, n_anchors: int = ANCHORS, width: int = WIDTH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its best other rows of the same label; for each,
    the negatives are the best rows of another label with scores from ``least``
    to ``most`` times the positive's.
    """
    all_rows = stage(quantised(rows, id_col, label_col, vector_col, anchors, scale), "negatives_rows")
    total, n_asked, dims = all_rows.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    dealt = lambda n: F.pmod(F.xxhash64("row"), n)
    blocks = lambda n, size: F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("long")

    # Families of labels: each of about a block of rows, or one label's and as many blocks as it fills.
    family = all_rows.withColumn("g", F.pmod(F.xxhash64("label"), F.lit(max(1, total // n_rows))))
    own = F.count(F.when(F.col("anchor"), 1))
    sizes = family.groupBy("g").agg(blocks(F.count("*"), n_rows).alias("nj"), blocks(own, n_anchors).alias("ni"), (own > 0).alias("some"))
    # A row a family, of which there are no more than blocks; those without an anchor meet none.
    family = family.join(F.broadcast(sizes.where("some")), "g")
    row = ["row", "id", "label", "q", "g"]
    asked = family.where("anchor").select(*row, dealt(F.col("ni")).alias("block"), F.col("nj").alias("others"))
    other = family.select(*row, dealt(F.col("nj")).alias("block"), F.col("ni").alias("others"))

    def same_label(tile: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        i, j = _top(tile, (a[2][:, None] == b[2]) & (a[0][:, None] != b[0]), positives)
        return _seen(a[:, i], b[1][j], tile[i, j], 0)

    near = _first(scored(asked, other, dims, width, same_label), ["row"], positives)
    near = stage(near.select("row", "rank", "id", "score"), "negatives_positives")
    slot = F.struct("rank", "id", "score", F.lit(1).cast("long").alias("some"))
    none = F.struct(F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("some"))
    windows = near.groupBy("row").agg(F.array_sort(F.collect_list(slot)).alias("w"))
    windows = windows.select("row", F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: F.coalesce(F.get("w", k - 1), none)).alias("window"))

    ni, nj = max(1, -(-n_asked // n_anchors)), max(1, -(-total // n_rows))
    zero = F.lit(0).cast("long").alias("g")
    asked = all_rows.where("anchor").join(windows, "row").select(*row[:4], "window", zero, dealt(F.lit(ni)).alias("block"), F.lit(nj).cast("long").alias("others"))
    other = all_rows.select(*row[:4], zero, dealt(F.lit(nj)).alias("block"), F.lit(ni).cast("long").alias("others"))
    (p, q), (r, s) = least.as_integer_ratio(), most.as_integer_ratio()

    def in_windows(tile: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        left, out = np.where(a[2][:, None] != b[2], tile, LOW), []
        for k in range(positives):
            of, score, some = a[3 + 3 * k : 6 + 3 * k]
            # The best ones below the window's top; those below its bottom go.
            i, j = _top(left, left <= (r * score // s)[:, None], negatives)
            fits = (some[i] == 1) & (tile[i, j] >= -(-p * score // q)[i])
            i, j = i[fits], j[fits]
            out.append(_seen(a[:, i], b[1][j], tile[i, j], k, (of[i], score[i])))
        return pa.Table.from_batches(out).combine_chunks().to_batches(1 << 30)[0] if any(x.num_rows for x in out) else out[0]

    found = _first(scored(asked, other, dims, width, in_windows), ["row", "slot"], negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
