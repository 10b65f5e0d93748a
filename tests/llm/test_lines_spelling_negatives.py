"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import regex
from conftest import DATA
from pyspark.sql import functions as F

from textloom.llm import hard_negatives, line_dedup, spelling
from textloom.llm.queries import QUERIES

# Lines


def without_common(rows, threshold, shortest=1):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    n = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")} if len(k) >= shortest)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if n[key(x)] < threshold or len(key(x)) < shortest]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows(seed, n):
    r = random.Random(seed)
    odd = [(None, None), (None, "a\nA "), (7, ""), (7, ""), (8, "\n\n"), (9, "x" * 200_000 + "\nshared"), (10, "\n".join(f"l{i % 300}" for i in range(3000))), (11, "É\né\n\t Shared\x0b"), (12, "a\nb"), (12, "a\nb")]
    return odd + [(100 + i, "\n".join(r.choice("abcdefghijklmnop") * r.randint(0, 3) + r.choice(["", " ", "\t"]) for _ in range(r.randint(1, 9)))) for i in range(n)]


@pytest.mark.parametrize("n_batches, fan, shortest", [(1, 4, 1), (5, 2, 1), (7, 3, 2)])
def test_common_lines_go(spark, n_batches, fan, shortest):
    rows = line_rows(n_batches, 60)
    schema = "doc_id long, text string, h1 string, m1 int, n_lines double"
    batches = [spark.createDataFrame([(*r, "clash", 1, 0.5) for r in rows[i::n_batches]], schema) for i in range(n_batches)]
    got = line_dedup.drop_common_lines(batches, threshold=6, shortest=shortest, fan=fan)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == without_common(rows, 6, shortest)


def test_runs_settle_when_compacted(spark):
    store = line_dedup.LineRuns(spark, threshold=4, fan=2)
    rows = lambda keys: spark.createDataFrame([(k, -k) for k in keys], "h1 long, h2 long")
    for keys in ([1, 1, 2], [1, 1, 2], [1, 3], [2, 3]):
        store.add(rows(keys))
    assert [len(level) for level in store.levels] == [0, 0, 1] and store.common
    assert {r["h1"]: r["n"] for r in spark.table(store.levels[2][0]).collect()} == {2: 3, 3: 2}  # 1 was settled, and not counted again
    assert [(r["h1"], r["h2"]) for r in spark.table(store.common).collect()] == [(1, -1)]
    store.add(rows([1, 2]))
    assert sorted(r["h1"] for r in store.frequent().collect()) == [1, 2]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_merge_without_a_shuffle(spark):
    store = line_dedup.LineRuns(spark, threshold=4)
    for k in range(2):
        store.add(spark.range(500).select(F.col("id").alias("h1"), (F.col("id") * (k + 3)).alias("h2")))
    a, b = (spark.table(name) for name in store.levels[0])
    plan = a.join(b.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    store.frequent()


def test_no_lines(spark):
    assert line_dedup.drop_common_lines([spark.createDataFrame([], "doc_id long, text string")]).count() == 0


def test_line_query_whole(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in without_common(rows, 10)]
    got = sorted(tuple(r) for r in QUERIES["op11_line_dedup"](spark, DATA).collect())
    assert got == sorted(want)
    assert sum(r[2] for r in got) > 0


# Spelling


def brute_variants(rows, shortest=6, at_least=5, every=199, ratio=5):
    counts = Counter()
    for i, text in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= at_least}
    holes = defaultdict(set)  # words that are the same but for one place, or for one place less
    for w in n:
        holes[w].add(w)
        for p in range(len(w)):
            holes[w[:p] + w[p + 1 :]].add(w)
            holes[w[:p], w[p + 1 :]].add(w)
    near = defaultdict(set)
    for k, group in holes.items():
        for w in group:
            near[w] |= {v for v in group if v != w and (isinstance(k, tuple) or k in (v, w))}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        end = w
        while end in form:
            end = form[end]
        out.append((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, end))
    return sorted(out)


def spelt(df):
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(r) for r in df.collect())


def made_texts(seed):
    """Words over few letters, so that near ones are many, with hubs, chains and repeated letters."""
    r = random.Random(seed)
    words = ["".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(300)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "wordwordx" * 40, "wordwordx" * 40 + "y", "×÷×÷×÷", "ÀÀÀÀÀÀ", "àÀÀÀÀÀ"]
    texts = [(None, None), (1, ""), (1, "abc 1 _"), (2, "日本 " + "Maßstäbe," * 30), (2, "Maßstabe " * 5)]
    texts += [(3, "chainaa " * 5), (4, "chainab " * 30), (5, "chainbb " * 200), (6, "chainbc " * 1001)]
    for i in range(120):
        some = [w for w in r.choices(words, k=60) for _ in range(r.choice([1, 1, 1, 6]))]
        texts.append((r.choice([None, 7, 10 + i]), r.choice([" ", "\n", "-", "λ"]).join(some)))
    return texts


@pytest.mark.parametrize("capacity, every", [(500_000, 0), (300, 3), (40, 199)])
def test_variants_by_brute_force(spark, capacity, every):
    rows = made_texts(capacity)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("size", F.lit("clash"))
    got = spelt(spelling.group_variants(d, capacity=capacity, every=every))
    assert got == brute_variants(rows, every=every)
    assert any(r[3] for r in got) and (every == 3 or any(r[3] and r[5] != r[3] for r in got))


def test_shards_are_bounded_and_hold_each_pair_once(spark):
    words = spark.range(4000).select(F.concat(F.lit("samestart"), F.lpad(F.conv("id", 10, 16), 4, "0")).alias("word"), F.lit(1).cast("long").alias("n"))
    sizes = [r["count"] for r in spelling.sharded(words, 2000).groupBy("size", "lo", "hi", "bucket").count().collect()]
    assert max(sizes) * 13 <= 3 * 2000
    got = {r["word"]: r["n_near"] for r in spelling.near_words(words, 2000).collect()}
    near = lambda i: sum(1 for p in (1, 16, 256, 4096) for x in range(16) if x != i // p % 16 and i + (x - i // p % 16) * p < 4000)
    assert got == {f"samestart{i:04X}": near(i) for i in range(4000)}


def test_wavelet_tree_reports_ranges():
    values = np.random.default_rng(1).permutation(37)
    tree = spelling.WaveletTree(values)
    boxes = np.random.default_rng(2).integers(0, 38, (200, 4))
    query, value = tree.report(*boxes.T)
    want = {(i, v) for i, (s, e, lo, hi) in enumerate(boxes) for v in values[s:e] if lo <= v < hi}
    assert set(zip(query.tolist(), value.tolist(), strict=True)) == want and len(query) == len(want)


def test_long_texts_are_read_whole(spark, monkeypatch):
    rows = [(1, "tokens, " * 5000 + "longword" * 40)]
    whole = brute_variants(rows, at_least=1)
    monkeypatch.setattr(spelling, "PIECE", 1000)
    assert b"".join(spelling.pieces(rows[0][1])) == rows[0][1].encode()
    counted = Counter()
    for piece in spelling.pieces(rows[0][1]):
        counted.update(piece.replace(b",", b" ").split())
    assert counted[b"tokens"] == 5000 and counted[b"longword" * 40] == 1
    assert spelt(spelling.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), at_least=1)) == whole


def test_no_words(spark):
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_spelling_query_whole(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert spelt(QUERIES["op12_spelling_variants"](spark, DATA)) == brute_variants(rows)


# Hard negatives


def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    part = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for k, (i, label, v) in enumerate(part):
        if not is_anchor(i):
            continue
        scored = [(j, sum(a * b for a, b in zip(v, w, strict=False)), other) for m, (j, other, w) in enumerate(part) if m != k]
        for p, score, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            fits = sorted((s for s in scored if s[2] != label and 50 * score <= 100 * s[1] <= 95 * score), key=order)
            out += [(i, p, r + 1, s[0], score, s[1]) for r, s in enumerate(fits[:negatives])]
    return sorted(out, key=str)


def vectors(seed, n, dims, labels):
    r = random.Random(seed)
    rows = [(i, r.choice(labels), [r.gauss(0.1, 0.3) for _ in range(dims)]) for i in range(n)]
    rows += [(i, label, list(v)) for i, label, v in rows[:20]]  # repeated rows, and ties
    return rows + [(1000, None, [1.0] * dims), (1001, labels[0], None), (1002, labels[0], [float("nan")] * dims), (1003, labels[0], [None, 1.0]), (1004, labels[0], [float("-inf"), 1.0]), (1005, labels[0], [0.9, 0.8]), (1010, labels[0], []), (None, labels[0], [0.5] * dims), (None, labels[-1], [0.4] * dims), (1020, labels[0], [9000.0] * dims), (1030, labels[-1], [8000.0] * dims)]


@pytest.mark.parametrize("dims, labels, sizes", [(5, [1, 2, 3], (7, 3, 2)), (33, [1, 1, 1, 1, 2], (16, 4, 8)), (8, list(range(60)), (1024, 256, 32))])
def test_negatives_by_brute_force(spark, dims, labels, sizes):
    rows = vectors(dims, 150, dims, labels)
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("row", F.lit("clash")).withColumn("g", F.lit(0))
    got = hard_negatives.mine(d, F.col("vec_id") % 5 == 0, n_rows=sizes[0], n_anchors=sizes[1], width=sizes[2])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_negatives(rows, lambda i: i is not None and i % 5 == 0)


def test_text_labels_and_other_numbers(spark):
    rows = vectors(3, 80, 4, ["a", "b"])
    d = spark.createDataFrame(rows, "id long, kind string, v array<float>")
    rows = [(i, k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, k, v in rows]
    got = hard_negatives.mine(d, F.col("id") % 4 == 0, "id", "kind", "v", positives=2, negatives=5, n_rows=10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_negatives(rows, lambda i: i is not None and i % 4 == 0, 2, 5)


def test_no_vectors(spark):
    d = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(d, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [0.5])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(one, F.col("vec_id") % 50 == 0).count() == 0


def test_scores_dont_travel(spark):
    rows = vectors(7, 120, 9, [1, 2, 3])
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(d, F.col("vec_id") % 5 == 0, n_rows=16, n_anchors=8, width=4)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [g" in plan and "tile" not in plan
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_negatives(rows, lambda i: i is not None and i % 5 == 0)


def test_panels_take_the_bytes_that_components_need(spark):
    rows = [(i, i, 0, [x, 1], 0, 0, 1) for i, x in enumerate([127, -128, 5])] + [(i, i, 0, [x, -1], 1, 0, 1) for i, x in enumerate([128, 3])] + [(9, 9, 0, [-40000, 0], 2, 0, 1)]
    d = spark.createDataFrame(rows, "row long, id long, label long, q array<int>, g long, block long, others long")
    made = {(r["g"], r["d"]): (r["size"], np.frombuffer(r["panel"], f"i{r['size']}").tolist()) for r in hard_negatives.panels(d, 2, 1).collect()}
    assert made == {(0, 0): (1, [127, -128, 5]), (0, 1): (1, [1, 1, 1]), (1, 0): (2, [128, 3]), (1, 1): (1, [-1, -1]), (2, 0): (4, [-40000]), (2, 1): (1, [0])}
