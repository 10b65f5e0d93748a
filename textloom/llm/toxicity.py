"""Toxicity scores from gradient-boosted trees over dense features.

The lexicon is learned from labelled documents: words and word beginnings that
toxic documents hold far more often than others, with their log-odds. A
document becomes a few dense numbers: densities of strong and weak lexicon
words, how many of them stand near a second-person pronoun, capitals,
punctuation and obfuscation rates. Boosted trees turn these into a raw
probability, and isotonic regression on labelled documents that the trees
haven't seen calibrates it.

The classifier is fitted on at most ``max_rows`` labelled documents, chosen by
a hash of their id; every document is scored, over its whole text, in one pass
without a shuffle. A quarter of the rows is for calibration alone: neither the
lexicon nor the trees have seen it. Terms of the other training documents are
weighed without that document's own label, so the lexicon doesn't flatter the
rows it came from. A term of the lexicon has to occur in three toxic documents
of the training rows, so their number bounds it.

Defined results: a null or empty text is scored like any other, from features
that are all zero; labels that are null are not used, and of several labels of
one document the largest counts; repeated rows get equal scores; with no
labels of one class every score is the share of toxic labels (0 without any);
an empty table gives an empty result; columns other than id and text are
carried through.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.words import fresh
from textloom.tables import stage

#: Common insults, which count as lexicon words from the start.
INSULTS = ["clown", "disgusting", "fool", "garbage", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless"]
#: Second-person pronouns in English, French, German and Spanish.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "vos", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tú", "ti", "usted", "ustedes", "vosotros"]
#: What stands in for a letter in a disguised word.
DISGUISE = str.maketrans("013457@$!", "oieastasi")

FEATURES = ["strong_density", "weak_density", "strong_count", "weak_count", "score_density", "highest_score", "distinct_hits", "near_second_person", "second_person_density", "capitals", "punctuation", "obfuscation", "length"]
SHORTEST, LONGEST, NEAR, PRIOR = 4, 8, 3, 5
STRONG, WEAK = 4.0, 2.0
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’¡¿…–—"
MEMO = 40_000


def plain(token: str) -> tuple[str, bool]:
    """A lower-case token without punctuation at its edges and without disguise; whether it was disguised."""
    core = token.strip(EDGE)
    if core.isalpha():
        return core, False
    letters = sum(map(str.isalpha, core))
    if letters >= 2 and letters * 2 > len(core):
        undone = re.sub(r"[\W_]", "", core.translate(DISGUISE))
        return undone, undone != core
    return core, False


def terms(word: str) -> list[str]:
    """The whole word and its beginnings."""
    return [word + "$", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))] if len(word) >= 3 else []


@dataclass
class Lexicon:
    #: term -> (toxic documents, other documents) that have it
    counts: dict[str, tuple[int, int]]
    toxic: int
    other: int

    def odds(self, term: str, label: int | None = None) -> float:
        """Log-odds of a term; with a label, without the document that asks."""
        a, b = self.counts[term]
        n, m = self.toxic, self.other
        if label is not None:
            a, n, b, m = a - label, n - label, b - (1 - label), m - (1 - label)
        return log((max(a, 0) + 0.5) / (n + 1)) - log((max(b, 0) + 0.5) / (m + 1))


class Features:
    """Turns texts into ``FEATURES``, with a bounded memory of words."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.memo = lexicon, {}
        self.second = set(SECOND_PERSON)

    def look(self, token: str) -> tuple | None:
        """(word, its lexicon terms, second person, disguised), or None if the token says nothing."""
        word, disguised = plain(token)
        known = tuple(t for t in terms(word) if t in self.lexicon.counts)
        second = word in self.second
        return (word, known, second, disguised) if known or second or disguised else None

    def __call__(self, text: str | None, label: int | None = None) -> list[float]:
        text = text or ""
        tokens, memo = text.lower().split(), self.memo
        if len(memo) > MEMO:
            memo.clear()
        for t in set(tokens).difference(memo):
            memo[t] = self.look(t)
        told = [(i, x) for i, x in enumerate(map(memo.get, tokens)) if x is not None]
        n = max(1, len(tokens))
        second = [i for i, x in told if x[2]]
        strong = weak = near = disguised = 0
        total = best = 0.0
        distinct = set()
        for i, (word, known, _, hidden) in told:
            disguised += hidden
            score = max((self.lexicon.odds(t, label) for t in known), default=0.0)
            if score < WEAK:
                continue
            strong, weak = strong + (score >= STRONG), weak + (score < STRONG)
            total, best = total + score, max(best, score)
            distinct.add(word)
            at = bisect_left(second, i - NEAR)
            near += at < len(second) and second[at] <= i + NEAR
        raw = text.encode("utf-8", "replace")
        upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks = raw.count(b"!") + raw.count(b"?")
        many = lambda x: log(1 + x)
        return [100 * strong / n, 100 * weak / n, many(strong), many(weak), total / n, best, many(len(distinct)), many(near), 100 * len(second) / n, upper / max(1, len(raw)), marks / n, disguised / n, log(n)]


def with_features(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", label_col: str | None = None, only: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``only``) with an array ``features``; labels serve to leave a row's own label out."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # of at most max_rows documents
    keep = only or docs.columns
    schema = docs.select(*keep).schema.add("features", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in batches:
            at = {c: i for i, c in enumerate(batch.schema.names)}
            texts, labels = batch.column(at[text_col]), batch.column(at[label_col]) if label_col else None
            made = pa.array([features(t.as_py(), labels[i].as_py() if label_col else None) for i, t in enumerate(texts)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in keep), made], [*keep, "features"])

    return docs.mapInArrow(run, schema)


def learn_lexicon(train: DataFrame, text_col: str, label_col: str) -> Lexicon:
    """The lexicon of a bounded set of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        toxic: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                own = {t for w in set((text.as_py() or "").lower().split()) for t in terms(plain(w)[0])}
                (toxic if label.as_py() else held).update(own)
        names = list(held.keys() | toxic.keys())
        for i in range(0, len(names), 50_000):
            part = names[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[t] for t in part], pa.int64()), pa.array([held[t] for t in part], pa.int64())], ["term", "toxic", "other"])

    n = {r[0]: r[1] for r in train.groupBy(label_col).count().collect()}
    a, b = n.get(1, 0), n.get(0, 0)
    counted = train.select(text_col, label_col).mapInArrow(run, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (a + 1)) - F.log((F.col("other") + 0.5) / (b + 1))
    best = counted.where((F.col("toxic") >= 3) & (odds >= WEAK))
    counts = {r["term"]: (r["toxic"], r["other"]) for r in best.collect()}
    for w in INSULTS:
        x = counts.get(w + "$", (0, 0))
        counts[w + "$"] = (x[0] + PRIOR, x[1])
    return Lexicon(counts, a, b)


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000) -> Model:
    """Learns from labelled documents that aren't held out, at most about ``max_rows`` of them.

    ``max_rows`` bounds the rows, and with them the lexicon that is sent to all tasks.
    """
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    labels = stage(labels, "toxic_labels")
    n = labels.count()
    some = labels.where(F.pmod(F.xxhash64(id_col, F.lit("fit")), F.lit(1_000_000)) < int(1e6 * min(1.0, max_rows / max(1, n))))
    train = docs.select(id_col, text_col).join(F.broadcast(some), id_col)  # at most about max_rows ids
    part = F.pmod(F.xxhash64(id_col, F.lit("part")), F.lit(4))
    train = stage(train.withColumn("_seen", F.when(part > 0, F.col("_label"))), "toxic_train")
    lexicon = learn_lexicon(train.where("_seen is not null"), text_col, "_seen")
    rows = lexicon.toxic + lexicon.other
    if not lexicon.toxic or not lexicon.other:
        return Model(lexicon, None, None, lexicon.toxic / max(1, rows))
    made = with_features(train, lexicon, text_col, "_seen", ["_label", "_seen"]).select(F.col("_label").cast("double").alias("label"), "_seen", "features")
    made = stage(made, "toxic_features").withColumn("x", array_to_vector("features"))
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.2, seed=7).fit(made.where("_seen is not null"))
    raw = trees.transform(made.where("_seen is null")).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = None if raw.isEmpty() else IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return Model(lexicon, trees, calibration, lexicon.toxic / rows)


def score(docs: DataFrame, model: Model, text_col: str = "text", only: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` (or its columns ``only``) with the columns ``names``: score and prediction. A column that has one of these names already gives way."""
    keep = [c for c in only or docs.columns if c.lower() not in {n.lower() for n in names}]
    # What is carried through lies in one column, so no name in it meets those of the model's stages.
    held = docs.select(F.struct(*[docs[c] for c in keep]).alias("_doc"), docs[text_col].alias("_text"))
    if model.trees is None:
        out = held.withColumn("score", F.lit(float(model.share)))
    else:
        made = with_features(held, model.lexicon, "_text", only=["_doc"]).withColumn("x", array_to_vector("features")).drop("features")
        out = model.trees.transform(made).withColumn("raw", vector_to_array("probability")[1]).drop("x", "rawPrediction", "probability", "prediction")
        if model.calibration:
            out = model.calibration.transform(out)
            # Isotonic steps tie many rows; a hundredth of the raw probability keeps their order.
            out = out.withColumn("score", F.lit(0.99) * F.col("prediction") + F.lit(0.01) * F.col("raw"))
        else:
            out = out.withColumnRenamed("raw", "score")
    return out.select("_doc.*", F.col("score").alias(names[0]), (F.col("score") >= 0.5).cast("int").alias(names[1]))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that a classifier fitted on ``labels`` doesn't call toxic, with all their columns."""
    names = fresh(docs, "toxic_score", "toxic_predicted")
    out = score(docs, fit(docs, labels, id_col, text_col), text_col, names=(names[0], names[1]))
    return out.where(F.col(names[1]) == 0).drop(*names)
