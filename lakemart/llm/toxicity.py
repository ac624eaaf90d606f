"""Toxic texts by non-negative learning from positive and unlabelled examples."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, ship, store

#: Training texts, drawn by a hash of the id: confirmed toxic ones, and unlabelled ones. Expected numbers.
POSITIVES, UNLABELLED = 6_000, 12_000
#: Words the classifier knows, at most, and in how many training texts each is at least.
VOCABULARY, LEAST_TEXTS = 8_192, 5
#: Only words whose share of the toxic texts differs from their share of the others by so many standard errors
#: are known: rare words of single texts would be learned by heart.
LEAST_Z = 4.5
#: Documents with at least this score are rejected.
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 300, 0.05, 1e-3

_LETTERS = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings that stand beside the words themselves, for inflected forms.
BEGINNINGS = (4, 6)
#: A beginning that occurs so many times is one more feature.
TIMES = (2, 3)


def features_of(text: str) -> set[str]:
    """The different words of a text, and the beginnings of its words, with how often they
    occur."""
    words = Counter(_LETTERS.findall(text.lower()))
    begun: Counter = Counter()
    for word, n in words.items():
        for size in BEGINNINGS:
            if len(word) > size:
                begun[word[:size]] += n
    found = {b + "-" for b in begun}
    found.update(f"{b}-{k}" for b, n in begun.items() if n > 1 for k in TIMES if n >= k)
    return found.union(words)


@dataclass
class Sparse:
    """Which of the known words each text has."""

    columns: np.ndarray
    starts: np.ndarray  # one more than texts

    def times(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(w[self.columns])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def transposed_times(self, g: np.ndarray, width: int) -> np.ndarray:
        each = np.repeat(g, np.diff(self.starts))
        return np.bincount(self.columns, weights=each, minlength=width)


@dataclass
class Classifier:
    words: list[str]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> list[float]:
        known = dict(zip(self.words, self.weights.tolist(), strict=True))
        sums = [sum(map(known.__getitem__, known.keys() & features_of(t))) for t in texts]
        return (1 / (1 + np.exp(-np.clip(np.array(sums, dtype=np.float64) + self.bias, -30, 30)))).tolist()


def fit(positive: Sparse, unlabelled: Sparse, prior: float, width: int, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of the least non-negative risk with logistic loss, by Adam.

    Positives are the share ``prior`` of the unlabelled texts. The risk is
    ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``: the second part
    estimates the loss on negatives without having any. Where that estimate falls
    below zero, the classifier is learning the unlabelled texts by heart, and the step
    goes the other way along that part.
    """
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    n_p, n_u = len(positive.starts) - 1, len(unlabelled.starts) - 1

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for step in range(1, steps + 1):
        g_p, g_u = positive.times(w) + b, unlabelled.times(w) + b
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        as_positive = -prior * sigmoid(-g_p) / n_p
        as_negative = -prior * sigmoid(g_p) / n_p
        of_unlabelled = sigmoid(g_u) / n_u
        d_p, d_u = (as_positive + as_negative, of_unlabelled) if negative >= 0 else (-as_negative, -of_unlabelled)
        gradient = np.append(positive.transposed_times(d_p, width) + unlabelled.transposed_times(d_u, width) + penalty * w, d_p.sum() + d_u.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def level(sums: np.ndarray, prior: float) -> float:
    """The bias that gives texts with these sums of weights the mean score ``prior``, by bisection.

    The steps that go the other way raise the bias of ``fit``, the more so the fewer positives
    there are. With this one, no more than ``prior / t`` of the unlabelled texts score ``t``.
    """
    low, high = -30.0 - float(sums.max()), 30.0 - float(sums.min())
    for _ in range(60):
        middle = (low + high) / 2
        if (1 / (1 + np.exp(-np.clip(sums + middle, -30, 30)))).mean() < prior:
            low = middle
        else:
            high = middle
    return low


def _drawn(key: Column, share: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("toxicity")), 11) / float(2**53) < share


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """Learns from the texts that ``labels`` marks 1, and from texts without regard to labels.

    ``docs`` are the training documents. The class prior is the share of 1 among the
    labels of those documents; labels that are null, or of other documents, do not count. About ``positives`` and
    ``unlabelled`` texts are drawn; without a positive label, every score is 0. The unlabelled
    texts' mean score is the prior.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = pick(docs, id_col, text_col).toDF("doc_id", "text").where("doc_id is not null and text is not null")
    marks = (
        pick(labels, id_col, label_col).toDF("doc_id", "label").where("label is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.max((F.col("label") == 1).cast("int")).alias("label"))
    )
    of_docs = marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    labelled, toxic = of_docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic:
        return Classifier([], np.zeros(0), -30.0)
    prior = min(max(toxic / labelled, 0.01), 0.99)
    n = texts.select("doc_id").count()
    chosen = of_docs.where("label = 1").where(_drawn(F.col("doc_id"), F.lit(positives / toxic))).select("doc_id")
    known = texts.join(F.broadcast(chosen), "doc_id", "left_semi").withColumn("kind", F.lit(1))  # about `positives` rows
    unknown = texts.where(_drawn(F.col("doc_id"), F.lit(unlabelled / max(n, 1)))).withColumn("kind", F.lit(0))
    sample = known.unionByName(unknown).select("kind", "text")

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"kind": frame["kind"], "words": [sorted(features_of(t)) for t in frame["text"]]})

    split_texts = store(sample.mapInPandas(split, "kind int, words array<string>").withColumn("at", F.monotonically_increasing_id()), "training")
    sizes = {r["kind"]: r["n"] for r in split_texts.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    spread = split_texts.select("kind", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("kind").alias("p")
    )
    share = F.col("texts") / (n_p + n_u)
    error = F.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    z = F.when(error > 0, F.abs(F.col("p") / n_p - (F.col("texts") - F.col("p")) / n_u) / error).otherwise(0.0)
    telling = spread.where(F.col("texts") >= LEAST_TEXTS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    vocabulary = [r["word"] for r in telling.orderBy(F.col("z").desc(), "word").limit(VOCABULARY).select("word").collect()]
    place = {w: i for i, w in enumerate(vocabulary)}
    index = spark.sparkContext.broadcast(place)

    def look_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [np.array(sorted(index.value[w] for w in words if w in index.value), dtype="<u2").tobytes() for words in frame["words"]]
            yield pd.DataFrame({"kind": frame["kind"], "at": frame["at"], "found": found})

    table = split_texts.mapInPandas(look_up, "kind int, at long, found binary").toPandas().sort_values("at")

    def sparse(kind: int) -> Sparse:
        rows = [np.frombuffer(f, dtype="<u2") for f in table.loc[table["kind"] == kind, "found"]]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        return Sparse(np.concatenate([np.zeros(0, dtype=np.int64), *rows]).astype(np.int64), starts)

    positive, free = sparse(1), sparse(0)
    if len(positive.starts) < 2 or len(free.starts) < 2:
        return Classifier([], np.zeros(0), -30.0)
    weights, _ = fit(positive, free, prior, len(vocabulary))
    return Classifier(vocabulary, weights, level(free.times(weights), prior))


def score(docs: DataFrame, classifier: Classifier, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``, how likely each whole text is toxic (null: as an empty text,
    which has the score of no known word). The classifier knows at most ``VOCABULARY``
    words and is broadcast. Empty tables, repeated rows and extra columns pass through."""
    return _scored(docs, classifier, text_col).toDF(*docs.columns, name)


def drop_toxic(docs: DataFrame, classifier: Classifier, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold, all columns kept, whatever
    their names."""
    kept = _scored(docs, classifier, text_col).where(F.col("score") < threshold)
    return kept.drop("score").toDF(*docs.columns)


def _scored(docs: DataFrame, classifier: Classifier, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()), dtype="float64")

    columns = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    return plain.withColumn("score", scored(F.coalesce(F.col(f"c{columns.index(text_col)}"), F.lit(""))))
