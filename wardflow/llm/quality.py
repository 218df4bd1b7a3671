"""A quality classifier: naive Bayes scaled n-gram indicators under a linear support vector machine.

Features are indicators of hashed n-grams: of words, and of word shapes (letter case, digits,
marks, and whether the word repeats the one before). Each is scaled by the log of the ratio of its
smoothed shares in the two classes, and the linear model over the scaled, length-normalised
indicators is fitted by dual coordinate descent on the hinge loss. Its weights are
mixed with their mean magnitude, and a logistic curve, fitted on rows that the model
did not see, turns margins into scores.

The model is fitted on at most ``train_rows`` labelled rows, those with the smallest hash of
their id: the one bound here. Every text is scored whole. Inputs are the text alone.

Defined results: a null text is empty; an empty text has one feature of its own; rows with a null
label teach nothing; of several labels of one id the largest counts; repeated rows count each
time; with one class or no labelled row the score is the smoothed share of label 1 for all.
Other columns are passed through or not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import Cache, fold_of, mix, rolling, table, texts

DIMENSIONS = 1 << 18
TRAIN_ROWS = 12_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Longest runs of words and of shapes that make a feature.
WORD_GRAMS, SHAPE_GRAMS = 2, 3


class _Classes(dict):
    """For str.translate: letters become A or a, digits 9, all else stays."""

    def __missing__(self, code: int) -> str:
        sign = chr(code)
        kind = "A" if sign.isupper() else "a" if sign.isalpha() else "9" if sign.isdigit() else sign
        self[code] = kind
        return kind


_CLASSES = _Classes()
_REPEAT = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """``Word's`` -> ``Aa'a``, ``ABC!!`` -> ``A!``: classes of characters, runs as one."""
    return _REPEAT.sub(r"\1", word.translate(_CLASSES))[:12]


def _digest(word: str) -> int:
    """40 bits for the word, then 24 for its shape."""
    own = xxhash.xxh64_intdigest(word.encode())
    return own >> 24 << 24 | xxhash.xxh32_intdigest(shape(word).encode()) >> 8


_DIGESTS = Cache(_digest, 600_000)


def features(text: str) -> np.ndarray:
    """Sorted places of the n-grams that ``text`` has."""
    words = text.split()
    if not words:
        return np.zeros(1, dtype=np.int32)
    both = np.fromiter(map(_DIGESTS.__getitem__, words), dtype=np.uint64, count=len(words))
    own, shapes = both >> np.uint64(24), both & np.uint64(0xFFFFFF)
    shapes[1:] += (own[1:] == own[:-1]).astype(np.uint64) << np.uint64(24)
    grams = [rolling(own, n) for n in range(1, WORD_GRAMS + 1)] + [rolling(shapes, n) for n in range(1, SHAPE_GRAMS + 1)]
    places = (np.concatenate(grams) % np.uint64(DIMENSIONS - 1)).astype(np.int32) + np.int32(1)
    places.sort()
    return places[np.append(True, places[1:] != places[:-1])]


@dataclass
class Model:
    """``weights`` already carry the log-count ratios; ``ratios`` give the length of a text's vector."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        length = float(np.sqrt(np.dot(self.ratios[places], self.ratios[places])))
        return float(self.weights[places].sum()) / max(length, 1e-9) + self.bias

    def score(self, places: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.offset, -35, 35))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.full(DIMENSIONS, alpha), np.full(DIMENSIONS, alpha)]
    for places, label in zip(rows, labels):
        counts[int(label)][places] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; the dual is solved one row at a time."""
    y = np.where(labels > 0, 1.0, -1.0)
    square = np.array([float(v @ v) + 1.0 for v in values])
    alpha, w, bias = np.zeros(len(rows)), np.zeros(DIMENSIONS), 0.0
    order = np.random.default_rng(5)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)):
            places, x = rows[i], values[i]
            slope = y[i] * (float(w[places] @ x) + bias) - 1
            ends = (alpha[i] == 0 and slope > 0) or (alpha[i] == cost and slope < 0)
            if ends or abs(slope) < 1e-9:
                continue
            worst = max(worst, abs(slope))
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            alpha[i] = new
            w[places] += step * x
            bias += step
        if worst < 0.05:
            break
    return w, bias


def logistic_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margin to score, by Newton steps with smoothed targets."""
    up, down = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, x.T @ (target - p)), -2, 2)
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, mixing: float = 0.25, epochs: int = 12) -> Model:
    """A model of both classes; every fourth row only calibrates the scores."""
    labels = np.asarray(labels)
    zero = np.zeros(DIMENSIONS)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    learn = np.arange(len(rows)) % 4 > 0
    if len(set(labels[learn].tolist())) < 2 or len(set(labels[~learn].tolist())) < 2:
        learn[:] = True
    ratios = log_count_ratios([r for r, k in zip(rows, learn) if k], labels[learn])
    own = [r for r, k in zip(rows, learn) if k]
    values = [ratios[r] / max(float(np.linalg.norm(ratios[r])), 1e-9) for r in own]
    w, bias = dual_coordinate_descent(own, values, labels[learn], cost, epochs)
    mean = np.abs(w).mean()
    model = Model(ratios * ((1 - mixing) * mean + mixing * w) / mixing, ratios, bias, 1.0, 0.0)
    tests = [r for r, k in zip(rows, learn) if not k] or rows
    seen = labels[~learn] if (~learn).any() else labels
    model.slope, model.offset = logistic_fit(np.array([model.margin(r) for r in tests]), seen)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the ``train_rows`` labelled rows with the smallest hash of ``doc_id`` among ``usable`` ones."""
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & usable)
    own = own.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most train_rows rows

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "places": found})

    found = rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    found = found.mapInPandas(work, "doc_id long, quality int, places binary")
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id", "places").limit(train_rows).collect()
    return fit([np.frombuffer(r["places"], dtype=np.int32) for r in sample], np.array([r["quality"] for r in sample]))


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(features(t)) for t in batch], dtype="float64")

    return docs.withColumn(column, score(F.coalesce("text", F.lit(""))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    scored = with_score(docs, model)
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
