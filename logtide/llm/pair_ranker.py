"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Pairs of a good and a bad labelled
document are preferences; the weights minimise the logistic loss on the feature differences.
The cut between good and bad is the quantile of the training scores that labels them best.

The fit uses a bounded sample of labelled rows; scoring is one pass over all texts.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import ship
from logtide.llm.quality_rules import STOP_FORMS

STOPS = frozenset(w.encode() for w in STOP_FORMS)
SYMBOLS, UPPER, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
N_FEATURES = 13


@dataclass(frozen=True)
class Fit:
    """Bounds and constants of the fit."""

    rows: int = 20_000  # labelled documents, those with the smallest hash of doc_id
    pairs_each: int = 20  # preferences each document of the larger class takes part in
    ridge: float = 1e-3
    steps: int = 40
    seed: int = 11


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, one half at the cut."""
        strength = (x - self.mean) / self.scale @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(strength, -500, 500)))


def features(text: bytes) -> list[float]:
    """Length, symbols, repetition, case and line shape of a whole text; all zero but for the empty one's last."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (N_FEATURES - 1) + [1.0]
    chars = sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    upper = len(text) - len(text.translate(None, UPPER))
    digits = len(text) - len(text.translate(None, DIGITS))
    distinct = len(set(words))
    same = sum(map(operator.eq, words, words[1:]))
    return [
        math.log1p(n),
        math.log1p(20 * symbols / n),
        math.log1p(20 * text.count(b"|") / n),
        math.log1p(20 * text.count(b"!") / n),
        math.log1p(20 * same / n),
        1 - distinct / n,
        math.log(n + 1) - math.log(distinct),
        1 - len(set(lines)) / len(lines),
        chars / n,
        math.log1p(20 * upper / chars),
        math.log1p(20 * digits / chars),
        sum(map(STOPS.__contains__, words)) / n,
        0.0,
    ]


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from training; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``fit.rows`` documents; ids with both labels are left out."""
    ship(docs.sparkSession)
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .orderBy(F.xxhash64(F.lit(fit.seed), "doc_id"), "doc_id")
        .limit(fit.rows)
        .select("doc_id", F.col("low").cast("int").alias("quality"))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            x = [features(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # ``known`` has at most fit.rows rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # Repeats of a document are one sample, whatever their number.
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    found = rows.mapInArrow(measure, f"doc_id {kind}, quality int, x array<double>").collect()
    found.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in found], float).reshape(-1, N_FEATURES)
    return x, np.array([r["quality"] for r in found], int)


def train(x: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Model:
    """Fit the strengths. Without two classes there is no preference: the weights stay zero and
    every document gets one half, or the side of the only class there is."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        cut = 0.0 if not len(y) else (-1.0 if len(good) else 1.0)
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), cut)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    draw = np.random.default_rng(fit.seed)
    many, few = (good, bad) if len(good) >= len(bad) else (bad, good)
    left = np.repeat(many, fit.pairs_each)
    right = draw.choice(few, len(left))
    d = z[left] - z[right] if many is good else z[right] - z[left]  # the better one less the other
    w = np.zeros(N_FEATURES)
    for _ in range(fit.steps):  # Newton steps on the convex loss
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        slope = -(d * p[:, None]).mean(0) + fit.ridge * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + fit.ridge * np.eye(N_FEATURES)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    strength = z @ w
    cuts = np.quantile(strength, np.linspace(0, 1, 401))
    right_ones = [((strength >= c) == (y == 1)).mean() for c in cuts]
    best = max(right_ones)
    # The middle of the quantiles that do equally well.
    equal = [c for c, r in zip(cuts, right_ones, strict=True) if r == best]
    return Model(mean, scale, w, float(equal[len(equal) // 2]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null text is scored as the empty one. Null ids (never held out) and repeated rows stay;
    other columns are not read; no rows give no rows.
    """
    ship(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            x = np.array([features(t or b"") for t in texts], float).reshape(-1, N_FEATURES)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= 0.5).astype("int32"))], ["doc_id", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    judged = docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double, predicted int")
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def pair_ranker(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    return score(docs, train(*labelled_sample(docs, labels, fit), fit))
