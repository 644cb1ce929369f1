"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text. Training pairs
one document labelled good with one labelled bad; the probability that the good one
wins is the logistic function of the difference of their strengths, and the
weights minimise the logistic loss over feature differences. The threshold is a
quantile of the strengths: the share of bad documents among the labels.

Training reads a bounded sample of the labelled documents (``SAMPLE`` rows);
features and scores are one projection of Spark SQL functions over whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.common import quoted, whole_row

SAMPLE = 20_000  # labelled documents used for training, by the smallest hashes of their ids
PAIRS = 100_000
RIDGE = 1e-3
CUT = 0.3  # score at the threshold
FOLDS, HELD_OUT = 5, 0

_SPACES = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
FEATURES = (
    "symbols", "exclamations", "upper", "digits", "punctuation", "word_length", "words",
    "neighbours_equal", "distinct_words", "repeated_lines",
)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def features(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` replaced by the array ``x`` of its features; null counts as empty."""
    text = F.col("text")
    rows = rows.withColumn("text", F.coalesce(text, F.lit("")))
    rows = rows.withColumn("_words", F.expr(rf"filter(split(text, '{_SPACES}'), w -> w <> '')".replace("\\", "\\\\")))
    rows = rows.withColumn("_lines", F.expr(r"filter(split(text, '\n', -1), l -> trim(l) <> '')"))

    def count(characters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, characters, ""))

    words = F.greatest(F.size("_words"), F.lit(1))
    chars = F.greatest(F.length(text), F.lit(1))
    equal = F.expr("size(filter(transform(_words, (w, i) -> w = get(_words, i - 1)), e -> e))")
    x = (
        F.log1p(count("#*$%&|<>") / words),
        F.log1p(count("!") / words),
        count(_UPPER) / chars,
        count("0123456789") / chars,
        F.log1p(count(".,;:?") / words),
        F.log1p(chars / words),
        F.log1p(F.size("_words")),
        equal / words,
        F.size(F.array_distinct("_words")) / words,
        1 - F.size(F.array_distinct("_lines")) / F.greatest(F.size("_lines"), F.lit(1)),
    )
    # through a generator: a filter on what is computed from the features is not moved
    # below it, where it would split the text again for each of them
    return rows.select(
        *[c for c in rows.columns if c not in ("text", "_words", "_lines")],
        F.explode(F.array(F.array(*[v.cast("double") for v in x]))).alias("x"))


@dataclass(frozen=True)
class Model:
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weight: tuple[float, ...]
    threshold: float

    def strength(self, x: Column) -> Column:
        total = F.lit(0.0)
        for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weight, strict=True)):
            total = total + F.greatest(F.lit(-6.0), F.least(F.lit(6.0), (x[i] - m) / s)) * w
        return total

    def score(self, x: Column) -> Column:
        """From 0 to 1, ``CUT`` at the threshold."""
        return 1 / (1 + F.exp(-(self.strength(x) - self.threshold) - math.log(CUT / (1 - CUT))))


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 7) -> Model:
    """Weights by Newton steps on the pairs' logistic loss; without both labels every score is alike."""
    n_features = x.shape[1]
    if not good.any() or good.all():
        zero = (0.0,) * n_features
        return Model(zero, (1.0,) * n_features, zero, 0.0 if good.any() or not len(good) else 1.0)
    mean = x.mean(axis=0)
    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    z = standardised(x, mean, scale)
    rng = np.random.default_rng(seed)
    ups, downs = np.flatnonzero(good), np.flatnonzero(~good)
    # every document is in a pair; the rest are drawn at random
    n = min(pairs, 8 * max(len(ups), len(downs)))
    up = np.concatenate([rng.permutation(ups), rng.choice(ups, max(0, n - len(ups)))])
    down = np.concatenate([rng.permutation(downs), rng.choice(downs, max(0, n - len(downs)))])
    size = max(len(up), len(down))
    difference = z[np.resize(up, size)] - z[np.resize(down, size)]
    weight = np.zeros(n_features)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(difference @ weight, -500, 500)))
        gradient = difference.T @ (p - 1) / size + ridge * weight
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / size + ridge * np.eye(n_features)
        step = np.linalg.solve(hessian, gradient)
        weight = weight - step
        if np.abs(step).max() < 1e-9:
            break
    strengths = np.sort(z @ weight)
    below = int((~good).sum())
    threshold = float(strengths[below - 1] + strengths[below]) / 2
    return Model(tuple(mean.tolist()), tuple(scale.tolist()), tuple(weight.tolist()), threshold)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    labelled = labels.select(F.col(quoted(id_col)).cast("long").alias("of"), F.col(quoted(label_col)).cast("int").alias("label"))
    labelled = labelled.where(~held_out(F.col("of")) & F.col("of").isNotNull() & F.col("label").isNotNull())
    labelled = labelled.orderBy(F.xxhash64("of"), "of", "label").limit(sample)
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    # at most `sample` rows, so it can be broadcast
    found = features(rows.join(F.broadcast(labelled), F.col("doc_id") == F.col("of")).select("of", "label", "text"))
    # of rows that repeat a doc_id one stands for all, so the sample keeps its bound
    chosen = found.groupBy("of", "label").agg(F.min("x").alias("x")).orderBy("of", "label").collect()
    x = np.array([r.x for r in chosen], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.label == 1 for r in chosen], bool))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Null and empty texts get the score of an empty text. Repeated rows each get the
    same answer; a null doc_id is not held out. Other columns are not read.
    """
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    scored = features(rows).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``CUT``, with their columns."""
    rows = docs.select(whole_row(docs).alias("row"), F.col(quoted(text_col)).alias("text"))
    return features(rows).where(model.score(F.col("x")) >= CUT).select("row.*")
