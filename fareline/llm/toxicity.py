"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each link is a logistic regression over
the words and word beginnings of the whole text and over the probabilities of the links
before it; a link learns from out-of-fold probabilities, so that it meets in training
what it will meet later. The labels give only whether a document is toxic, so the inner
categories are labelled weakly, as toxic documents with one of a few seed terms; the
last link is the label itself and learns all terms and all languages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import map_columns

#: Seed terms of the inner categories, in the order of the chain.
CATEGORIES = {
    "insult": ["idiot", "moron", "clown", "loser", "fool", "stupid", "dumb"],
    "contempt": ["pathetic", "worthless", "disgusting", "trash", "scum", "garbage", "filth"],
    "threat": ["kill", "hurt", "destroy", "die"],
}
TOXIC = "toxic"

#: The training sample: documents of either label and bytes of a document; longer ones
#: are left out of the sample, never cut.
POSITIVE, NEGATIVE, LONGEST = 2000, 3000, 30_000
#: Features: documents that must hold one, how many are chosen, lengths of beginnings.
LEAST_DOCS, FEATURES, BEGINNINGS = 5, 1500, (4, 5, 6, 7)
FOLDS = 5
ROUNDS = 120
PENALTY = 1.0

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


@dataclass
class ToxicityModel:
    """Chosen features and, for each link, weights, bias and the least probability to flag."""

    features: dict[str, int]
    links: list[tuple[str, np.ndarray, float]] = field(default_factory=list)
    threshold: float = 0.5

    def present(self, text: str) -> list[int]:
        """Numbers of the features that occur in the whole text."""
        words, get = _words(text), self.features.get
        found = {n for w in words if (n := get(w)) is not None}
        for size in BEGINNINGS:
            starts = {w[:size] for w in words if len(w) > size}
            found.update(n for s in starts if (n := get(s + "*")) is not None)
        return sorted(found)

    def predict(self, text: str | None) -> list[float]:
        """A probability for each link, in the order of the chain."""
        at, earlier = self.present(text or ""), []
        for _, weights, bias in self.links:
            score = bias + weights[at].sum() + float(np.dot(weights[len(self.features) :], earlier))
            earlier.append(float(1 / (1 + np.exp(-np.clip(score, -50, 50)))))
        return earlier


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with a squared penalty, by accelerated gradient steps."""
    n, width = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weights, bias = np.zeros(width, np.float32), float(np.log(share / (1 - share)))
    ahead, ahead_bias, momentum = weights.copy(), bias, 1.0
    rate = 4.0 / (np.einsum("ij,ij->i", x, x).mean() + 1 + PENALTY / n)
    for _ in range(ROUNDS):
        # Weights of doubles would have all of x copied as doubles.
        score = x @ ahead.astype(np.float32) + ahead_bias
        error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y).astype(np.float32)
        new = ahead - rate * (x.T @ error / n + PENALTY / n * ahead)
        new_bias = ahead_bias - rate * float(error.mean())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias, momentum = new.astype(np.float32), new_bias, following
    return weights, bias


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _choose(texts: list[str], y: np.ndarray) -> dict[str, int]:
    """The features whose documents differ most in the label (chi-squared)."""
    seen, toxic = Counter(), Counter()
    for text, label in zip(texts, y, strict=True):
        every = {f for w in _words(text) for f in word_features(w)}
        seen.update(every)
        if label:
            toxic.update(every)
    share, scored = y.mean(), []
    for f, n in seen.items():
        if n >= LEAST_DOCS:
            scored.append((-((toxic[f] - n * share) ** 2) / n, f))
    return {f: i for i, (_, f) in enumerate(sorted(scored)[:FEATURES])}


#: Weights and bias of a fit, and its probabilities for the rows left out of it.
Fit = tuple[np.ndarray, float, np.ndarray]


def _matrix(present: Sequence[np.ndarray], width: int, earlier: np.ndarray, rows: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), width + earlier.shape[1]), np.float32)
    for i, row in enumerate(rows):
        x[i, present[row]] = 1
    x[:, width:] = earlier[rows]
    return x


def fit_without(
    present: Sequence[np.ndarray], width: int, earlier: np.ndarray, target: np.ndarray, fold: int
) -> Fit:
    """A link fitted to all rows but those of one fold, the rows numbered round the folds.

    present: numbers of each row's features; earlier: out-of-fold probabilities of the
    links before. fold FOLDS leaves no row out. Several run beside each other on an
    executor, so one holds a single matrix of the rows it learns from, and no copy of it.
    """
    left = np.arange(len(present)) % FOLDS == fold
    learnt, out = np.flatnonzero(~left), np.flatnonzero(left)
    weights, bias = _fit(_matrix(present, width, earlier, learnt), target[learnt])
    score = _matrix(present, width, earlier, out) @ weights + bias
    return weights, bias, (1 / (1 + np.exp(-np.clip(score, -50, 50)))).astype(np.float32)


def _fits_in_turn(present: Sequence[np.ndarray], width: int, earlier: np.ndarray, target: np.ndarray) -> list[Fit]:
    return [fit_without(present, width, earlier, target, fold) for fold in range(FOLDS + 1)]


def fits_as_tasks(spark: SparkSession) -> Callable[..., list[Fit]]:
    """The fits of a link as Spark tasks, one for each fold and one for all rows.

    Tasks get the sample, whose size is bounded, as feature numbers, and send weights back.
    """

    def fits(present: Sequence[np.ndarray], width: int, earlier: np.ndarray, target: np.ndarray) -> list[Fit]:
        shared = spark.sparkContext.broadcast((present, width, earlier, target))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for fold in batch["fold"]:
                    weights, bias, out = fit_without(*shared.value, int(fold))
                    yield pd.DataFrame(
                        [{"fold": fold, "weights": weights.tobytes(), "bias": bias, "out": out.tobytes()}]
                    )

        folds = spark.range(0, FOLDS + 1, 1, FOLDS + 1).withColumnRenamed("id", "fold")
        rows = folds.mapInPandas(run, "fold long, weights binary, bias double, out binary").collect()
        shared.unpersist()
        return [
            (np.frombuffer(r.weights, np.float32), r.bias, np.frombuffer(r.out, np.float32))
            for r in sorted(rows, key=lambda r: r.fold)
        ]

    return fits


def train(texts: list[str], toxic: list[int], fits: Callable[..., list[Fit]] = _fits_in_turn) -> ToxicityModel:
    """The chain, and the threshold that does best on out-of-fold probabilities.

    fits gives a link's fit without each fold in turn, and at last to all rows.
    """
    y = np.array(toxic, dtype=np.float32)
    if len(y) < FOLDS or y.min() == y.max():
        return ToxicityModel({}, [(TOXIC, np.zeros(0, np.float32), -50.0)])
    model = ToxicityModel(_choose(texts, y))
    # As arrays, which take a fraction of the memory of lists wherever they are sent.
    present = [np.array(model.present(text), np.uint16) for text in texts]
    labels = {
        name: y * np.array([not _words(t).isdisjoint(seeds) for t in texts]) for name, seeds in CATEGORIES.items()
    }
    earlier = np.zeros((len(y), 0), np.float32)
    for name, target in [*labels.items(), (TOXIC, y)]:
        if target.sum() < FOLDS and name != TOXIC:
            continue
        *parts, (weights, bias, _) = fits(present, len(model.features), earlier, target)
        model.links.append((name, weights, bias))
        # Later links see out-of-fold probabilities of this one, never its own fit.
        out = np.zeros(len(y), np.float32)
        for k, (_, _, left) in enumerate(parts):
            out[k::FOLDS] = left
        earlier = np.hstack((earlier, out[:, None]))
    model.threshold = _threshold(earlier[:, -1], y)
    return model


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability between 0.1 and 0.9 with the best F1; the middle of equals."""
    tried = np.linspace(0.1, 0.9, 81)
    f1 = []
    for t in tried:
        hit = p >= t
        f1.append(2 * (hit * y).sum() / max(1, hit.sum() + y.sum()))
    best = np.flatnonzero(np.isclose(f1, max(f1)))
    return float(tried[best[len(best) // 2]])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """A model from at most POSITIVE toxic and NEGATIVE other labelled documents."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    counts = {r[0]: r[1] for r in marked.groupBy("_toxic").count().collect()}
    share = F.when(F.col("_toxic") == 1, POSITIVE / max(1, counts.get(1, 0))).otherwise(
        NEGATIVE / max(1, counts.get(0, 0))
    )
    drawn = marked.where((F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity")) / F.lit(2.0**64)) + 0.5 < share)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text is not null")
    rows = (
        texts.where(F.octet_length("_text") <= LONGEST)
        # The limit proves the size of what is broadcast, and spares shuffling all texts.
        .join(F.broadcast(drawn.limit(2 * (POSITIVE + NEGATIVE))), "_id")
        .select("_text", "_toxic")
        .limit(2 * (POSITIVE + NEGATIVE))
        .collect()
    )
    rows = sorted({(r[0], r[1]) for r in rows})
    order = np.random.default_rng(11).permutation(len(rows))
    return train([rows[i][0] for i in order], [rows[i][1] for i in order], fits_as_tasks(docs.sparkSession))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """All columns of docs, a probability for each category (p_<name>) and is_toxic.

    Categories that had too few examples have probability 0. A null or empty text has
    the probabilities of a text without known words and isn't toxic. The whole text
    counts. Columns of docs with the added names are replaced; repeated rows give
    repeated results.
    """
    names = [*CATEGORIES, TOXIC]
    added = [*(f"p_{name}" for name in names), "is_toxic"]
    docs = docs.select([c for c in docs.columns if c not in added])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{n}` {k}" for n, k in docs.dtypes), *(f"{c} double" for c in added[:-1]), "is_toxic boolean"])
    place = docs.columns.index(text_col)

    def make():
        known = [name for name, _, _ in shared.value.links]

        def work(*columns: list) -> list[list]:
            found = [dict(zip(known, shared.value.predict(t), strict=True)) for t in columns[place]]
            toxic = [bool(t) and f[TOXIC] >= shared.value.threshold for t, f in zip(columns[place], found, strict=True)]
            return [*columns, *([f.get(name, 0.0) for f in found] for name in names), toxic]

        return work

    return map_columns(docs, docs.columns, schema, make)
