"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and the beginnings of its long words.  The
score is a logistic function of a bias, a weight per term, and for every pair of terms the
product of their factor vectors, so that two words can be worse together than each
alone.  The pairs cost no more than the terms: half of (sum of vectors) squared minus the
sum of squares, over the number of terms, so that long texts weigh no more than short.

The weights are fitted first, then the factors on what the weights leave unexplained.  A
third of the labelled sample says after how many rounds the factors serve documents that
they were not fitted on, which may be none, and how raw scores become probabilities.

The model is fitted on a bounded sample of labelled documents; all documents are
scored inside Arrow batches, one row at a time as to memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import held_out
from flowlens.llm.decontam import words_of
from flowlens.llm.learning import SAMPLE, Hasher, flat, labelled, sigmoid

SLOTS = 1 << 18
FACTORS = 4
EPOCHS = 6
FACTOR_EPOCHS = 16  # at most; fewer when so many in a row do not help
PATIENCE = 3
BATCH = 128
RATE, FACTOR_RATE = 0.2, 0.3
L1, L2 = 5e-4, 1e-3
SPREAD = 0.1  # of the factors at the start
FOLDS = 3  # one of them tells when to stop
STEM = 5  # letters of a long word's beginning, which inflected forms share
LEAST_DOCUMENTS = 4  # terms of fewer documents in the sample are not learned
THRESHOLD = 0.5

_hasher = Hasher(SLOTS)


def terms(texts: list[str | None]) -> list[np.ndarray]:
    """Slots of the distinct words of each text, and of the beginnings of long ones."""
    found = []
    for text in texts:
        words = set(words_of(text))
        words.update([f"{word[:STEM]}*" for word in words if len(word) > STEM])
        found.append(_hasher.ids(list(words)))
    return found


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(rows))
        for place, ids in enumerate(rows):
            vectors = self.factors[ids]
            total = vectors.sum(0)
            pairs = 0.5 * (total @ total - (vectors * vectors).sum()) / max(1, len(ids))
            out[place] = self.bias + self.weights[ids].sum() + pairs
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self.slope * self.raw(rows) + self.shift)


def _batches(rows: list[np.ndarray], random: np.random.Generator):
    """(row numbers, ids, the row of each id) of shuffled batches that have terms."""
    order = random.permutation(len(rows))
    for begin in range(0, len(order), BATCH):
        batch = order[begin : begin + BATCH]
        ids, of = flat([rows[i] for i in batch])
        if len(ids):
            yield batch, ids, of


def _weigh(rows: list[np.ndarray], labels: np.ndarray, size: int, seed: int) -> tuple[float, np.ndarray]:
    """Bias and weights by Adagrad, drawn to zero."""
    random = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    w, seen = np.zeros(size), np.full(size, 1e-2)
    for _ in range(EPOCHS):
        for batch, ids, of in _batches(rows, random):
            error = sigmoid(bias + np.bincount(of, w[ids], len(batch))) - labels[batch]
            bias -= 0.05 * error.mean()
            used, inverse = np.unique(ids, return_inverse=True)
            step = np.bincount(inverse, error[of], len(used)) / np.sqrt(len(batch))
            seen[used] += step * step
            pace = RATE / np.sqrt(seen[used])
            moved = w[used] - pace * step
            w[used] = np.sign(moved) * np.maximum(np.abs(moved) - pace * L1 * np.sqrt(len(batch)), 0)
    return bias, w


def _pair(rows: list[np.ndarray], labels: np.ndarray, bias: float, w: np.ndarray, seed: int):
    """Factors after each round, fitted to what bias and weights leave unexplained."""
    random = np.random.default_rng(seed)
    v = random.normal(0, SPREAD, (len(w), FACTORS))
    seen = np.full(v.shape, 1e-2)
    while True:
        for batch, ids, of in _batches(rows, random):
            vectors = v[ids]
            sums = np.stack([np.bincount(of, vectors[:, f], len(batch)) for f in range(FACTORS)], 1)
            squares = np.bincount(of, (vectors * vectors).sum(1), len(batch))
            sizes = np.maximum(1, np.bincount(of, minlength=len(batch)))
            pairs = 0.5 * ((sums * sums).sum(1) - squares) / sizes
            error = sigmoid(bias + np.bincount(of, w[ids], len(batch)) + pairs) - labels[batch]
            used, inverse = np.unique(ids, return_inverse=True)
            slope = (error / sizes)[of, None] * (sums[of] - vectors)
            step = np.stack([np.bincount(inverse, slope[:, f], len(used)) for f in range(FACTORS)], 1)
            step = step / np.sqrt(len(batch)) + L2 * v[used]
            seen[used] += step * step
            v[used] -= FACTOR_RATE / np.sqrt(seen[used]) * step
        yield v


def _loss(raw: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, raw) - labels * raw))


def _calibrated(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make raw scores of unseen rows probabilities, by Newton steps."""
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(slope * raw + shift)
        spread = p * (1 - p) + 1e-6
        gradient = np.array([((p - labels) * raw).sum() + 0.01 * (slope - 1), (p - labels).sum() + 0.01 * shift])
        cross = (spread * raw).sum()
        bend = np.array([[(spread * raw * raw).sum() + 0.01, cross], [cross, spread.sum() + 0.01]])
        step = np.linalg.solve(bend, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-6:
            break
    # Scores must rise with the raw ones, however few labels there are.
    return (float(slope), float(shift)) if slope > 0 and np.isfinite(shift) else (1.0, 0.0)


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Fit by Adagrad on shuffled batches: the weights, then the factors.

    Without labelled rows every score is one half's lower neighbour: nothing is
    known, and nothing is called toxic.  With labels of one kind only, or too few to
    hold some back, nothing is held back, and the factors play no part.
    """
    weights, factors = np.zeros(SLOTS), np.zeros((SLOTS, FACTORS))
    if not len(labels):
        return Machine(-1e-9, weights, factors)
    ids, of = flat(rows)
    live = np.flatnonzero(np.bincount(ids, minlength=SLOTS) >= LEAST_DOCUMENTS)
    place = np.full(SLOTS, -1, np.int32)
    place[live] = np.arange(len(live))
    # The sample is in memory once, as views of one array.
    ids = place[ids]
    counts = np.bincount(of[ids >= 0], minlength=len(labels))
    rows = np.split(ids[ids >= 0], np.cumsum(counts)[:-1])
    del ids, of

    back = np.arange(len(rows)) % FOLDS == 0
    slope, shift, best = 1.0, 0.0, 0
    if min(len(set(labels[back])), len(set(labels[~back]))) > 1:
        fitted = [rows[i] for i in np.flatnonzero(~back)]
        unseen = [rows[i] for i in np.flatnonzero(back)]
        bias, w = _weigh(fitted, labels[~back], len(live), seed)
        raw = Machine(bias, w, np.zeros((len(live), FACTORS))).raw(unseen)
        least = _loss(raw, labels[back])
        for epoch, v in zip(range(1, FACTOR_EPOCHS + 1), _pair(fitted, labels[~back], bias, w, seed)):
            paired = Machine(bias, w, v).raw(unseen)
            if (loss := _loss(paired, labels[back])) < least:
                raw, least, best = paired, loss, epoch
            if epoch - best >= PATIENCE:
                break
        slope, shift = _calibrated(raw, labels[back])
    bias, w = _weigh(rows, labels, len(live), seed)
    v = np.zeros((len(live), FACTORS))
    if best:
        v = next(v for epoch, v in enumerate(_pair(rows, labels, bias, w, seed), 1) if epoch == best)
    weights[live], factors[live] = w, v
    return Machine(bias, weights.astype(np.float32), factors.astype(np.float32), slope, shift)


def scorer(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Column:
    """Score of a row's text, for use in a select or filter over ``docs``."""
    model = train(*labelled(docs, labels, "toxic", terms, most))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.bias, model.weights, model.factors, model.slope, model.shift)
    )

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(Machine(*shared.value).scores(terms(texts.tolist())), dtype="float64")

    return score(docs["text"])


def score(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score and predicted.

    Null and empty texts have no terms and get the bias's score.  Repeated rows
    stay; rows without doc_id are held out; without labels all scores are just
    below one half.  Labels, language, source and id play no part in a score.
    """
    scored = docs.select(
        docs["doc_id"].alias("doc_id"),
        held_out(docs["doc_id"]).alias("held_out"),
        scorer(docs, labels, most).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    return docs.where(scorer(docs, labels, most) < THRESHOLD)
