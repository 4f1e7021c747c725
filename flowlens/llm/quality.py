"""Quality by logistic regression over hashed word n-grams, trained with FTRL-Proximal.

Words are normalised before they are hashed: a word with a run of symbols at its
end counts as that run, a word in capitals as a mark, any other in lower case
without punctuation, and a word equal to the one before it as a repetition.  One-
and two-grams of these are hashed, and a document's value for a slot is its share
of the n-grams; the score is the logistic of a sparse dot product.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import held_out
from flowlens.llm.learning import SAMPLE, Hasher, flat, labelled, sigmoid

SLOTS = 1 << 20
EPOCHS = 4
BATCH = 32
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.05
SCALE = 10.0  # values are shares of a text's n-grams times this
THRESHOLD = 0.3
_WORDS = 1 << 30
_REPEATED = 0x51ED27


def normal(word: str) -> str:
    core = word.rstrip(string.punctuation)
    tail = word[len(core) :]
    if tail.strip(".,;:?'\")]}"):
        return f"symbols {tail}"
    core = core.lstrip(string.punctuation)
    if len(core) > 1 and core.isupper():
        return "capitals"
    return core.lower()


_hasher = Hasher(_WORDS, normal)


def ngrams(texts: list[str | None]) -> list[np.ndarray]:
    """Slots of the one- and two-grams of each text, with repeats."""
    out = []
    for text in texts:
        ids = _hasher.ids((text or "").split())
        if len(ids) > 1:
            again = ids[1:] == ids[:-1]
            pairs = np.where(again, _REPEATED, (ids[:-1] * 0x9E3779B1 + ids[1:]) & 0x7FFFFFFFFFFF)
            pairs = (pairs ^ (pairs >> 21)) % SLOTS
            out.append(np.concatenate([ids % SLOTS, pairs]))
        else:
            out.append(ids % SLOTS)
    return out


@dataclass
class Regression:
    bias: float
    weights: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        sums = [self.weights[ids].sum() * SCALE / len(ids) if len(ids) else 0.0 for ids in rows]
        return sigmoid(self.bias + np.array(sums, np.float64))


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Regression:
    """Follow the regularised leader, in small batches of shuffled documents.

    Without labelled rows every score is one half.
    """
    if not len(labels):
        return Regression(0.0, np.zeros(SLOTS, np.float32))
    random = np.random.default_rng(seed)
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    bias, bias_n = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))), 1.0

    def weight(slots: np.ndarray) -> np.ndarray:
        pull = np.maximum(np.abs(z[slots]) - L1, 0)
        return -np.sign(z[slots]) * pull / ((BETA + np.sqrt(n[slots])) / ALPHA + L2)

    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            batch = order[begin : begin + BATCH]
            ids, of = flat([rows[i] for i in batch])
            # A slot met twice in a text adds its value twice, so repeats need no counts.
            values = np.concatenate([np.full(len(rows[i]), SCALE / max(len(rows[i]), 1)) for i in batch])
            used, inverse = np.unique(ids, return_inverse=True)
            now = weight(used)
            error = sigmoid(bias + np.bincount(of, now[inverse] * values, len(batch))) - labels[batch]
            step = np.bincount(inverse, error[of] * values, len(used))
            sigma = (np.sqrt(n[used] + step * step) - np.sqrt(n[used])) / ALPHA
            z[used] += step - sigma * now
            n[used] += step * step
            bias_n += error.sum() ** 2
            bias -= 0.1 * error.sum() / np.sqrt(bias_n)
    return Regression(bias, weight(np.arange(SLOTS)).astype(np.float32))


def scorer(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Column:
    """Score of a row's text, for use in a select or filter over ``docs``."""
    model = train(*labelled(docs, labels, "quality", ngrams, most))
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(Regression(*shared.value).scores(ngrams(texts.tolist())), dtype="float64")

    return score(docs["text"])


def score(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score and predicted.

    Null and empty texts have no n-grams and get the bias's score.  Repeated rows
    stay; rows without doc_id are held out; without labels all scores are one half.
    Labels, language, source and id play no part in a score.
    """
    scored = docs.select(
        docs["doc_id"].alias("doc_id"),
        held_out(docs["doc_id"]).alias("held_out"),
        scorer(docs, labels, most).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
