"""What the two text classifiers share: the labelled sample and hashed words."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import held_out

# Labelled documents that a model is fitted on, about; all are used up to here.
# Beyond, a hash of doc_id picks them, so the sample is the same every time.
SAMPLE = 20_000
_CACHED = 500_000


class Hasher:
    """Hash of a word into ``size`` slots, remembered for words seen lately."""

    def __init__(self, size: int, normal: Callable[[str], str] = str):
        self.size, self.normal, self.known = size, normal, {}

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(known) > _CACHED:
                known.clear()
            for word in words:
                if word not in known:
                    known[word] = zlib.crc32(self.normal(word).encode("utf-8", "surrogatepass")) % self.size
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    features: Callable[[list[str | None]], list[np.ndarray]],
    most: int = SAMPLE,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature ids and labels (0 or 1) of about ``most`` labelled documents.

    Held-out ids, null ids and null labels are left out.  Of several labels for an
    id the largest counts.  The sample's ids are few, so they go to the documents.
    """
    marked = (
        labels.select(labels["doc_id"].alias("__id"), labels[label].cast("int").alias("__label"))
        .where("__label is not null")
        .where(~held_out(F.col("__id")))
        .groupBy("__id")
        .agg(F.max("__label").alias("__label"))
    )
    total = marked.count()
    place = F.pmod(F.xxhash64("__id"), F.lit(1 << 20))
    share = min(1.0, most / max(total, 1))
    chosen = F.broadcast(marked.where(place < int(share * (1 << 20))))
    rows = docs.select(docs["doc_id"].alias("__doc"), docs["text"].alias("__text"))

    @F.pandas_udf(T.BinaryType())
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([ids.astype("<u4").tobytes() for ids in features(texts.tolist())])

    sample = rows.join(chosen, F.col("__doc") == F.col("__id")).select(
        "__id", "__label", encoded("__text").alias("__ids")
    )
    found = sample.toArrow()
    order = pc.sort_indices(found, [("__id", "ascending"), ("__ids", "ascending")]).to_pylist()
    # Views of the received table: the sample is in the driver's memory once.
    received = found["__ids"]
    ids = [np.frombuffer(received[i].as_buffer(), "<u4") for i in order]
    return ids, found["__label"].to_numpy()[order].astype(np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows laid end to end, and the row number of each entry."""
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), [len(row) for row in rows])
