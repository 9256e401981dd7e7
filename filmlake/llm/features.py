"""Sparse text features: hashed n-grams of words and signs, and learners on them.

A token is a run of letters and digits or a run of other signs, A to Z lower-cased.
Whole texts are taken. The features of a text are its distinct n-grams, hashed to
``2 ** BITS`` places, each with value one, so a text's score is the sum of their weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.words import buffers, chain, encoded, span_hashes

BITS = 18
ORDER = 2
# rows a model is fitted on, at most, one after the other and so many times over
TRAIN_ROWS = 12_000
EPOCHS = 5

_KIND = np.full(256, 2, dtype=np.int8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[128:] = _KIND[48:58] = _KIND[97:123] = 1


def features(texts: Sequence[str | None], order: int = ORDER) -> Iterator[np.ndarray]:
    """Places of each text's features; the last one, the intercept, is always there."""
    shift = np.uint64(64 - BITS)
    last = np.array([1 << BITS])
    for _, _, raw, starts in buffers([encoded(x, lower=True) for x in texts]):
        kind = np.zeros(len(raw) + 2, dtype=np.int8)
        kind[1:-1] = _KIND[np.frombuffer(raw, dtype=np.uint8)]
        edges = np.flatnonzero(kind[1:] != kind[:-1])
        token = kind[edges[:-1] + 1] > 0 if len(edges) else np.empty(0, dtype=bool)
        begins, ends = edges[:-1][token], edges[1:][token]
        hashes = span_hashes(raw, begins, ends)
        bounds = np.append(np.searchsorted(begins, starts), len(begins))
        for i in range(len(starts)):
            own = hashes[bounds[i] : bounds[i + 1]]
            grams = np.concatenate([chain(own, n) for n in range(1, order + 1)]) >> shift
            yield np.append(np.unique(grams).astype(np.int64), last)


class Ftrl:
    """Follow-the-regularised-leader weights, one step size per place."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 0.0) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, place) -> np.ndarray:
        z, n = self.z[place], self.n[place]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def update(self, place: np.ndarray, weight: np.ndarray, slope: float) -> None:
        before = self.n[place]
        after = before + slope * slope
        self.z[place] += slope - (np.sqrt(after) - np.sqrt(before)) / self.alpha * weight
        self.n[place] = after


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def sampled(labelled: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows, the first by a hash of their key."""
    return labelled.orderBy(F.xxhash64(key), key).limit(rows)


def fitted(
    train: DataFrame, learn: Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]], order: int = ORDER, extra: int = 0
) -> np.ndarray:
    """The weights that ``learn`` finds on ``text`` and ``target``, and ``extra`` more numbers.

    Updates follow one another, so ``train`` is one task; it has at most the rows sampled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if parts:
            own = pd.concat(parts).sort_values(["order", "target"], kind="stable")
            rows = [x.astype(np.int32) for x in features(own["text"].tolist(), order)]
            place, weight = learn(rows, own["target"].to_numpy())
            yield pd.DataFrame({"place": place, "weight": weight})

    alone = train.withColumn("order", F.xxhash64("text")).repartition(1)
    out = np.zeros((1 << BITS) + 1 + extra)
    for place, weight in alone.mapInPandas(run, "place int, weight double").collect():
        out[place] = weight
    return out
