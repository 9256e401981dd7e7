"""Quality scores: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Learns from at most ``train_rows`` labelled rows, the first by a hash of their id; NULL
labels teach nothing. Scores every whole text as a
sparse dot product; a NULL or empty text scores by the intercept alone. Equal texts score
alike. Without any labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.features import EPOCHS, TRAIN_ROWS, Ftrl, features, fitted, sampled, sigmoid


def _learn(rows: list, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    model = Ftrl()
    for _ in range(EPOCHS):
        for place, y in zip(rows, target, strict=True):
            weight = model.weights(place)
            model.update(place, weight, sigmoid(weight.sum()) - y)
    used = np.flatnonzero(model.n)
    return used, model.weights(used)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from ``doc_id, text`` and ``doc_id, target`` (0 or 1)."""
    chosen = sampled(labels.filter("target IS NOT NULL AND doc_id IS NOT NULL"), "doc_id", train_rows)
    train = docs.join(F.broadcast(chosen), "doc_id").select("text", "target")
    return fitted(train, _learn)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` (any columns, with ``text``) without the text and with ``score`` and ``predicted``."""
    rest = [c for c in docs.columns if c not in ("text", "score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = shared.value
            out = batch[rest].copy()
            out["score"] = [float(sigmoid(known[p].sum())) for p in features(batch["text"].tolist())]
            out["predicted"] = (out["score"] >= 0.5).astype(np.int32)
            yield out

    kept = docs.select(*rest, "text")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "text")
    return kept.mapInPandas(run, f"{schema}score double, predicted int")
