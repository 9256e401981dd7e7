"""Severity of toxic texts by cumulative-link ordinal regression on sparse text features.

Grades are 0 to K. One weight per feature is shared by K ordered thresholds; the chance that
the grade exceeds k is the logistic function of the text's score less threshold k, and their
sum over k is the expected severity. Fitted on at most ``train_rows`` graded rows, the first by a
hash of their id. NULL grades teach nothing; a NULL or empty text has no feature, so its severity
comes from the thresholds alone. Equal texts get equal severities. Without any graded row all
severities are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.llm.features import BITS, EPOCHS, TRAIN_ROWS, Ftrl, features, fitted, sampled, sigmoid

GRADES = 3
# expected severity from which a text counts as toxic
TOXIC = 0.4
# a word marks toxic texts if it is so many times as frequent there, in so many of them
MARK_RATIO = 8.0
MARK_TEXTS = 5


def _learner(thresholds: int):
    def learn(rows: list, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        model = Ftrl()
        cuts = 2.0 + np.arange(thresholds)
        seen = np.ones(thresholds)
        above = np.arange(thresholds)
        for _ in range(EPOCHS):
            for place, grade in zip(rows, grades, strict=True):
                place = place[:-1]  # the thresholds take the intercept's place
                weight = model.weights(place)
                error = sigmoid(weight.sum() - cuts) - (grade > above)
                model.update(place, weight, error.sum())
                seen += error * error
                cuts = np.maximum.accumulate(cuts + error / np.sqrt(seen))
        used = np.flatnonzero(model.n)
        return np.append(used, (1 << BITS) + 1 + above), np.append(model.weights(used), cuts)

    return learn


def grade_labels(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Grades from yes-or-no labels, for at most ``train_rows`` texts: ``text``, ``target``.

    A text that isn't toxic has grade 0. Marks are the words far more frequent among toxic
    texts; a toxic one has grade 2 if more of its words are marks than in the middle toxic text,
    and grade 1 otherwise.
    """
    chosen = sampled(labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL"), "doc_id", train_rows)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")
    words = F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), "")
    totals = rows.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")).first()
    rate = (F.col("bad") / max(totals.bad, 1)) / ((F.col("good") + 1) / (totals.good + 1))
    marks = (
        rows.select("toxic", F.explode(F.array_distinct(words)).alias("word"))
        .groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
        .filter((F.col("bad") >= MARK_TEXTS) & (rate >= MARK_RATIO))
        .select("word")
    )
    known = [row.word for row in marks.orderBy("word").collect()]  # words of bounded rows
    share = F.size(F.filter(words, lambda w: w.isin(known))) / F.greatest(F.size(words), F.lit(1))
    rows = rows.withColumn("share", share)
    middle = rows.filter("toxic = 1").agg(F.median("share")).first()[0] or 0.0
    grade = F.when(F.col("toxic") != 1, 0).when(F.col("share") > middle, 2).otherwise(1)
    return rows.select("text", grade.alias("target"))


def fit(train: DataFrame, grades: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds from bounded rows ``text``, ``target`` (0 to grades - 1)."""
    out = fitted(train, _learner(grades - 1), order=1, extra=grades - 1)
    cut = (1 << BITS) + 1
    weights, cuts = out[:cut], out[cut:]
    if not weights.any():
        cuts = np.full(grades - 1, 40.0)
    return weights, cuts


def severity(docs: DataFrame, weights: np.ndarray, cuts: np.ndarray, toxic: float = TOXIC) -> DataFrame:
    """``docs`` (any columns, with ``text``) without the text and with ``severity``, ``grade``, ``toxic``."""
    rest = [c for c in docs.columns if c not in ("text", "severity", "grade", "toxic")]
    shared = docs.sparkSession.sparkContext.broadcast((weights, cuts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known, at = shared.value
            scores = np.array([known[p[:-1]].sum() for p in features(batch["text"].tolist(), 1)])
            over = sigmoid(scores[:, None] - at[None, :])
            out = batch[rest].copy()
            out["severity"] = over.sum(axis=1)
            out["grade"] = (over >= 0.5).sum(axis=1).astype(np.int32)
            out["toxic"] = out["severity"] >= toxic
            yield out

    kept = docs.select(*rest, "text")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema if f.name != "text")
    return kept.mapInPandas(run, f"{schema}severity double, grade int, toxic boolean")
