"""Toxicity by non-negative positive-unlabelled learning.

The model is linear in words and beginnings of words. It learns from confirmed toxic texts and from
texts of unknown label, with a risk that is corrected for the share of toxic texts among those.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.labelled import held_out, training_sample, without_copies
from saleslane.llm.nnpu import Linear, sigmoid, train
from saleslane.llm.shared import payload, stored

# Bounds of what the model is fitted on; scoring reads every document.
POSITIVES = 2000
UNLABELLED = 4000
VOCABULARY = 512
PREFIXES = (3, 4, 5)
LEAST_POSITIVES = 4
LEAST_SHARE = 0.01
# In standard errors; by chance none of a hundred thousand features lies so far off.
LEAST_LIFT = 5.0
# The ratios of features this frequent among positives bound the share of positives among all. Those up to
# so many times the least count; the least alone is low by chance.
FREQUENT = 0.05
NEAR_LEAST = 2.0
# Standard errors by which a mark may be more frequent among all than among the positives in it.
MARK_ERRORS = 1.5

WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """The distinct words of a text in lower case, and with a mark their first letters."""
    words = set(WORD.findall(text.lower()))
    found = set(words)
    for length in PREFIXES:
        found.update(["^" + word[:length] for word in words if len(word) >= length])
    return found


@dataclass
class Model:
    """``place`` is the number of a feature."""

    place: dict[str, int]
    linear: Linear
    prior: float

    def score(self, texts: Iterable[str]) -> np.ndarray:
        weights = dict(zip(self.place, self.linear.weights.tolist(), strict=True))
        names = weights.keys()
        known = (sum(map(weights.__getitem__, names & features_of(text))) for text in texts)
        return sigmoid(np.fromiter(known, np.float64) + self.linear.bias)


def vocabulary(sample: DataFrame, most: int = VOCABULARY) -> tuple[list[str], float]:
    """Marks, the features that only positives have, counted in Spark; and the share of positives.

    No feature is rarer among all than the share of positives allows, and marks come near to that bound.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("text", "positive"))
            for text, positive in zip(*columns, strict=True):
                counts[positive].update(features_of(text or ""))
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.record_batch(
            {
                "feature": pa.array(names, pa.string()),
                "positives": pa.array([counts[1][x] for x in names], pa.int64()),
                "others": pa.array([counts[0][x] for x in names], pa.int64()),
            }
        )

    sizes = dict(sample.groupBy("positive").count().collect())
    of_p, of_u = max(1, sizes.get(True, 0)), max(1, sizes.get(False, 0))
    counted = sample.mapInArrow(count, "feature string, positives long, others long")
    p, u = F.sum("positives"), F.sum("others")
    # how far the share among positives lies above that among all, in standard errors of chance
    pooled = (p + u) / (of_p + of_u)
    error = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(0.0)) * (1 / of_p + 1 / of_u))
    rows = (
        counted.groupBy("feature")
        .agg(p.alias("positives"), u.alias("others"), ((p / of_p - u / of_u) / error).alias("lift"))
        .where(
            (F.col("positives") >= max(LEAST_POSITIVES, LEAST_SHARE * of_p))
            & (F.col("lift") >= LEAST_LIFT)
        )
        .orderBy(F.col("lift").desc(), "feature")
        .limit(most)
        .collect()
    )
    found = np.array([(row["positives"], row["others"]) for row in rows], float).reshape(-1, 2)
    share_p, share_u = found[:, 0] / of_p, (found[:, 1] + 1) / of_u
    ratio = np.where(share_p >= FREQUENT, share_u / np.maximum(share_p, 1e-9), np.inf)
    order = np.argsort(ratio, kind="stable")
    order = order[ratio[order] <= NEAR_LEAST * ratio.min(initial=1.0)]
    # the median of the ratios, where a feature counts as often as positives have it
    weight = np.cumsum(share_p[order])
    prior = ratio[order][np.searchsorted(weight, weight[-1] / 2)] if len(order) else 1.0
    expected = prior * share_p * of_u
    error = np.sqrt(expected + expected**2 / np.maximum(found[:, 0], 1))
    marks = found[:, 1] <= expected + MARK_ERRORS * error
    features = [row["feature"] for row, mark in zip(rows, marks, strict=True) if mark]
    return features, float(np.clip(prior, 0.01, 0.99))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learn from at most POSITIVES and UNLABELLED texts outside the held-out fold, copies counted once.

    Without any positive text, or any mark, all scores are below 0.5.
    """
    sample = training_sample(docs, labels, label, POSITIVES, UNLABELLED)
    sample = stored(without_copies(sample), "sample")
    features, prior = vocabulary(sample)
    place = {feature: i for i, feature in enumerate(features)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted(place[x] for x in place.keys() & features_of(text or ""))
                for text in batch["text"].to_pylist()
            ]
            lists = pa.array(found, pa.list_(pa.int32()))
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "positive": batch["positive"], "places": lists}
            )

    # one row of at most VOCABULARY numbers for each text of the bounded sample
    rows = (
        sample.mapInArrow(places, "doc_id long, positive boolean, places array<int>")
        .orderBy("positive", "doc_id")
        .collect()
    )
    matrix = np.zeros((len(rows), len(place)), np.uint8)
    for i, row in enumerate(rows):
        matrix[i, row["places"]] = 1
    positive = np.array([row["positive"] for row in rows], bool)
    if not positive.any() or positive.all() or not place:
        return Model({}, Linear(np.zeros(0, np.float32), -1.0), 0.0)
    return Model(place, train(matrix[positive], matrix[~positive], prior), prior)


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of every whole text, 0 to 1; a null text is an empty one and has a score too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY features

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # one text at a time, as a batch of long ones is large
            yield pd.Series(shared.value.score(bytes(x).decode("utf-8", "replace") for x in texts))

    return of(payload(text))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Repeated rows, null ids, and null, empty and very long texts are scored like others, by their whole text
    alone; an empty table gives an empty table. Other columns are ignored.
    """
    model = fit(docs, labels, label)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        score_column(docs, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
