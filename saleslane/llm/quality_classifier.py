"""Text quality by positive-unlabelled learning.

The model is linear in ranges of a few measures of the whole text. It learns from trusted good texts
and unlabelled ones; the share of good texts among the unlabelled is estimated from both.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.labelled import held_out, training_sample
from saleslane.llm.nnpu import Linear, class_prior, refined_prior, sigmoid, train
from saleslane.llm.shared import payload

# Bounds of what the model is fitted on; scoring reads every document.
POSITIVES = 6000
UNLABELLED = 12000
LEAST_SCORE = 0.3
# Where a measure is split: finely at both ends, where bad texts are.
SHARES = (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.3, 0.5, 0.7, 0.85, 0.9, 0.94, 0.97, 0.99)
RANGES = len(SHARES) + 1
# The first model takes this part of the bound that single ranges give.
START = 0.7
LEARNING = {"loss": "sigmoid", "rounds": 400, "decay": 1e-4}

LETTER, CAPITAL, DIGIT, MARK, SYMBOL, STOP, BANG = range(1, 8)
MEASURES = (
    "capitals", "digits", "marks", "symbols", "stops", "bangs", "adjacent", "distinct",
    "word_length", "repeated_lines", "log_words",
)


@cache
def kinds() -> np.ndarray:
    """The kind of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = CAPITAL if char.isupper() else LETTER
        elif char.isdigit():
            table[point] = DIGIT
        elif char.isprintable() and not char.isspace():
            table[point] = SYMBOL
    for char in ".,":
        table[ord(char)] = STOP
    for char in ";:?-'\"()":
        table[ord(char)] = MARK
    table[ord("!")] = BANG
    return table


def measures(text: str) -> list[float]:
    """MEASURES of a text; an empty text has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(MEASURES)
    count = len(words)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    of = np.bincount(kinds()[points], minlength=8)
    letters = max(1, int(of[LETTER] + of[CAPITAL]))
    lines = [line for line in text.split("\n") if line.strip()]
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        of[CAPITAL] / letters,
        of[DIGIT] / count,
        of[MARK] / count,
        of[SYMBOL] / count,
        of[STOP] / count,
        of[BANG] / count,
        same / count,
        math.log(1 + len(set(words))) / math.log(1 + count),  # falls slowly with length
        letters / count,
        1 - len(set(lines)) / len(lines),
        math.log(count),
    ]


def ranged(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0/1 features: for each measure the range between ``edges`` that its value lies in."""
    rows, width = values.shape
    out = np.zeros((rows, width * RANGES), np.uint8)
    for column in range(width):
        place = np.searchsorted(edges[column], values[:, column], side="right")
        out[np.arange(rows), column * RANGES + place] = 1
    return out


@dataclass
class Model:
    edges: np.ndarray
    linear: Linear
    prior: float

    def score(self, texts: Iterable[str]) -> np.ndarray:
        values = np.array([measures(text) for text in texts]).reshape(-1, len(MEASURES))
        return sigmoid(self.linear.decision(ranged(values, self.edges)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from at most POSITIVES and UNLABELLED texts outside the held-out fold.

    Without any trusted text nothing is known to be bad, and all scores are 0.5.
    """
    sample = training_sample(docs, labels, label, POSITIVES, UNLABELLED)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(text or "") for text in batch["text"].to_pylist()]
            lists = pa.array(rows, pa.list_(pa.float64()))
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "positive": batch["positive"], "values": lists}
            )

    # a dozen numbers for each text of the bounded sample
    rows = (
        sample.mapInArrow(measured, "doc_id long, positive boolean, values array<double>")
        .orderBy("positive", "doc_id")
        .collect()
    )
    values = np.array([row["values"] for row in rows], np.float64).reshape(-1, len(MEASURES))
    positive = np.array([row["positive"] for row in rows], bool)
    edges = np.zeros((len(MEASURES), RANGES - 1))
    if not positive.any() or positive.all():
        return Model(edges, Linear(np.zeros(len(MEASURES) * RANGES, np.float32), 0.0), 1.0)
    edges = np.quantile(values[~positive], SHARES, axis=0).T
    p, u = ranged(values[positive], edges), ranged(values[~positive], edges)
    prior = refined_prior(p, u, START * class_prior(p, u), **LEARNING)
    return Model(edges, train(p, u, prior, **LEARNING), prior)


def score_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of every whole text, 0 to 1; a null text is an empty one and has a score too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # one text at a time, as a batch of long ones is large
            yield pd.Series(shared.value.score(bytes(x).decode("utf-8", "replace") for x in texts))

    return of(payload(text))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; predicted is 1 from LEAST_SCORE on.

    Repeated rows, null ids, and null, empty and very long texts are scored like others, by their whole text
    alone; an empty table gives an empty table. Other columns are ignored.
    """
    model = fit(docs, labels, label)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        score_column(docs, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
