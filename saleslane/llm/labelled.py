"""Which rows a classifier may learn from, and bounded samples of them."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.shared import stored

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32(doc_id as text) is divisible by FOLDS; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == 0, F.lit(False))


def _first_by_hash(
    ids: DataFrame, most: int, salt: int, kept: Callable[[DataFrame], DataFrame] = lambda found: found
) -> DataFrame:
    """Up to ``most`` distinct ids, the same ones each time: the first by a hash among those ``kept`` keeps.

    Only ids below a threshold of the hash, which follows from the number of rows, go through a
    shuffle: some more than ``most`` in all, from however many tasks. Repeated ids may leave too few
    below it; then it is raised.
    """
    mark = F.xxhash64(F.lit(salt), "doc_id")
    rows = max(1, ids.count())
    share = (most + 6 * math.sqrt(most)) / rows
    while True:
        edge = min(2**63 - 1, int((share - 0.5) * 2**64))
        found = stored(kept(ids.where(mark <= edge).distinct()), "below")
        if share >= 1 or found.count() >= most:
            return found.orderBy(mark, "doc_id").limit(most)
        share *= 4


def without_copies(sample: DataFrame) -> DataFrame:
    """One row of each group of copies, exact or with a few edits, among the rows of one label.

    Texts are told apart by the least hash of five words in a row; the words of a text that is there many
    times would look as if many texts had them.
    """
    words = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    places = F.sequence(F.lit(1), F.greatest(F.size("_words") - 4, F.lit(1)))
    least = F.array_min(F.transform(places, lambda i: F.xxhash64(F.slice("_words", i, 5))))
    grouped = sample.withColumn("_words", words).groupBy("positive", F.coalesce(least, F.lit(0)).alias("_least"))
    return grouped.agg(F.min(F.struct("doc_id", "text")).alias("first")).select("first.*", "positive")


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, positives: int, unlabelled: int
) -> DataFrame:
    """(doc_id, text, positive): confirmed positives, and texts taken without looking at labels.

    At most ``positives`` rows outside the held-out fold are labelled 1, and at most ``unlabelled``
    documents outside it stand for the whole. A document that is labelled more than once counts as
    positive if any label is 1; of repeated ids one text is taken. Null ids are left out.
    """
    usable = F.col("doc_id").isNotNull() & ~held_out()
    confirmed = labels.where(usable & (F.col(label) == 1)).select("doc_id")
    # labels without a document do not count; the list of ids is bounded by its threshold
    with_document = lambda found: (
        docs.select("doc_id").join(F.broadcast(found), "doc_id", "left_semi").distinct()
    )
    chosen = _first_by_hash(confirmed, positives, 1, with_document).withColumn("positive", F.lit(True))
    others = _first_by_hash(docs.where(usable).select("doc_id"), unlabelled, 2)
    ids = chosen.unionByName(others.withColumn("positive", F.lit(False)))
    # at most positives + unlabelled ids of 9 bytes: a bounded broadcast
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id")
    kept = rows.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
    return stored(kept, f"sample-{label}")
