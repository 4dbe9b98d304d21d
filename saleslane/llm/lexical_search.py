"""Ranked lexical search in norm buckets: texts in order of the length of their impact vectors.

A text is a vector of impacts over the terms of the queries, scaled by the root of the terms' weights.
The table of vectors is put in order of length. A bucket of texts whose greatest length cannot reach
a query's threshold is passed over (Cauchy-Schwarz); inside a bucket only texts that hold one of the
coordinates needed for the threshold are looked at, and those whose partial score and bound on the
rest reach it are scored exactly in integers. The longest texts go first, to set the thresholds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from saleslane.llm.shared import payload, stored

BEST = 10
# Fixed values of the score: weights in thousandths, impacts in parts of a million, and the share of
# a text's length in its damping.
WEIGHT_SCALE, IMPACT_SCALE, TERM_SCALE = 1000, 1_000_000_000, 1000
LENGTH_SHARE, DAMPING = 75, 8

# Pairs of query and term in one block of queries, which is sent to all tasks: some 10 MB at most,
# but for a single query with more terms. More queries make more blocks, each a pass over the texts.
QUERY_TERMS = 200_000
BUCKET_DOCS = 4096
# The longest 1 / FIRST_SHARE of the texts set the thresholds for the rest.
FIRST_SHARE = 64
# Bounds in doubles are this much too high, far more than their rounding.
MARGIN = 1 + 1e-9
TEXT_BYTES = 4 * 1024**2

COUNTED = "doc_id long, n long, terms array<int>, tfs array<int>"
IMPACTS = "doc_id long, length double, terms array<int>, impacts array<int>"
HITS = "item long, item_id long, doc_id long, score long"


def _letters() -> bytes:
    """What becomes of every byte: A-Z lower-cased, other ASCII but letters and digits a space."""
    kept = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
    table = bytearray(b if b in kept else 0x20 for b in range(256))
    table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(table)


LETTERS = _letters()


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a few MB of it at a time."""
    text, at = text.translate(LETTERS), 0
    while at < len(text):
        end = text.find(b" ", at + TEXT_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[dict[bytes, int]] = []
        for text in batch["text"]:
            of: dict[bytes, int] = {}
            for part in terms_of(text.as_py()):
                for term in part:
                    of[term] = of.get(term, 0) + 1
            counts.append(of)
        yield pa.record_batch(
            {
                "item": batch["item"],
                "item_id": batch["item_id"],
                "terms": pa.array([list(of) for of in counts], pa.list_(pa.binary())),
                "counts": pa.array([list(of.values()) for of in counts], pa.list_(pa.int64())),
            }
        )


@dataclass
class Queries:
    """A block of queries: their terms, numbered, and how often each holds them."""

    rows: list[Row]
    numbers: dict[bytes, int] = field(init=False)
    terms: list[np.ndarray] = field(init=False)
    counts: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        names = sorted({bytes(term) for row in self.rows for term in row["terms"]})
        self.numbers = {term: number for number, term in enumerate(names)}
        self.terms = [
            np.array([self.numbers[bytes(term)] for term in row["terms"]], np.int64) for row in self.rows
        ]
        self.counts = [np.array(row["counts"], np.int64) for row in self.rows]


def _counter(numbers: dict[bytes, int]) -> Callable:
    """Counts the words of every text, and the occurrences of the numbered terms in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.get
        for batch in batches:
            words, terms, tfs = [], [], []
            for text in batch["text"]:
                n, found = 0, []
                for part in terms_of(text.as_py()):
                    n += len(part)
                    found += [number for term in part if (number := get(term)) is not None]
                held, often = np.unique(np.array(found, np.int32), return_counts=True)
                words.append(n)
                terms.append(held)
                tfs.append(often.astype(np.int32))
            made = {"doc_id": batch["doc_id"], "n": pa.array(words, pa.int64())}
            made |= {"terms": _lists(terms), "tfs": _lists(tfs)}
            made = pa.record_batch(made)
            yield made.filter(pc.greater(made["n"], 0))

    return count


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate([*rows, np.array([], np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values of all lists, the row of each)."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64), np.repeat(np.arange(len(column)), lengths)


def damping(words: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of every text: 100 for one of average length."""
    if LENGTH_SHARE * documents * int(words.max(initial=0)) >= 2**63:
        shares = [LENGTH_SHARE * int(n) * documents // total for n in words]
        return 100 - LENGTH_SHARE + np.array(shares, np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * words * documents // total


def _impacts(documents: int, total: int, weights: np.ndarray) -> Callable:
    """Impacts of the terms of every text, and the length of the vector they make."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, row = _flat(batch["terms"])
            tfs, _ = _flat(batch["tfs"])
            m = damping(batch["n"].to_numpy(), documents, total)
            impacts = IMPACT_SCALE * tfs // (TERM_SCALE * tfs + DAMPING * m[row])
            squares = np.bincount(row, weights[terms] * impacts.astype(float) ** 2, batch.num_rows)
            ends = pa.array(batch["terms"].offsets.to_numpy() - batch["terms"].offsets[0].as_py(), pa.int32())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "length": pa.array(np.sqrt(squares)),
                    "terms": batch["terms"],
                    "impacts": pa.ListArray.from_arrays(ends, pa.array(impacts.astype(np.int32))),
                }
            )

    return vectors


class Bucket:
    """Some texts of similar length, by text and by term."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
        table = table.combine_chunks()
        ids = table["doc_id"]
        self.known = ids.is_valid().to_numpy()
        self.doc_ids = ids.fill_null(0).to_numpy()
        self.lengths = table["length"].to_numpy()
        self.terms, self.rows = _flat(table["terms"].chunk(0))
        self.impacts, _ = _flat(table["impacts"].chunk(0))
        self.size = len(self.doc_ids)
        self.starts = np.searchsorted(self.rows, np.arange(self.size + 1))
        order = np.argsort(self.terms, kind="stable")
        self.posting_rows, self.posting_impacts = self.rows[order], self.impacts[order]
        self.held, first = np.unique(self.terms[order], return_index=True)
        self.ends = np.append(first, len(order))
        self.top = np.maximum.reduceat(self.posting_impacts, first) if len(order) else self.impacts
        self.longest = self.lengths.max(initial=0) * MARGIN

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms some text holds, and where their postings are."""
        if not len(self.held):
            return np.zeros(len(terms), bool), terms[:0]
        at = np.minimum(np.searchsorted(self.held, terms), len(self.held) - 1)
        here = self.held[at] == terms
        return here, at[here]

    def exact(self, chosen: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """The scores of the chosen texts, in integers."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[chosen] - (ends - sizes), sizes) + np.arange(sizes.sum())
        parts = weight_of[self.terms[places]] * self.impacts[places]
        return np.add.reduceat(parts, ends - sizes)


class Search:
    """The best texts of every query of a block, among those it is shown."""

    def __init__(self, queries: Queries, weights: np.ndarray, most: int, thresholds: np.ndarray):
        self.queries, self.most = queries, most
        self.weights = [weights[t] * c for t, c in zip(queries.terms, queries.counts, strict=True)]
        roots = [np.sqrt(weights[t].astype(float)) for t in queries.terms]
        # a query's own vector: how often it holds a term, scaled as the texts are
        self.parts = [r * c for r, c in zip(roots, queries.counts, strict=True)]
        self.lengths = np.array([math.sqrt((p**2).sum()) for p in self.parts])
        # a text must have at least this score, or come before another one that has it
        self.least = np.maximum(thresholds, 1)
        self.weight_of = np.zeros(len(weights), np.int64)
        empty = np.zeros(0, np.int64)
        self.best = [(empty, empty, empty.astype(bool)) for _ in queries.rows]

    def show(self, bucket: Bucket) -> None:
        for query in np.flatnonzero(bucket.longest * self.lengths >= self.least):
            scores, chosen = self.scored(bucket, query)
            if len(chosen):
                self.take(query, scores, bucket.doc_ids[chosen], bucket.known[chosen])

    def scored(self, bucket: Bucket, query: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the texts that may reach the query's threshold, and their places."""
        least = self.least[query]
        terms, weights, parts = self.queries.terms[query], self.weights[query], self.parts[query]
        here, at = bucket.find(terms)
        most = weights[here] * bucket.top[at]  # what a coordinate can add to a score
        order = np.argsort(-most, kind="stable")
        rest = np.append(np.cumsum(most[order][::-1])[::-1], 0)  # of the coordinates from here on
        if rest[0] < least:
            return rest[:0], rest[:0]
        # without a coordinate of the focus a text stays below the threshold
        focus = int(np.argmax(rest < least)) if rest[-1] < least else len(order)
        partial = np.zeros(bucket.size, np.int64)
        for k in order[:focus]:
            postings = slice(bucket.ends[at[k]], bucket.ends[at[k] + 1])
            partial[bucket.posting_rows[postings]] += weights[here][k] * bucket.posting_impacts[postings]
        others = math.sqrt((parts[here][order[focus:]] ** 2).sum()) * MARGIN
        bound = partial + np.minimum(float(rest[focus]), others * bucket.lengths)
        chosen = np.flatnonzero((partial > 0) & (bound * MARGIN >= least))
        if not len(chosen):
            return partial[:0], chosen
        self.weight_of[terms] = weights
        scores = bucket.exact(chosen, self.weight_of)
        self.weight_of[terms] = 0
        reached = scores >= least
        return scores[reached], chosen[reached]

    def take(self, query: int, scores: np.ndarray, doc_ids: np.ndarray, known: np.ndarray) -> None:
        """Keep the best of old and new; with enough of them the last sets the threshold."""
        lists = [np.concatenate(x) for x in zip(self.best[query], (scores, doc_ids, known), strict=True)]
        order = np.lexsort((lists[1], ~lists[2], -lists[0]))[: self.most]
        self.best[query] = tuple(x[order] for x in lists)
        if len(order) == self.most:
            self.least[query] = max(self.least[query], lists[0][order[-1]])

    def hits(self) -> pa.RecordBatch:
        sizes = [len(scores) for scores, _, _ in self.best]
        scores, doc_ids, known = (np.concatenate([b[i] for b in self.best]) for i in range(3))
        place = np.repeat(np.arange(len(sizes)), sizes)
        items, item_ids = ([row[name] for row in self.queries.rows] for name in ("item", "item_id"))
        return pa.record_batch(
            {
                "item": pa.array(items, pa.int64()).take(pa.array(place)),
                "item_id": pa.array(item_ids, pa.int64()).take(pa.array(place)),
                "doc_id": pa.array(doc_ids, pa.int64(), mask=~known),
                "score": pa.array(scores, pa.int64()),
            }
        )


def _searcher(queries: Queries, weights: np.ndarray, most: int, thresholds: np.ndarray) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(queries, weights, most, thresholds.copy())
        for batch in batches:  # in order of length, as the files are
            for at in range(0, batch.num_rows, BUCKET_DOCS):
                found.show(Bucket(batch.slice(at, BUCKET_DOCS)))
        yield found.hits()

    return search


def _ranked(hits: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _searched(docs: DataFrame, queries: Queries, most: int) -> DataFrame:
    """The ranked hits of one block of queries."""
    counted = stored(docs.mapInArrow(_counter(queries.numbers), COUNTED), "counted")
    documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(queries.numbers), np.int64)
    # one row for each term of the block
    terms = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    held[[row["term"] for row in terms]] = [row["count"] for row in terms]
    weights = np.array(
        [math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()],
        np.int64,
    )
    held_docs = counted.where(F.size("terms") > 0)
    vectors = held_docs.mapInArrow(_impacts(documents, total, weights), IMPACTS)
    # equal lengths, as of copies, are dealt out by a running number
    ordered = stored(
        vectors.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(F.desc("length"), "tie")
        .sortWithinPartitions(F.desc("length"))
        .drop("tie"),
        "by-length",
    )
    cut = ordered.agg(F.percentile_approx("length", 1 - 1 / FIRST_SHARE)).first()[0]
    thresholds = np.zeros(len(queries.rows), np.int64)
    if cut is None:
        return ordered.mapInArrow(_searcher(queries, weights, most, thresholds), HITS)
    longest = ordered.where(F.col("length") >= cut)
    first = stored(
        _ranked(longest.mapInArrow(_searcher(queries, weights, most, thresholds), HITS), most), "first-hits"
    )
    place = {row["item"]: i for i, row in enumerate(queries.rows)}
    for item, score in first.where(F.col("rank") == most).select("item", "score").collect():
        thresholds[place[item]] = score
    lengths = Search(queries, weights, most, thresholds).lengths
    # texts too short for any query are not even read
    needed = min((t / (n * MARGIN) / MARGIN for t, n in zip(thresholds, lengths, strict=True) if n), default=0.0)
    shorter = ordered.where((F.col("length") < cut) & (F.col("length") >= float(needed)))
    others = shorter.mapInArrow(_searcher(queries, weights, most, thresholds), HITS)
    return first.drop("rank").unionByName(others)


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best texts of every item, best first.

    Only scores above 0 count; equal scores are in order of the id, a text without an id last. Fewer
    texts give a shorter list, and an item without a term none, as a null or empty one. Null and empty
    texts take no part and are not counted. Repeated rows are texts and items of their own, ranked one
    after the other; texts of any length are read whole. Empty tables give an empty table, and other
    columns are ignored.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), payload(f"`{text_col}`").alias("text"))
    asked = stored(
        items.select(
            F.monotonically_increasing_id().alias("item"),
            F.col(f"`{item_col}`").cast("long").alias("item_id"),
            payload(f"`{item_text_col}`").alias("text"),
        )
        .mapInArrow(_item_terms, "item long, item_id long, terms array<binary>, counts array<long>")
        .where(F.size("terms") > 0),
        "items",
    )
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // QUERY_TERMS)
    hits = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item")
        found = _searched(slim, Queries(mine.collect()), most)  # bounded by QUERY_TERMS
        hits.append(_ranked(found, most) if blocks == 1 else stored(_ranked(found, most), "hits"))
    nothing = docs.sparkSession.createDataFrame([], f"{HITS}, rank int")
    ranked = reduce(DataFrame.unionByName, hits) if hits else nothing
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
