"""Substring dedup by recompression: long repeats are found by the symbols that they share.

1. Every task names the words of its documents (see `recompression`); the windows of a document are
   grouped into blocks by the symbol that each window chooses.
2. One aggregate over the symbols' keys tells which of them occur in several documents, and whether
   always in the same words; only blocks of such symbols go on.
3. Where the words of a block are equal in a document with a smaller id, all its windows are repeats.
   Where a symbol has several surroundings, the first document of each compares its windows one by one.
4. Words under a repeated window are cut. The texts are shuffled once, and those whose windows had
   to be compared a second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslane.llm.recompression import Hashes, blocks_of, words_of
from saleslane.llm.shared import payload, stored

WINDOW = 50
BATCH_BYTES = 1024**2
# A row is known by its id and the hash of its text, as ids may be repeated.
ROW = ["doc_id", "mark"]
BLOCKS = "doc_id long, mark long, key long, content long, first int, count int"
WINDOWS = "doc_id long, mark long, key long, content long, first int"


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BATCH_BYTES of text each; a text is never cut."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    edges = [0, *(np.flatnonzero(np.diff(sizes // BATCH_BYTES)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """BLOCKS of every row of ``docs`` (doc_id, mark, text as bytes); places count words from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                words = words_of(part["text"].to_pylist())
                made = blocks_of(words, Hashes(words.names), size)
                yield pa.record_batch(
                    {
                        **{name: part[name].take(pa.array(made.text)) for name in ROW},
                        "key": made.key.view(np.int64),
                        "content": made.content.view(np.int64),
                        "first": made.first.astype(np.int32),
                        "count": made.count.astype(np.int32),
                    }
                )

    return docs.mapInArrow(run, BLOCKS)


def windows(open_blocks: DataFrame, size: int) -> DataFrame:
    """WINDOWS of the blocks in ``opened`` of every row (doc_id, mark, text, opened)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                words = words_of(part["text"].to_pylist())
                lists = part["opened"]
                rows = lists.flatten()
                text = np.repeat(np.arange(len(part)), pc.list_value_length(lists).to_numpy())
                first, count, key = (
                    rows.field(name).to_numpy(zero_copy_only=False)
                    for name in ("first", "count", "key")
                )
                text, key, at = (np.repeat(x, count) for x in (text, key, first))
                at = at + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                begin = words.offsets[text] + at
                content = Hashes(words.names).of(begin, begin + size)
                yield pa.record_batch(
                    {
                        **{name: part[name].take(pa.array(text)) for name in ROW},
                        "key": key,
                        "content": content.view(np.int64),
                        "first": at.astype(np.int32),
                    }
                )

    return open_blocks.mapInArrow(run, WINDOWS)


def cut(text: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Number of words, number of words under the stretches, and the other words joined by a space."""
    words = text.split()
    under = np.zeros(len(words) + 1, np.int64)
    np.add.at(under, np.minimum(begins, len(words)), 1)
    np.add.at(under, np.minimum(ends, len(words)), -1)
    removed = np.cumsum(under[:-1]) > 0
    kept = [word for word, gone in zip(words, removed, strict=True) if not gone]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _cut_column(text: str, begins: Column, ends: Column) -> Column:
    @F.pandas_udf("n_words long, n_removed long, kept binary")
    def cut_all(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = [
            cut(bytes(t), np.asarray(a, np.int64), np.asarray(b, np.int64))
            for t, a, b in zip(texts, begins, ends, strict=True)
        ]
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return cut_all(text, begins, ends)


def deduplicated(
    docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(_row, _id, _text, n_words, n_removed, kept) of every row of ``docs``.

    ``_row`` holds all columns but the text, which is ``_text`` in bytes. A word goes if it lies in a
    window of ``size`` words that also begins in a document with a smaller id. Windows are judged on
    the texts as they came in. ``kept`` has the other words, joined by one space. A null text has no words; texts shorter
    than a window lose nothing, and a text of any length is read whole. An empty table gives an empty table. Rows without an id
    have no smaller or larger one: they lose nothing and nothing is lost to them. Rows that repeat an
    id are judged one by one and lose nothing to one another.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        payload(text_col).alias("_text"),
    )
    rows = rows.withColumn("_mark", F.xxhash64("_text"))
    names = [
        F.col(old).alias(new)
        for old, new in (("_id", "doc_id"), ("_mark", "mark"), ("_text", "text"))
    ]
    named = rows.where(F.col("_id").isNotNull()).select(*names)
    every = stored(blocks(named, size), "blocks")
    shared = stored(_shared(every), "shared")
    same_row = (F.col("_id") == F.col("doc_id")) & (F.col("_mark") == F.col("mark"))
    found = _per_document(shared, size)
    marked = stored(rows.join(found, same_row, "left").drop(*ROW), "marked")
    is_open = F.coalesce(F.size("opened"), F.lit(0)) > 0
    found = _repeated_windows(marked.where(is_open).select(*names, "opened"), size)
    compared = marked.where(is_open).join(found, same_row, "left").drop(*ROW)
    others = marked.where(~is_open).withColumn("windows", F.lit(None).cast("array<int>"))
    all_rows = others.unionByName(compared)
    spans = F.coalesce("spans", F.array().cast("array<struct<begin:int,end:int>>"))
    own = F.coalesce("windows", F.array().cast("array<int>"))
    made = _cut_column(
        "_text",
        F.concat(spans["begin"], own),
        F.concat(spans["end"], F.transform(own, lambda at: at + size)),
    )
    return all_rows.withColumn("_cut", made).select("_row", "_id", "_text", "_cut.*")


def _shared(every: DataFrame) -> DataFrame:
    """(doc_id, mark, first, count, key, opened) of blocks that are repeats, or that may hold some.

    ``opened`` blocks are to be compared window by window; the others are repeats as a whole.
    """
    keys = (
        every.groupBy("key")
        .agg(
            F.min("doc_id").alias("owner"),
            F.max("doc_id").alias("_last"),
            (F.min("content") != F.max("content")).alias("differs"),
        )
        .where(F.col("owner") < F.col("_last"))
        .drop("_last")
    )
    of_use = F.col("differs") | (F.col("doc_id") > F.col("owner"))
    # Stored, so that the join meets two plain shuffles and can split the rows of a hot key.
    keys = stored(keys, "keys")
    met = stored(every.join(keys, "key").where(of_use), "met")
    whole = met.where(~F.col("differs")).withColumn("opened", F.lit(False))
    several = met.where(F.col("differs")).drop("owner")
    owners = stored(several.groupBy("key", "content").agg(F.min("doc_id").alias("owner")), "owners")
    opened = several.join(owners, ["key", "content"]).withColumn(
        "opened", F.col("doc_id") == F.col("owner")
    )
    columns = [*ROW, "first", "count", "key", "opened"]
    return whole.select(*columns).unionByName(opened.select(*columns))


def _per_document(shared: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark, spans, opened): no more for a document than it has blocks."""
    span = F.struct(
        F.col("first").alias("begin"), (F.col("first") + F.col("count") + (size - 1)).alias("end")
    )
    return shared.groupBy(*ROW).agg(
        F.collect_set(F.when(~F.col("opened"), span)).alias("spans"),
        F.collect_set(F.when(F.col("opened"), F.struct("first", "count", "key"))).alias("opened"),
    )


def _repeated_windows(open_blocks: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark, windows): first words of windows that begin in a smaller document too."""
    every = stored(windows(open_blocks, size), "windows")
    owners = (
        every.groupBy("key", "content")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last"))
        .where(F.col("owner") < F.col("_last"))
        .drop("_last")
    )
    owners = stored(owners, "owners")
    return (
        every.join(owners, ["key", "content"])
        .where(F.col("doc_id") > F.col("owner"))
        .groupBy(*ROW)
        .agg(F.collect_set("first").alias("windows"))
    )


def digests(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; see `deduplicated`."""
    made = deduplicated(docs, size)
    return made.select(
        F.col("_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
