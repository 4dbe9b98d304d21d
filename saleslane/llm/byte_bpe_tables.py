"""Tables of encoded texts, and their digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslane.llm.byte_bpe import encoder, in_parts
from saleslane.llm.shared import payload

ENCODED = "doc_id long, ids array<int>, offsets array<long>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, offsets) of every row: the tokens, and the byte at which each begins.

    A null text is an empty one and has no tokens. Bytes that are no UTF-8 count as U+FFFD. Repeated
    rows and null ids are encoded like others, an empty table gives an empty table, and other
    columns are ignored. Nothing is shuffled; a text is encoded whole, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_parts(batches, "text"):
            made = encoder(path).encode(texts)
            yield pa.record_batch(
                {
                    "doc_id": part["doc_id"],
                    "ids": pa.array([x.ids.astype("int32") for x in made], pa.list_(pa.int32())),
                    "offsets": pa.array([x.offsets for x in made], pa.list_(pa.int64())),
                }
            )

    return _slim(docs, id_col, text_col).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of what `encode` returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                encoder(path).decode(ids.values.to_numpy(), at.values.to_numpy())
                for ids, at in zip(batch["ids"], batch["offsets"], strict=True)
            ]
            yield pa.record_batch({"doc_id": batch["doc_id"], "text": pa.array(texts, pa.binary())})

    decoded = encoded.mapInArrow(run, "doc_id long, text binary")
    return decoded.select("doc_id", F.col("text").cast("string"))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): `encode` and `decode` of every row, as digests.

    Ids are written in decimals joined by a space. Both steps run in one pass, as the tokens
    themselves are four times as large as the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for part, texts in in_parts(batches, "text"):
            made = encoder(path).encode(texts)
            yield pa.record_batch(
                {
                    "doc_id": part["doc_id"],
                    "n_tokens": pa.array([len(x.ids) for x in made], pa.int64()),
                    "ids_sha256": [sha(x.decimals.encode()) for x in made],
                    "decoded_sha256": [sha(encoder(path).decode(x.ids, x.offsets)) for x in made],
                }
            )

    return _slim(docs, id_col, text_col).mapInArrow(run, DIGESTS)
