"""Harmonic packing: every piece has a reciprocal-capacity length, every bin a fixed count.

Documents are cut greedily into pieces of length ``capacity // k``. Pieces of one class have one
length, so a bin of the class takes a fixed number of them, and its place follows from a running
number alone. Each task numbers its own pieces and fills its own bins, without looking at others.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslane.llm.shared import payload, stored

CAPACITY = 4096
END_ID = 2
# Below this length every length is a class of its own: the loss of a bin stays under it.
SMALL = 64
WORDS_IN_CACHE = 1_200_000
JOINED = 50
BATCH_BYTES = 4 * 1024**2
# Names of sequences: task number + 1 and bin; length and bin across tasks; the tail.
BINS_PER_TASK = 2**40
BINS_PER_CLASS = 2**26
TAIL = 2**39

LONE_STOP = re.compile(r"([a-zß-öø-ÿ])([.,])(?=[ \n])")

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, "
    "part long, place long, sequence_id long, offset long"
)

PLACED = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def class_sizes(capacity: int = CAPACITY) -> list[int]:
    """Lengths of the classes, longest first: capacity // k, and all lengths below SMALL."""
    small = min(SMALL, capacity)
    sizes = {capacity // k for k in range(1, capacity // small + 1)} | set(range(1, small))
    return sorted(sizes, reverse=True)


@cache
def _cuts(capacity: int) -> np.ndarray:
    """For every length up to the capacity, the longest class that fits it."""
    fits = np.zeros(capacity + 1, np.int64)
    for size in class_sizes(capacity)[::-1]:
        fits[size:] = size
    return fits


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """The lengths of the pieces of a document: full bins first, then the largest class each time."""
    pieces = [capacity] * (length // capacity)
    rest, fits = length % capacity, _cuts(capacity)
    while rest:
        pieces.append(int(fits[rest]))
        rest -= pieces[-1]
    return pieces


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
    from tokenizers import Tokenizer

    if not splits_at_spaces(path):
        raise ValueError(f"{path} does not treat words apart")
    return Tokenizer.from_file(path)


def splits_at_spaces(path: str) -> bool:
    """Whether the vocabulary keeps only runs without white space, so that words stand alone."""
    with open(path) as file:
        spec = json.load(file)
    first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    kept_runs = first.get("behavior") == "Removed" and first.get("invert") is True
    apart = kept_runs and "[^\\s" in pattern and " " not in pattern
    return apart and not any(x["lstrip"] or x["rstrip"] for x in spec["added_tokens"])


def _words(text: str, added: list[str]) -> list[str]:
    """The text in parts that the vocabulary treats apart, in lower case where that folds alike.

    Besides white space, a part ends before a dot or comma that stands alone behind a letter.
    ``added`` are the added tokens in lower case.
    """
    # Left as they are: capital sigma, whose small form depends on its place, and dotted capital I,
    # whose small form is two characters; texts that compose otherwise once they are small (J and a
    # caron); and added tokens, which the library looks for before it makes letters small.
    odd = "\u03a3" in text or "\u0130" in text
    small = text.lower()
    folds = text.isascii() or (
        not odd and is_normalized("NFC", text) and is_normalized("NFC", small)
    )
    if folds and not any(token in small for token in added):
        text = small
    return LONE_STOP.sub(r"\1 \2", text).replace("\n", " ").split(" ")


def _is_plain(word: str) -> bool:
    """Letters that stay one run of letters however the vocabulary normalises them."""
    return word.isalpha() and word.lower().isalpha() and is_normalized("NFC", word)


class WordEncoder:
    """Ids of whole texts, word by word; words seen before come from a bounded cache."""

    def __init__(self, path: str, most: int = WORDS_IN_CACHE):
        self.tokenizer, self.most = _tokenizer(path), most
        vocabulary = self.tokenizer.get_vocab()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.lower() for token in added]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        lines = [_words(text, self.added) for text in texts]
        words = set().union(*lines)
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known = {"": b""}
            new = words - {""}
        plain = sorted(word for word in new if _is_plain(word))
        self._learn_plain(plain)
        others = list(new.difference(plain))
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        for word, made in zip(others, encoded, strict=True):
            self.known[word] = np.array(made.ids, "<u4").tobytes()
        known = self.known.__getitem__
        return [b"".join(map(known, line)) for line in lines]

    def _learn_plain(self, words: list[str]) -> None:
        """Many at once, which is faster: the last token of each run of letters ends a word."""
        for at in range(0, len(words), JOINED):
            part = words[at : at + JOINED]
            line = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(line[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(cuts) != len(part):
                raise ValueError("this vocabulary does not end every word with a token of its own")
            self.known.update(
                (word, raw[a:b]) for word, a, b in zip(part, [0, *cuts], cuts, strict=False)
            )


@cache
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenized(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list, list[bytes]]]:
    """Document ids and encoded texts, a bounded number of bytes at a time."""
    encoder = _encoder(path)
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch[1]).to_numpy(zero_copy_only=False))
        group = sizes // BATCH_BYTES
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            part = batch.slice(a, b - a)
            texts = [x.decode("utf-8", "replace") for x in part[1].to_pylist()]
            yield part[0].to_pylist(), encoder.encode(texts)


def pieces_of(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """PIECES of every document; what fills no bin within its task has no ``sequence_id``.

    For such pieces ``place`` is a running number within the task ``part`` and the length.
    """
    schema = _piece_schema()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        open_bins: dict[int, list[tuple]] = {}  # less than one bin of each class
        bins = 0
        rows: list[tuple] = []
        for doc_ids, encoded in tokenized(batches, tokenizer):
            for doc_id, ids in zip(doc_ids, encoded, strict=True):
                ids += end
                tokens, start = len(ids) // 4, 0
                for size in cut(tokens, capacity):
                    of = ids[4 * start : 4 * (start + size)]
                    waiting = open_bins.setdefault(size, [])
                    waiting.append((doc_id, start, size, tokens, of))
                    start += size
                    if len(waiting) == capacity // size:
                        name = (part + 1) * BINS_PER_TASK + bins
                        bins += 1
                        rows += [(*x, part, None, name, i * size) for i, x in enumerate(waiting)]
                        waiting.clear()
            yield _batch(rows, schema)
            rows = []
        for waiting in open_bins.values():
            rows += [(*x, part, i, None, None) for i, x in enumerate(waiting)]
        yield _batch(rows, schema)

    slim = docs.select(F.col(id_col).cast("long"), payload(text_col))
    return slim.mapInArrow(run, PIECES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)]
    return pa.record_batch(arrays, schema=schema)


def _piece_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in PIECES.split(", "))])


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is the end mark alone.
    Repeated rows are packed one by one, also under a null ``doc_id``; an empty table gives no piece.
    Columns other than the two are ignored.

    Bins that a task fills are final. What it has over, less than one bin of each class, is numbered
    on across tasks; what is then still over, less than one bin of each class of the whole table and
    so bounded by a constant, is laid end to end and cut at the capacity. Only the last sequence of
    that tail is shorter than the losses of the classes (capacity mod length) explain.
    """
    pieces = stored(pieces_of(docs, tokenizer, capacity, id_col, text_col), "pieces")
    in_bin = F.col("sequence_id").isNotNull()
    over = _placed_over(pieces.where(~in_bin), capacity)
    return pieces.where(in_bin).select(*PLACED).unionByName(over)


def _placed_over(over: DataFrame, capacity: int) -> DataFrame:
    """Bins across tasks for what the tasks have over, then the tail."""
    per_bin = F.floor(F.lit(capacity) / F.col("length"))
    by_part = Window.partitionBy("length").orderBy("part")
    numbered = over.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces"))
    numbered = numbered.select(
        "part",
        "length",
        (F.sum("pieces").over(by_part) - F.col("pieces")).alias("before"),
        F.sum("pieces").over(Window.partitionBy("length")).alias("all_pieces"),
    )
    placed = over.join(numbered, ["part", "length"])
    placed = placed.withColumn("number", F.col("before") + F.col("place"))
    number = F.col("number")
    placed = placed.withColumn("bin", F.floor(number / per_bin))
    full = F.col("bin") < F.floor(F.col("all_pieces") / per_bin)
    bins = placed.where(full).withColumns(
        {
            "sequence_id": F.col("length") * BINS_PER_CLASS + F.col("bin"),
            "offset": (number % per_bin) * F.col("length"),
        }
    )
    return bins.select(*PLACED).unionByName(_tail(placed.where(~full), capacity))


def _tail(pieces: DataFrame, capacity: int) -> DataFrame:
    """At most one open bin of each class, laid end to end in one task and cut at the capacity."""
    in_line = Window.orderBy(F.col("length").desc(), "number")
    length = F.col("length")
    at = F.sum("length").over(in_line.rowsBetween(Window.unboundedPreceding, -1))
    laid = pieces.withColumn("at", F.coalesce(at, F.lit(0)))
    room = F.lit(capacity) - F.col("at") % capacity
    halves = F.array(
        F.struct(F.lit(0).cast("long").alias("skip"), F.least(length, room).alias("take")),
        F.struct(room.alias("skip"), (length - room).alias("take")),
    )
    half = laid.withColumn("half", F.explode(halves)).where(F.col("half.take") > 0)
    at = F.col("at") + F.col("half.skip")
    return half.select(
        "doc_id",
        (F.col("start") + F.col("half.skip")).alias("start"),
        F.col("half.take").alias("length"),
        F.expr("substring(ids, int(4 * half.skip + 1), int(4 * half.take))").alias("ids"),
        "doc_tokens",
        (F.floor(at / capacity) + TAIL).alias("sequence_id"),
        (at % capacity).alias("offset"),
    )
