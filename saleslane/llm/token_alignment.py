"""Aligning the tokens of two tokenizers over a corpus.

Texts are encoded once; their ids are kept. From the ids follow the byte ends of the tokens, whose
merge paths give the overlaps, the groups between common ends, and the counts of linked id pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslane.llm.byte_bpe import in_parts
from saleslane.llm.merge_path import PairTable, Path, groups_of, merged
from saleslane.llm.shared import payload, stored

# Tokens that are merged at once; a longer text is merged by itself.
TOKENS = 1_000_000
# Pairs that a task holds before it adds up equal ones.
HELD_PAIRS = 4_000_000
# Counted pairs that are sent to all tasks at once, some 17 bytes each. More go in several turns.
SENT_PAIRS = 2_000_000

TOKENS_SCHEMA = "row long, doc_id long, a binary, b binary"
GROUPS = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>"
DIGESTS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)
SUMS = "row long, n_best long, count_sum long"


@cache
def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Visible characters of Latin-1 stand for themselves, the other bytes, in order, for 256 and on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + n): byte for n, byte in enumerate(hidden)}


@dataclass
class Side:
    """One tokenizer: the bytes of its tokens by id, and their lengths."""

    tokens: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(token) for token in self.tokens], np.int64)
        self.kind = np.dtype("<u2" if len(self.tokens) <= 2**16 else "<u4")

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class ByteLevel(Side):
    """A byte-level BPE vocabulary in JSON, of whose special tokens none is made."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, letters = made["model"], byte_letters()
        special = {token["content"] for token in made["added_tokens"]}
        ids = {token: i for token, i in model["vocab"].items() if token not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        results = [ids["".join(pair)] for pair in pairs]
        if results != sorted(results):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        ranks = {bytes(letters[c] for c in token): i for token, i in ids.items()}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        super().__init__(tokens)
        self.library = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.library.encode_ordinary(text) for text in texts]


class Pieces(Side):
    """A sentencepiece model with byte fallback, which puts a space before a text by itself."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([self._bytes(i) for i in range(self.library.get_piece_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@cache
def byte_level(path: str) -> ByteLevel:
    """One for each worker process, which serves many tasks."""
    return ByteLevel(path)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, doc_id, a, b) of every row: the ids of both tokenizers, in 16 or 32 bits each.

    A encodes a space and the text, B the text, before which it puts the space itself. Texts that are
    null or empty, and texts whose joined tokens are not a space and the text in both, have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = byte_level(a_path), pieces(b_path)
        for part, texts in in_parts(batches, "text"):
            spaced = [" " + text for text in texts]
            kept: tuple[list[bytes], list[bytes]] = ([], [])
            for text, *ids in zip(spaced, sides[0].encode(spaced), sides[1].encode(texts), strict=True):
                whole = text.encode()
                same = len(whole) > 1 and all(s.joined(i) == whole for s, i in zip(sides, ids, strict=True))
                for side, own, out in zip(sides, ids, kept, strict=True):
                    out.append(np.array(own if same else [], side.kind).tobytes())
            columns = {"row": part["row"], "doc_id": part["doc_id"]}
            yield pa.record_batch(columns | {n: pa.array(k, pa.binary()) for n, k in zip("ab", kept, strict=True)})

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        payload(f"`{text_col}`").alias("text"),
    )
    return slim.mapInArrow(run, TOKENS_SCHEMA)


@dataclass
class Merged:
    """Some texts, laid end to end: the ids of both sides, where each text begins, and their path."""

    rows: pa.RecordBatch
    a: np.ndarray
    b: np.ndarray
    a_starts: np.ndarray
    b_starts: np.ndarray
    path: Path

    def pairs(self, b_size: int) -> np.ndarray:
        """The id pair of every end on the path as one number; only those at links count."""
        last_a = np.minimum(self.path.a, max(0, len(self.a) - 1))
        return self.a[last_a].astype(np.int64) * b_size + self.b[self.path.b]

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums over the part of the path that belongs to each text."""
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(sums[self.a_starts + self.b_starts])


def merged_parts(
    batches: Iterator[pa.RecordBatch], a_side: Side, b_side: Side
) -> Iterator[Merged]:
    """The rows of `encoded` in parts of about TOKENS tokens, merged; a text is never cut."""
    for batch in batches:
        bytes_ = [pc.binary_length(batch[c]).to_numpy(zero_copy_only=False) for c in "ab"]
        sizes = [x // s.kind.itemsize for x, s in zip(bytes_, (a_side, b_side), strict=True)]
        edges = np.flatnonzero(np.diff(np.cumsum(sizes[0] + sizes[1]) // TOKENS)) + 1
        edges = [0, *edges, batch.num_rows]
        for first, end in zip(edges, edges[1:], strict=False):
            rows = batch.slice(first, end - first)
            if not rows.num_rows:
                continue
            ids, starts, ends = [], [], []
            for name, side, size in zip("ab", (a_side, b_side), sizes, strict=True):
                own = np.frombuffer(b"".join(rows[name].to_pylist()), side.kind)
                ids.append(own)
                starts.append(np.concatenate([[0], np.cumsum(size[first:end])]))
                ends.append(np.cumsum(side.lengths[own]))
            yield Merged(rows, *ids, *starts, merged(*ends))


def link_counts(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, count, best) of every linked id pair: its links, and whether no A has more with this B.

    A task adds up what it has before anything is shuffled, so a pair, however frequent, is one row for
    each task; a B has as many rows as A has ids at most.
    """
    b_size = len(pieces(b_path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            return keys[first], np.add.reduceat(counts, first) if len(first) else counts

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in merged_parts(batches, byte_level(a_path), pieces(b_path)):
            held.append(np.unique(part.pairs(b_size)[part.path.link], return_counts=True))
            if sum(len(keys) for keys, _ in held) > HELD_PAIRS:
                held = [added(held)]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield _pair_rows(*held.pop(), b_size)
        if held:
            yield _pair_rows(*added(held), b_size)

    counts = tokens.mapInArrow(run, "a int, b int, count long").groupBy("a", "b")
    most = F.max("count").over(Window.partitionBy("b"))
    return counts.agg(F.sum("count").alias("count")).withColumn("best", F.col("count") == most)


def _pair_rows(keys: np.ndarray, counts: np.ndarray, b_size: int) -> pa.RecordBatch:
    columns = {"a": pa.array((keys // b_size).astype(np.int32)), "b": pa.array((keys % b_size).astype(np.int32))}
    return pa.record_batch(columns | {"count": pa.array(counts.astype(np.int64))})


def groups(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups) of every row: the ids between common ends, those of A and those of B."""

    def cut(ids: np.ndarray, of: np.ndarray, count: int) -> pa.ListArray:
        ends = np.searchsorted(of, np.arange(count + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in merged_parts(batches, byte_level(a_path), pieces(b_path)):
            made = groups_of(part.path, len(part.a), len(part.b))
            lists = [cut(part.a, made.of_a, made.count), cut(part.b, made.of_b, made.count)]
            ends = np.concatenate([[0], np.cumsum(part.per_row(part.path.close))])
            both = pa.StructArray.from_arrays(lists, names=["a", "b"])
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), both)
            yield pa.record_batch({"doc_id": part.rows["doc_id"], "groups": column})

    return tokens.mapInArrow(run, GROUPS)


class Writing:
    """Ids in decimals, with what stands behind them in a list of groups."""

    def __init__(self, size: int, inner: str, last: str):
        self.inner = np.array([f"{i}{inner}".encode() for i in range(size)], object)
        self.last = np.array([f"{i}{last}".encode() for i in range(size)], object)

    def of(self, ids: np.ndarray, group: np.ndarray) -> np.ndarray:
        ends = np.append(group[1:] != group[:-1], True)[: len(ids)]
        out = self.inner[ids]
        out[ends] = self.last[ids[ends]]
        return out


@cache
def writings(a_size: int, b_size: int) -> tuple[Writing, Writing]:
    return Writing(a_size, ",", "|"), Writing(b_size, ",", ";")


def written(part: Merged, a_size: int, b_size: int) -> list[bytes]:
    """The groups of every text as ``a1,a2|b1;a3|b2,b3``."""
    made = groups_of(part.path, len(part.a), len(part.b))
    a_writing, b_writing = writings(a_size, b_size)
    words = np.empty(len(part.a) + len(part.b), object)
    # a group's A tokens stand behind the B tokens of earlier groups, its B tokens behind its A tokens
    numbers = np.arange(made.count)
    words[np.arange(len(part.a)) + np.searchsorted(made.of_b, numbers)[made.of_a]] = a_writing.of(part.a, made.of_a)
    words[np.arange(len(part.b)) + np.searchsorted(made.of_a, numbers, "right")[made.of_b]] = b_writing.of(
        part.b, made.of_b
    )
    words, ends = words.tolist(), (part.a_starts + part.b_starts).tolist()
    return [b"".join(words[a:b])[:-1] for a, b in zip(ends, ends[1:], strict=False)]


def _digester(a_path: str, b_path: str, table: tuple, whole: bool) -> Callable:
    """Digests of every text with its sums over the pairs of ``table``, or the sums alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = byte_level(a_path), pieces(b_path)
        counts = PairTable(*table)
        for part in merged_parts(batches, a_side, b_side):
            links = part.path.link
            count, best = np.zeros(len(links), np.int64), np.zeros(len(links), bool)
            count[links], best[links] = counts.find(part.pairs(len(b_side.tokens))[links])
            sums = {"n_best": pa.array(part.per_row(best)), "count_sum": pa.array(part.per_row(count))}
            if not whole:
                yield pa.record_batch({"row": part.rows["row"]} | sums)
                continue
            texts = written(part, len(a_side.tokens), len(b_side.tokens))
            n_a = np.diff(part.a_starts)
            hashes = [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(texts, n_a, strict=True)]
            columns = {
                "row": part.rows["row"],
                "doc_id": part.rows["doc_id"],
                "n_a": pa.array(n_a.astype(np.int64)),
                "n_b": pa.array(np.diff(part.b_starts).astype(np.int64)),
                "n_groups": pa.array(part.per_row(part.path.close)),
                "n_links": pa.array(part.per_row(links)),
            }
            yield pa.record_batch(columns | sums | {"groups_sha256": pa.array(hashes, pa.string())})

    return run


def digests(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Links are the overlaps of A and B tokens; n_best counts those whose pair has the highest count of its
    B id in the whole corpus, ties included, and count_sum adds up the counts of all. Texts that are null,
    empty, or not given back exactly by both tokenizers have zeros and an empty hash, and no links.
    Repeated rows and null ids are texts like others, an empty table gives an empty table, other columns
    are ignored, and a text is merged whole, however long: some 150 bytes of memory a token.
    """
    tokens = stored(encoded(docs, a_path, b_path, id_col, text_col), "tokens")
    counts = stored(link_counts(tokens, a_path, b_path), "pairs")
    turns = -(-counts.count() // SENT_PAIRS) or 1
    b_size = len(pieces(b_path).tokens)

    def turn(number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mine = counts.where(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == number).toArrow()  # SENT_PAIRS or so
        a, b, count, best = (mine[c].to_numpy() for c in ("a", "b", "count", "best"))
        return a.astype(np.int64) * b_size + b, count, best

    made = tokens.mapInArrow(_digester(a_path, b_path, turn(0), whole=True), DIGESTS)
    if turns > 1:
        # each turn adds its pairs to the sums, and is written before the next one begins
        made = stored(made, "digests")
        sums = made.select("row", "n_best", "count_sum")
        for number in range(1, turns):
            more = tokens.mapInArrow(_digester(a_path, b_path, turn(number), whole=False), SUMS)
            sums = sums.unionByName(stored(more, "sums"))
        added = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        made = made.drop("n_best", "count_sum").join(added, "row")
    return made.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
