"""Byte-level BPE: vectorised pre-tokenisation, cached merges, decoding by offsets.

Texts are cut into pieces by a small automaton over classes of code points, run as an associative
scan: the text is laid out as blocks, each block's transition function is composed, the functions
are scanned for the state at which every block begins, and all blocks then move in step. Pieces
are merged once each and kept; offsets of the tokens are kept for decoding.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES_IN_CACHE = 300_000
BATCH_BYTES = 1024**2
BLOCK = 256
# So many characters usually lead to one state from wherever they start.
SYNC = 4
LONG_PIECE = 64

# Classes of code points. APOSTROPHE with one of the letters below is a piece of its own:
# 's 't 'm 'd (ENDING), 're 've (R or V, then E), 'll (L twice).
SPACE, WHITE, LETTER, NUMBER, OTHER, APOSTROPHE, ENDING, R, V, L, E, END = range(12)
# States: what the piece that is open now is.
BEGIN, IN_SPACE, IN_WHITE, IN_LETTERS, IN_NUMBERS, IN_OTHER = range(6)
QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE = range(6, 11)
STATES, CLASSES = 11, 12
HERE, BEFORE = 1, 2  # a piece begins at this character; one begins at the character before


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for every (state, class), flat."""
    letters = (LETTER, ENDING, R, V, L, E)
    step = np.zeros((STATES, CLASSES), np.uint8)
    mark = np.zeros((STATES, CLASSES), np.uint8)
    pending = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}
    # A space belongs to what follows; other white space stands alone. An unfinished 'r, 'v or 'l
    # was an apostrophe and a word after all.
    opened = {IN_SPACE: BEFORE, IN_WHITE: BEFORE | HERE} | dict.fromkeys(pending, BEFORE | HERE)
    for state in range(STATES):
        begun = opened.get(state, HERE)
        for kind in range(CLASSES):
            if kind == END:
                step[state, kind] = BEGIN
                mark[state, kind] = HERE | (BEFORE if state in pending else 0)
            elif kind in (SPACE, WHITE):
                step[state, kind] = IN_SPACE if kind == SPACE else IN_WHITE
                mark[state, kind] = 0 if state in (IN_SPACE, IN_WHITE) else begun
            elif kind in letters:
                step[state, kind], mark[state, kind] = IN_LETTERS, begun
                if state == IN_LETTERS:
                    mark[state, kind] = 0
                elif state == QUOTE and kind in (ENDING, R, V, L):
                    step[state, kind] = {ENDING: DONE, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind]
                    mark[state, kind] = 0
                elif state in pending:
                    finished = pending[state] == kind
                    step[state, kind] = DONE if finished else IN_LETTERS
                    mark[state, kind] = 0 if finished else BEFORE
            elif kind == NUMBER:
                step[state, kind] = IN_NUMBERS
                mark[state, kind] = 0 if state == IN_NUMBERS else begun
            else:
                goes_on = state in (IN_OTHER, QUOTE)
                mark[state, kind] = 0 if goes_on else begun
                # behind a space the apostrophe belongs to the space's piece
                fresh = kind == APOSTROPHE and not goes_on and state != IN_SPACE
                step[state, kind] = QUOTE if fresh else IN_OTHER
    return step.ravel(), mark.ravel()


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    by_category = {"L": LETTER, "N": NUMBER}
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = by_category.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            table[point] = kind
    # The white space of the pattern.
    white = [9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[white + list(range(0x2000, 0x200B))] = WHITE
    table[ord(" ")], table[ord("'")] = SPACE, APOSTROPHE
    table[[ord(letter) for letter in "stmd"]] = ENDING
    table[[ord(letter) for letter in "rvle"]] = [R, V, L, E]
    return table


def block_functions(kinds: np.ndarray) -> np.ndarray:
    """For every row of characters the state it leads to from each state.

    The last few characters decide, unless they leave more than one state; then the whole row is
    composed.
    """
    step, _ = automaton()

    def composed(rows: np.ndarray) -> np.ndarray:
        state = np.tile(np.arange(STATES, dtype=np.uint8), (len(rows), 1))
        for column in range(rows.shape[1]):
            state = step[state.astype(np.int16) * CLASSES + rows[:, column, None]]
        return state

    functions = composed(kinds[:, -SYNC:])
    open_rows = np.flatnonzero((functions != functions[:, :1]).any(axis=1))
    if len(open_rows):
        functions[open_rows] = composed(kinds[open_rows])
    return functions


def scanned(functions: np.ndarray) -> np.ndarray:
    """Inclusive scan: row i becomes the composition of rows 0 to i, by doubling."""
    done, width = functions.copy(), 1
    while width < len(done):
        done[width:] = np.take_along_axis(done[width:], done[:-width].astype(np.intp), axis=1)
        width *= 2
    return done


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Where pieces begin, given the class of every character; texts end with END, a mark too."""
    step, mark = automaton()
    rows = -(-len(kinds) // BLOCK) or 1
    padded = np.full(rows * BLOCK, END, np.uint8)
    padded[: len(kinds)] = kinds
    grid = padded.reshape(rows, BLOCK)
    reached = scanned(block_functions(grid))[:, BEGIN]
    state = np.concatenate([[np.uint8(BEGIN)], reached[:-1]])
    grid = np.ascontiguousarray(grid.T)
    marks = np.empty((BLOCK, rows), np.uint8)
    for column in range(BLOCK):
        at = state.astype(np.int16) * CLASSES + grid[column]
        marks[column], state = mark[at], step[at]
    flat = marks.T.ravel()[: len(kinds)]
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return np.flatnonzero(begins)


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]
    blob: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        lengths = np.array([len(token) for token in tokens], np.int64)
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        return cls(ranks, blob, np.cumsum(lengths) - lengths, lengths)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a piece: pairs are merged, that of least rank first and the leftmost of those."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(piece) >= LONG_PIECE:
            return self._merged_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        rank = self.ranks.get
        none = len(self.lengths)
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return [self.ranks[part] for part in parts]

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap and linked parts, for long runs."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else len(parts)
            if right < len(parts):
                pair = parts[left] + parts[right]
                if pair in self.ranks:
                    heapq.heappush(heap, (self.ranks[pair], left, pair))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = after[left]
            if parts[left] is None or right >= len(parts) or parts[left] + parts[right] != pair:
                continue
            parts[left], parts[right] = pair, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [self.ranks[part] for part in parts if part is not None]


@dataclass
class Encoded:
    """``ids`` and byte ``offsets`` of the tokens of a text; ``decimals`` is the ids in writing."""

    ids: np.ndarray
    offsets: np.ndarray
    decimals: str


class Encoder:
    """Encodes and decodes whole texts; pieces seen before come from a bounded cache."""

    def __init__(self, path: str, most: int = PIECES_IN_CACHE):
        self.vocabulary, self.most = Vocabulary.of(path), most
        self.ids: dict[str, bytes] = {}
        self.decimals: dict[str, str] = {}

    def _learn(self, pieces: list[str]) -> None:
        new = [piece for piece in set(pieces) if piece not in self.ids]
        if len(self.ids) + len(new) > self.most:
            self.ids.clear()
            self.decimals.clear()
            new = list(set(pieces))
        for piece in new:
            ids = self.vocabulary.merged(piece.encode())
            self.ids[piece] = np.array(ids, "<u4").tobytes()
            self.decimals[piece] = " ".join(map(str, ids))

    def encode(self, texts: list[str]) -> list[Encoded]:
        """All texts at once; END stands between them, so no piece reaches over."""
        if not texts:
            return []
        whole = "\n".join(texts) + "\n"
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kinds = classes()[points]
        ends = np.cumsum([len(text) + 1 for text in texts]) - 1
        kinds[ends] = END
        starts = piece_starts(kinds)
        # the piece that begins at an END is that END alone
        cuts = starts.tolist()
        pieces = [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        last = np.searchsorted(starts, ends).tolist()
        self._learn(pieces)
        out, first = [], 0
        for end in last:
            own = pieces[first:end]
            ids = np.frombuffer(b"".join(map(self.ids.__getitem__, own)), "<u4")
            lengths = self.vocabulary.lengths[ids]
            decimals = " ".join(map(self.decimals.__getitem__, own))
            out.append(Encoded(ids, np.cumsum(lengths) - lengths, decimals))
            first = end + 1
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the tokens, each at its offset."""
        if not len(ids):
            return b""
        lengths = self.vocabulary.lengths[ids]
        size = int(offsets[-1] + lengths[-1])
        # byte j of a token at offset o is byte begins + j of the vocabulary
        source = np.repeat(self.vocabulary.begins[ids] - offsets, lengths)
        return self.vocabulary.blob[source + np.arange(size)].tobytes()


@cache
def encoder(path: str) -> Encoder:
    """One for each worker process, which serves many tasks."""
    return Encoder(path)


def in_parts(
    batches: Iterable[pa.RecordBatch], column: str
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in parts of about BATCH_BYTES, with their texts; a text is never cut."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False))
        edges = [0, *(np.flatnonzero(np.diff(sizes // BATCH_BYTES)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            part = batch.slice(a, b - a)
            yield part, [x.decode("utf-8", "replace") for x in part[column].to_pylist()]
