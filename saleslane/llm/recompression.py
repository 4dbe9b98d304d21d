"""Recompression of word sequences: names for runs and pairs, the same wherever the words are.

Every round first names maximal runs of one symbol, then pairs: each name has a coin for the round, and
a symbol with coin 0 is joined with a following one with coin 1. Names are hashes of what they
stand for, so equal words get equal names in all tasks without an exchange.

For each symbol the words are kept that its making depends on (`Level.first` to `Level.last`): itself,
and the neighbours that were looked at. Wherever those words stand, the symbol stands. A
window of words therefore has the same symbols inside in every document, and a choice among
them by name is the same choice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 5
CHUNK_BYTES = 2 * 1024**2
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
# How many bits of a choice are the place; the others are the priority of the name.
PLACE_BITS = 30
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    """The words of a batch of texts: hashes, and the first word of every text."""

    names: np.ndarray
    begins: np.ndarray  # byte at which a word begins
    ends: np.ndarray
    offsets: np.ndarray  # text i has the words offsets[i] to offsets[i + 1]

    @property
    def text(self) -> np.ndarray:
        """For every word the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words_of(texts: list[bytes]) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    change = np.flatnonzero(np.diff(~WHITE[data], prepend=False))
    begins, ends = change[0::2], change[1::2]
    names = np.zeros(len(begins), U)
    factors = mixed(np.arange((ends - begins).max(initial=0), dtype=U)) | U(1)
    # some megabytes at a time
    for part in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(begins // CHUNK_BYTES)) + 1):
        if len(part):
            names[part] = _word_names(data, begins[part], ends[part], factors)
    text_begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return Words(names, begins, ends, np.searchsorted(begins, text_begins))


def _word_names(
    data: np.ndarray, begins: np.ndarray, ends: np.ndarray, factors: np.ndarray
) -> np.ndarray:
    """The sum of a word's bytes, each times a number for its place, and of its length."""
    lengths = ends - begins
    heads = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(heads, lengths)
    terms = data[np.repeat(begins, lengths) + place].astype(U) + U(1)
    return mixed(np.add.reduceat(terms * factors[place], heads) + lengths.astype(U))


class Hashes:
    """Hashes of any stretch of words, from sums over powers of one odd number."""

    BASE = U(0xD6E8FEB86659FD93)

    def __init__(self, names: np.ndarray):
        base = np.full(len(names) + 1, self.BASE)
        base[0] = 1
        self.inverse = np.full(len(names) + 1, U(pow(int(self.BASE), -1, 1 << 64)))
        self.inverse[0] = 1
        powers = np.cumprod(base, dtype=U)
        self.inverse = np.cumprod(self.inverse, dtype=U)
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(names * powers[:-1], dtype=U)])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the words from ``first`` to before ``last``."""
        return mixed((self.sums[last] - self.sums[first]) * self.inverse[first])


@dataclass
class Level:
    """Symbols in order: name, words covered (begin, end), words depended on (first, last)."""

    names: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray

    def __len__(self) -> int:
        return len(self.names)


def runs_named(level: Level, words: Words) -> Level:
    """Maximal runs of one symbol become one; others keep their name."""
    n = len(level)
    new = np.ones(n, bool)
    new[1:] = (level.names[1:] != level.names[:-1]) | (level.text[1:] != level.text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], n) - 1
    size = tail - head + 1
    names = level.names[head]
    names = np.where(size > 1, mixed(names ^ mixed(size.astype(U) + U(1 << 32))), names)
    begin, end, text = level.begin[head], level.end[tail], level.text[head]
    first = np.minimum.reduceat(level.first, head)
    last = np.maximum.reduceat(level.last, head)
    # That a neighbour differs shows in its nearest word, or else in the words it depends on.
    floor, ceiling = words.offsets[text], words.offsets[text + 1]
    before, after = begin - 1, end
    has_before, has_after = before >= floor, after < ceiling
    other = words.names[np.maximum(before, 0)] != words.names[end - 1]
    far = np.where(other, before, np.minimum(before, level.first[np.maximum(head - 1, 0)]))
    first = np.minimum(first, np.where(has_before, far, before))
    other = words.names[np.minimum(after, len(words.names) - 1)] != words.names[begin]
    far = np.where(other, after + 1, np.maximum(after + 1, level.last[np.minimum(tail + 1, n - 1)]))
    last = np.maximum(last, np.where(has_after, far, after + 1))
    return Level(names, begin, end, first, last, text)


def pairs_named(level: Level, number: int) -> Level:
    """Symbols with coin 0 are joined with a following one with coin 1."""
    n = len(level)
    salt = U(number * 0xA24BAED4963EE407 % (1 << 64))
    coin = (mixed(level.names + salt) >> U(40)) & U(1) == 1
    linked = np.zeros(n + 1, bool)  # linked[i]: symbols i - 1 and i are of one text
    linked[1:-1] = level.text[1:] == level.text[:-1]
    joins = np.zeros(n, bool)
    joins[:-1] = ~coin[:-1] & coin[1:] & linked[1:-1]
    joined = np.concatenate([[False], joins[:-1]])
    # Left alone, a symbol depends on the neighbour that it might have been joined with.
    after = np.minimum(np.arange(n) + 1, n - 1)
    before = np.maximum(np.arange(n) - 1, 0)
    looks_after = ~coin & linked[1:]
    looks_before = coin & linked[:-1] & ~joined
    first, last = level.first.copy(), level.last.copy()
    first = np.where(looks_after, np.minimum(first, level.first[after]), first)
    last = np.where(looks_after, np.maximum(last, level.last[after]), last)
    first = np.where(looks_before, np.minimum(first, level.first[before]), first)
    last = np.where(looks_before, np.maximum(last, level.last[before]), last)
    # At the end of a text there is none, which no window shows.
    last = np.where(~coin & ~linked[1:], np.maximum(last, level.end + 1), last)
    first = np.where(coin & ~linked[:-1], np.minimum(first, level.begin - 1), first)
    keep = ~joined
    second = mixed(level.names[after] ^ U(0x6A09E667F3BCC909))
    pair = mixed(level.names * U(0x9FB21C651E98DF25) + second)
    names = np.where(joins, pair, level.names)[keep]
    end = np.where(joins, level.end[after], level.end)[keep]
    return Level(names, level.begin[keep], end, first[keep], last[keep], level.text[keep])


def levels(words: Words, rounds: int = ROUNDS) -> list[Level]:
    """The words themselves, then the symbols after every round."""
    place = np.arange(len(words.names))
    found = [Level(words.names, place, place + 1, place, place + 1, words.text)]
    for number in range(1, rounds + 1):
        if len(found[-1]):
            found.append(pairs_named(runs_named(found[-1], words), number))
    return found


def _least(keys: np.ndarray, low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The least of keys[low : low + count], for counts of one or more."""
    out = np.empty(len(low), U)
    table, width = keys, 1
    while True:
        of = np.flatnonzero((count >= width) & (count < 2 * width))
        if len(of):
            out[of] = np.minimum(table[low[of]], table[low[of] + count[of] - width])
        width *= 2
        if width > count.max(initial=0):
            return out
        half = width // 2
        table = np.minimum(table[:-half], table[half:]) if len(table) > half else table


@dataclass
class Blocks:
    """Stretches of windows that chose one symbol: text, first window, number of windows."""

    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    key: np.ndarray
    content: np.ndarray


def blocks_of(words: Words, hashes: Hashes, size: int, rounds: int = ROUNDS) -> Blocks:
    """The windows of ``size`` words, grouped by the symbol that each chooses.

    A window chooses, on the highest level that has a symbol whose words all lie in the window, the
    one of least priority, which the name decides; the leftmost of equal ones. The key stands for
    the level, the symbol, and the words it depends on, so equal windows have equal keys.
    """
    n = len(words.names)
    text = words.text
    starts = np.flatnonzero(np.arange(n) + size <= words.offsets[text + 1]) if n else np.zeros(0, int)
    keys = np.zeros(len(starts), U)
    open_ = np.arange(len(starts))
    for number, level in reversed(list(enumerate(levels(words, rounds)))):
        if not len(open_):
            break
        at = starts[open_]
        # symbols depending on words from ``at`` on only, and before ``at + size`` only
        below = np.cumsum(np.bincount(np.maximum(level.first + 1, 0), minlength=n + 2))
        up_to = np.cumsum(np.bincount(np.minimum(level.last, n + 1), minlength=n + 2))
        low = below[at]
        count = up_to[at + size] - low
        has = np.flatnonzero(count > 0)
        priority = mixed(level.names ^ U(0x510E527FADE682D1)) >> U(PLACE_BITS) << U(PLACE_BITS)
        chosen = _least(priority | np.arange(len(level), dtype=U), low[has], count[has])
        chosen = (chosen & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        symbols, where = np.unique(chosen, return_inverse=True)
        first, last = level.first[symbols], level.last[symbols]
        offset = (level.begin[symbols] - first).astype(U)
        name = mixed(hashes.of(first, last) ^ mixed(level.names[symbols] + offset + U(number << 40)))
        keys[open_[has]] = name[where]
        open_ = np.delete(open_, has)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Blocks(none, none, none, np.zeros(0, U), np.zeros(0, U))
    own = text[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    first = starts[head]
    content = hashes.of(first, first + count + size - 1)
    return Blocks(own[head], first - words.offsets[own[head]], count, keys[head], content)
