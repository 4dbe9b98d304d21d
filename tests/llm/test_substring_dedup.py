import random
from collections import defaultdict

import numpy as np
import pytest
from llm.brute import sha, without_repeats

from saleslane.llm import substring_dedup
from saleslane.llm.recompression import Hashes, blocks_of, levels, words_of


def expected(rows):
    return sorted(((i, n, r, sha(kept)) for i, n, r, kept in without_repeats(rows)), key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def mosaic(rng, alphabet, parts=4, longest=120):
    base = [[str(rng.randrange(alphabet)) for _ in range(150)] for _ in range(6)]
    rows = []
    for i in rng.sample(range(100), 30):
        text = []
        for _ in range(parts):
            piece = rng.choice(base)
            start = rng.randrange(150)
            text += piece[start : start + rng.randrange(longest)]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("alphabet", [2, 5, 500])
def test_against_brute_force(documents, alphabet):
    rows = mosaic(random.Random(alphabet), alphabet)
    assert result(substring_dedup.digests(documents(rows))) == expected(rows)


def test_cases(documents):
    passage = " ".join(f"w{i}" for i in range(50))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "short text"), (None, passage), (None, passage), (7, passage)]
    rows += [(50, passage.replace(" ", "\t\n")), (51, passage + " "), (52, "run " * 3000), (53, "run " * 200)]
    rows += [(54, "run " * 49), (60, "ab cd " * 500), (61, "cd ab " * 100), (50, passage)]
    assert result(substring_dedup.digests(documents(rows))) == expected(rows)
    assert result(substring_dedup.digests(documents(rows, clashing=True))) == expected(rows)


def test_empty(documents):
    assert substring_dedup.digests(documents([])).collect() == []


@pytest.mark.parametrize("size", [5, 20, 50])
@pytest.mark.parametrize("alphabet", [1, 2, 10])
def test_equal_windows_choose_equal_symbols(size, alphabet):
    texts = [text.encode() for _, text in mosaic(random.Random(size), alphabet)]
    words = words_of(texts)
    blocks = blocks_of(words, Hashes(words.names), size)
    keys = defaultdict(set)
    for text, first, count, key in zip(blocks.text, blocks.first, blocks.count, blocks.key, strict=True):
        own = texts[text].split()
        for at in range(first, first + count):
            keys[tuple(own[at : at + size])].add(int(key))
    assert all(len(found) == 1 for found in keys.values())
    assert blocks.count.sum() == sum(max(0, len(t.split()) - size + 1) for t in texts)


def test_words_and_their_hashes():
    texts = [b"one two", b"", b"  \n", b"two\tone", b"x" * 5000 + b" one"]
    words = words_of(texts)
    assert words.offsets.tolist() == [0, 2, 2, 2, 4, 6]
    one, two = words.names[:2]
    assert words.names[[2, 3, 5]].tolist() == [two, one, one]
    hashes = Hashes(words.names)
    assert hashes.of(np.array([0]), np.array([1])) == hashes.of(np.array([5]), np.array([6]))
    assert hashes.of(np.array([0]), np.array([2])) != hashes.of(np.array([2]), np.array([4]))


def test_symbols_cover_the_words_and_know_what_they_depend_on():
    rng = random.Random(1)
    words = words_of([" ".join(rng.choice("abcd") for _ in range(300)).encode() for _ in range(5)])
    for level in levels(words):
        assert level.begin.tolist() == [0, *level.end[:-1].tolist()]
        assert (level.first <= level.begin).all() and (level.last >= level.end).all()
        assert (np.diff(level.first) >= 0).all() and (np.diff(level.last) >= 0).all()
