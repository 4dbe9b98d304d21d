import math
import random

import numpy as np
import pytest
from llm.brute import classes, near_duplicates

from saleslane.llm import simhash_dedup
from saleslane.llm.components import local_forest, roots
from saleslane.llm.simhash_dedup import _masks, distances, fingerprint, meet


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cases(documents):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(80)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = base[rng.randrange(6)].split()
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(80)] = "x"
        rows.append((i, " ".join(text)))
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "One"), (105, "one two")]
    rows += [(106, "é É\x1cz two"), (None, base[0]), (None, "alone here now"), (103, "one")]
    rows += [(107, "word " * 50_000)]
    expected = sorted(near_duplicates(rows), key=str)
    assert result(simhash_dedup.near_duplicates(documents(rows))) == expected
    assert result(simhash_dedup.near_duplicates(documents(rows, clashing=True))) == expected


def test_empty(documents):
    assert simhash_dedup.near_duplicates(documents([])).collect() == []
    assert simhash_dedup.survivors(documents([])).collect() == []


def test_survivors_are_one_row_of_each_group(documents):
    rows = [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "p q r s")]
    rows += [(None, "p q r s"), (9, None), (8, "")]
    kept = simhash_dedup.survivors(documents(rows, clashing=True))
    assert kept.columns == documents(rows, clashing=True).columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == [(2, "a b c d"), (8, ""), (None, "p q r s")]


def test_shingles_of_few_words():
    assert fingerprint(b"") == fingerprint(b" \n") == 0
    assert fingerprint(b"A  b") == fingerprint(b"a\tB")
    assert fingerprint(b"a b c") != fingerprint(b"a b")


@pytest.mark.parametrize("most", [1, 2, 3, 4, 5])
def test_meeting_finds_all_links(most):
    rng = np.random.default_rng(most)
    values = set()
    for _ in range(25):
        centre = int(rng.integers(0, 2**63))
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            values.add(centre ^ sum(1 << int(b) for b in flips))
    values = sorted(values)
    by_prefix = {}
    for value in values:
        for mask, flips in _masks(8, value.bit_count() & 1, most):
            by_prefix.setdefault((value ^ mask) >> 56, []).append((value, flips))
    place = {value: i for i, value in enumerate(values)}
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for members in by_prefix.values():
        fps, flips = zip(*members, strict=True)
        for a, b in zip(*meet(np.array(fps, np.uint64), np.array(flips), 8, most), strict=True):
            assert (int(a) ^ int(b)).bit_count() <= most
            x, y = root(place[int(a)]), root(place[int(b)])
            parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(values))] == classes(values, most)


@pytest.mark.parametrize("most", [2, 3])
def test_one_large_family_is_split(spark, monkeypatch, most):
    rng = random.Random(most)
    centre = rng.getrandbits(64) | 1 << 63
    values = {centre ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 4))) for _ in range(300)}
    values |= {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(60)}
    values = sorted(values | {rng.getrandbits(64) for _ in range(100)})
    signed = [value - (1 << 64) if value >> 63 else value for value in values]
    worked = []
    links = simhash_dedup._links
    monkeypatch.setattr(
        simhash_dedup, "_links", lambda dealt, bits, most: worked.append((dealt, bits)) or links(dealt, bits, most)
    )
    monkeypatch.setattr(simhash_dedup, "MOST_VARIANTS", 4000)
    found = simhash_dedup.links_between(spark.createDataFrame([(v,) for v in signed], "fp long"), most)
    rooted = dict(map(tuple, roots(found).collect()))
    group = {}
    for value, own in zip(signed, classes(values, most), strict=True):
        group.setdefault(own, set()).add(rooted.get(value, value))
    assert all(len(names) == 1 for names in group.values())
    assert len(set().union(*group.values())) == len(group)
    assert len(worked) > 1
    for dealt, bits in worked:
        assert bits < 64
        for members in dealt.groupBy("prefix").agg({"flips": "collect_list", "fp": "collect_list"}).collect():
            made = 0
            for fp, flips in zip(members[2], members[1], strict=True):
                reach = distances((fp & (1 << 64) - 1).bit_count() & 1, most)
                made += sum(math.comb(64 - bits, x - flips) for x in reach if x >= flips)
            assert made <= 4000


def test_half_of_the_radius():
    assert distances(1, 3) == [1]
    assert distances(0, 3) == [0, 2]
    assert distances(0, 4) == distances(1, 4) == [0, 1, 2]


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(2)
    names = rng.sample(range(-(10**6), 10**6), 400)
    links = list(zip(names[:150], names[1:150], strict=False)) + [(names[200], n) for n in names[201:380]]
    links += links[:20] + [(names[390], names[390])]
    found = dict(map(tuple, roots(spark.createDataFrame(links, "node long, next long")).collect()))
    chain, hub = names[:150], names[200:380]
    assert found == {n: min(g) for g in (chain, hub) for n in g if n != min(g)}
    assert roots(spark.createDataFrame([], "node long, next long")).collect() == []


def test_local_forest_keeps_components():
    member, root = local_forest(np.array([5, 7, 9, 1]), np.array([7, 9, 3, 2]))
    assert dict(zip(member.tolist(), root.tolist(), strict=True)) == {5: 3, 7: 3, 9: 3, 2: 1}
