import math
import random

import numpy as np
import pytest

from saleslane.llm import embedding_dedup
from saleslane.llm.embedding_dedup import bits_for, buckets_of, near_duplicates, scaled, tables_for

SCHEMA = "vec_id long, embedding array<float>"


def has_direction(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, u) in enumerate(rows):
        for b, (j, v) in enumerate(rows[:a]):
            if i is None or j is None or not has_direction(u) or not has_direction(v) or len(u) != len(v):
                continue
            dot = sum(x * y for x, y in zip(u, v, strict=True))
            if dot / math.sqrt(sum(x * x for x in u) * sum(x * x for x in v)) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    out = []
    for a, (i, _) in enumerate(rows):
        component = None if i is None else least[root(a)]
        out.append((i, links[a], component, i == component))
    return sorted(out, key=str)


def result(df, **how):
    return sorted(map(tuple, near_duplicates(df, **how).collect()), key=str)


def family(rng, count, dim, spread):
    center = [rng.gauss(0, 1) for _ in range(dim)]
    return [[x + rng.gauss(0, spread) for x in center] for _ in range(count)]


def vectors(rng, dim=16):
    rows = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(60)]
    for spread in (0.02, 0.15, 0.3):  # well above, near and around the threshold
        rows += family(rng, 12, dim, spread)
    return rows


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = [(1000 - i, v) for i, v in enumerate(vectors(rng))]
    rows += [(i, rows[3][1]) for i in range(20)]  # copies
    rows += [rows[5], rows[5], (rows[7][0], rows[8][1])]  # repeated rows; one id with two vectors
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None]), (2004, [float("nan")] * 16)]
    rows += [(2005, [float("inf")] * 16), (None, rows[3][1]), (None, None), (-7, [2 * x for x in rows[3][1]])]
    rows += [(3000, [3.0, 4.0]), (3001, [-3.0, -4.0]), (3002, [6.0, 8.0]), (3003, [1e-30, 0.0])]
    expected = brute(rows)
    assert result(spark.createDataFrame(rows, SCHEMA), recall=0.99999) == expected
    wide = [(*row, "x", 1, "y") for row in rows]
    clashing = spark.createDataFrame(wide, SCHEMA + ", uid string, links int, vector string")
    assert result(clashing, recall=0.99999) == expected


def test_large_buckets_are_split(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, v) for i, v in enumerate([*vectors(rng), *family(rng, 150, 16, 0.05)])]
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", 5)
    expected = brute(rows)
    assert result(spark.createDataFrame(rows, SCHEMA), recall=0.99999) == expected
    monkeypatch.setattr(embedding_dedup, "MOST_BROADCAST", 0)
    assert result(spark.createDataFrame(rows, SCHEMA), recall=0.99999) == expected


def test_no_link_is_made_up_and_few_are_lost(spark):
    """With the recall of the query, over many pairs close to the threshold."""
    rng = random.Random(3)
    rows = [(i, v) for i, v in enumerate(x for _ in range(40) for x in family(rng, 8, 24, 0.3))]
    plain = {i: n for i, n, _, _ in brute(rows)}
    found = {r["vec_id"]: r["n_links"] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i] <= n for i, n in plain.items())
    assert sum(found.values()) >= 0.98 * sum(plain.values())


def test_whole_numbers_doubles_and_the_threshold_itself(spark):
    rows = [(1, [1, 0]), (2, [9, 0]), (3, [0, 5])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<int>")
    assert result(df) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    wide = [(1, [1e300, 0.0]), (2, [1e-300, 0.0]), (3, [5e-324, 0.0]), (4, [0.0, -1e-310])]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    assert [r[:2] for r in result(df)] == [(1, 2), (2, 2), (3, 2), (4, 0)]


def test_empty(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_sizes():
    assert bits_for(0) == bits_for(50_000) == 6 and bits_for(2**30) == 20 and bits_for(2**60) == 30
    assert tables_for(6) == 10 and tables_for(20) > tables_for(10) > tables_for(6)
    same = buckets_of(np.array([[1.0, 2.0], [2.0, 4.0]]), 6, 10)
    assert same.shape == (2, 10) and (same[0] == same[1]).all() and same.max() < 64
    values = np.array([[3.0, -1e308], [5e-324, 0.0]])
    assert np.abs(scaled(values)).max(axis=1).tolist() == pytest.approx([0.556, 0.5], abs=0.01)
